import pytest
from conftest import rows

from crawlmill import session as S


def test_work_goes_to_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert S.shared_dir(spark) == folder
    first, second = S.new_work_path(spark, "x"), S.new_work_path(spark, "x")
    assert first.startswith(f"{folder}/x-") and first != second


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.shared_dir(Session())


def test_written_tables_keep_rows_and_schema(spark):
    df = spark.sql("select 1 a, cast(null as timestamp_ntz) t, array(1, 2) l")
    kept = S.materialize(df, "t")
    assert kept.columns == df.columns and rows(kept) == rows(df)
    empty = S.materialize(df.limit(0), "t")
    assert empty.count() == 0 and empty.columns == df.columns


def test_history_is_one_table(spark):
    history = S.History(spark, "h")
    for i in range(3):
        step = history.add(spark.range(i, i + 2))
        assert rows(step) == [(i,), (i + 1,)]
    assert len(history) == 3
    assert rows(history.all()) == [(0,), (1,), (1,), (2,), (2,), (3,)]
