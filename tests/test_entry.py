"""Every registered query against its check SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("events", "documents", "pages", "embeddings", "labels", "benchmark", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are missing")


def ordered(rows, columns):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(r[i] for i in places) for r in rows]
    return sorted(columns), sorted(picked, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    flagship = contract.entry(spark)
    assert flagship.columns == ["from_url", "to_url"]
    assert flagship.count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF)
    got = ordered([tuple(r) for r in result.collect()], result.columns)
    check = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in check.description]
    assert got == ordered(check.fetchall(), columns)


def test_replay_covers_the_corpus(spark):
    pages = contract.queries()["crawl_replay"](spark, SF)
    assert pages.count() == pages.select("url").distinct().count()
    types = {r[0] for r in pages.select("page_type_code").distinct().collect()}
    assert {"HTML", "FORBIDDEN", "FRONTIER"} <= types
