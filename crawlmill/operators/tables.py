"""Table maintenance: updates, deletes, keys and constraints as snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlmill import constants as C
from crawlmill.session import materialize


def apply_updates(
    table: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """The next snapshot: rows with an update take its values, NULLs included.

    ``updates`` has unique keys. Write the result to a new path.
    """
    new = updates.select(
        key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    joined = table.join(new, key, "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c)
        for c in table.columns
    ])


def remove_rows(table: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    return table.join(keys.select(*key), list(key), "left_anti")


def with_surrogate_ids(
    rows: DataFrame, order: Sequence[str], last_id: int = 0, out: str = "id"
) -> DataFrame:
    """Add dense ids that follow ``last_id`` in the given order.

    The rows are sorted and written once. A row's id is its file's offset plus its place
    in the file, so no task sees more than its own file and a repeated task gives the
    same ids. The offsets are broadcast: they are one row per written file, whatever the
    number of rows.
    """
    staged = materialize(rows.orderBy(*order), "ids").select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    part = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long")
    before = Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
        .select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        staged.join(F.broadcast(offsets), "_file")
        .withColumn(out, F.lit(last_id) + F.col("_offset") + F.col("_row") + 1)
        .select(out, *rows.columns)
    )


def code_tables(spark: SparkSession) -> DataFrame:
    """The code tables, fixed at ten rows: ``code_table, code``."""
    rows = [("page_type", c) for c in C.PAGE_TYPES] + [("data_type", c) for c in C.DATA_TYPES]
    return spark.createDataFrame(rows, "code_table string, code string")


# constraint, child table and column, parent table and column
FOREIGN_KEYS = (
    ("frontier_page", "frontier", "page_id", "page", "id"),
    ("page_site", "page", "site_id", "site", "id"),
    ("page_page_type", "page", "page_type_code", "page_type", "code"),
    ("page_data_page", "page_data", "page_id", "page", "id"),
    ("page_data_data_type", "page_data", "data_type_code", "data_type", "code"),
    ("link_from_page", "link", "from_page", "page", "id"),
    ("link_to_page", "link", "to_page", "page", "id"),
    ("image_page", "image", "page_id", "page", "id"),
)


def fk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Values without a parent row: ``constraint_name, value, n_rows``.

    Child values are reduced to distinct ones before the join. NULL refers to nothing
    and is no violation.
    """
    checks = []
    for name, child, column, parent, parent_key in FOREIGN_KEYS:
        if child not in tables or parent not in tables:
            continue
        values = (
            tables[child].where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("n_rows"))
        )
        parents = tables[parent].select(F.col(parent_key).alias("_value"))
        checks.append(
            values.join(parents, "_value", "left_anti").select(
                F.lit(name).alias("constraint_name"),
                F.col("_value").cast("string").alias("value"), "n_rows",
            )
        )
    return reduce(DataFrame.unionByName, checks)
