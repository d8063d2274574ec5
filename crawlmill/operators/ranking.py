"""Order numbers that survive hot groups.

A window's ``row_number`` puts a whole group into one task. Ranks of all rows come from a
global sort instead, whose range partitions split a group of any size over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlmill.session import materialize

def numbered(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Add increasing unique numbers that follow ``order`` over the whole table.

    The numbers have gaps: they are the place in a sorted partition, behind the number of
    the partition. Write the result before using it twice, so that they never change.
    """
    return df.orderBy(*order).withColumn(out, F.monotonically_increasing_id())


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key.

    Spark limits each map task to one row per key before the shuffle, so a key that
    occurs everywhere costs one row per task.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def first_n_per_key(
    df: DataFrame, key: Sequence[str], order: Sequence[Column | str], n: int, out: str
) -> DataFrame:
    """The first ``n`` rows of each key with their rank; limited before the shuffle."""
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= n)


def rank_in_group(
    df: DataFrame, group: str, order: Sequence[Column | str], out: str
) -> DataFrame:
    """Dense rank 1, 2, 3, … of every row within its group; ``order`` must be total.

    The sorted rows are written to the shared folder; what a group has in earlier slices of
    the sort is one narrow row per group and slice. A null group is a group.
    """
    placed = materialize(numbered(df, [F.col(group), *order], "_seq"), "sorted-groups")
    placed = placed.withColumn("_slice", F.shiftright("_seq", 33))
    # One row per group and sorted slice; a slice is a contiguous run of its group.
    runs = placed.groupBy(group, "_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_start")
    )
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    runs = runs.withColumnsRenamed({group: "_group", "_slice": "_run"})
    same = placed[group].eqNullSafe(runs["_group"]) & (placed["_slice"] == runs["_run"])
    return (
        placed.join(runs, same)
        .withColumn(out, F.col("_before") + F.col("_seq") - F.col("_start") + 1)
        .drop("_seq", "_slice", "_before", "_start", "_group", "_run")
    )
