"""Tables in folders, of which a change or a search touches only those that it meets.

A :class:`BucketTable` lies in folders by the hash of its key: updates and deletes rewrite the buckets of
their keys and leave all other files as they are. A :class:`TimeQueue` lies in folders by the day of a
time: a pop reads the oldest days until it has found enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmill.operators.tables import apply_updates, remove_rows
from crawlmill.session import materialize

BUCKETS = 16


def _write_folders(rows: DataFrame, path: str, folder: str) -> None:
    """Replace the folders that the rows fall into; other folders stay."""
    rows.write.partitionBy(folder).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


class BucketTable:
    """A table with unique keys below ``path``. It is changed by one writer at a time.

    A change writes the new rows of its buckets to the shared folder first and then exchanges the
    folders, so a change that is repeated after a failure gives the same table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> None:
        self._spark, self._path, self._schema, self._key, self._buckets = spark, path, schema, key, buckets
        self._stored = T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self._key), F.lit(self._buckets)).cast("int").alias("_bucket")

    def create(self, rows: DataFrame) -> BucketTable:
        """Write all rows. A folder of its own for every bucket, also for those that stay empty."""
        _write_folders(rows.select(*self._schema.fieldNames(), self._bucket()).repartition(self._buckets, "_bucket"), self._path, "_bucket")
        return self

    def read(self) -> DataFrame:
        return self._all().drop("_bucket")

    def _all(self) -> DataFrame:
        return self._spark.read.schema(self._stored).parquet(self._path)

    def _met(self, keys: DataFrame) -> list[int]:
        """The buckets of some keys: at most as many as there are."""
        return sorted(r["_bucket"] for r in keys.select(self._bucket()).distinct().collect())

    def _exchange(self, met: list[int], change: Callable[[DataFrame], DataFrame]) -> None:
        if not met:
            return
        before = self._all().where(F.col("_bucket").isin(*met)).drop("_bucket")
        after = materialize(change(before).select(*self._schema.fieldNames(), self._bucket()), "changed-buckets")
        left = {r["_bucket"] for r in after.select("_bucket").distinct().collect()}
        _write_folders(after.repartition("_bucket"), self._path, "_bucket")
        for bucket in sorted(set(met) - left):  # buckets that lost their last row
            folder = f"{self._path}/_bucket={bucket}"
            self._spark.createDataFrame([], self._schema).write.mode("overwrite").parquet(folder)

    def update(self, updates: DataFrame, columns: list[str]) -> None:
        """Set ``columns`` of the rows with the keys of ``updates`` (unique), NULLs included."""
        updates = materialize(updates.select(self._key, *columns), "updates")
        self._exchange(self._met(updates), lambda rows: apply_updates(rows, updates, self._key, columns))

    def delete(self, keys: DataFrame) -> None:
        keys = materialize(keys.select(self._key).where(F.col(self._key).isNotNull()).distinct(), "deletes")
        self._exchange(self._met(keys), lambda rows: remove_rows(rows, keys, [self._key]))


class TimeQueue:
    """Rows in folders by the day of ``time``; rows without a time are the last."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, time: str) -> None:
        self._spark, self._path, self._time = spark, path, time
        self._schema = schema
        self._stored = T.StructType([*schema.fields, T.StructField("_day", T.StringType())])

    def create(self, rows: DataFrame) -> TimeQueue:
        day = F.coalesce(F.date_format(self._time, "yyyy-MM-dd"), F.lit("none"))
        _write_folders(rows.select(*self._schema.fieldNames(), day.alias("_day")).repartition("_day"), self._path, "_day")
        return self

    def read(self) -> DataFrame:
        return self._spark.read.schema(self._stored).parquet(self._path)

    def days(self) -> list[str]:
        """The days that have rows, oldest first; read from the folder names."""
        return sorted((r["_day"] for r in self.read().select("_day").distinct().collect()), key=lambda d: (d == "none", d))

    def _spans(self) -> Iterator[list[str]]:
        """Days in order: one, then twice as many each time, so that a long search ends soon."""
        days, at, size = self.days(), 0, 1
        while at < len(days):
            yield days[at : at + size]
            at, size = at + size, 2 * size

    def oldest(self, pick: Callable[[DataFrame], DataFrame], n: int = 1) -> DataFrame:
        """The ``n`` oldest rows that ``pick`` finds among all rows.

        ``pick(rows)`` chooses rows on their own, at most ``n`` of them and the oldest first. A later
        day is read only if the days before it have too few.
        """
        found, rows = None, 0
        for days in self._spans():
            some = self.read().where(F.col("_day").isin(*days)).drop("_day")
            part = materialize(pick(some).limit(n - rows), "popped")
            rows += part.count()
            found = part if found is None else found.unionByName(part)
            if rows >= n:
                break
        return pick(self.read().drop("_day").limit(0)) if found is None else found
