"""What the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Hand rows to Python in batches of at most ``size`` bytes, unless the session asks for fewer.

    A batch is held by the JVM, by the pipe and by Python at once.
    """
    now = spark.conf.get(BATCH_BYTES, "64m").lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(now[-1])
    if unit is None and int(now) > size or unit is not None and int(now[:-1]) << unit > size:
        spark.conf.set(BATCH_BYTES, str(size))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def runs_of(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, from batches in which equal keys follow each other.

    Only the rows of the current key are held. The key column has no nulls.
    """
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        for start, end in zip(starts[:-1], starts[1:]):
            if held and keys[start] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def list_offsets(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and row boundaries of a list column without nulls."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]
