import numpy as np
import pyarrow as pa

from crawlmill.llm.common import BATCH_BYTES, list_offsets, runs_of, small_batches


def test_runs_cross_batches():
    keys = [1, 1, 2, 3, 3, 3, 3, 4]
    for size in (1, 2, 3, 8):
        batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + size], "n": list(range(i, min(8, i + size)))}) for i in range(0, 8, size)]
        batches.insert(1, batches[0].slice(0, 0))
        assert [t.column("n").to_pylist() for t in runs_of(batches, "k")] == [[0, 1], [2], [3, 4, 5, 6], [7]]


def test_list_offsets_of_a_slice():
    flat, ends = list_offsets(pa.array([[1], [2, 3], [], [4]]).slice(1, 2))
    assert flat.tolist() == [2, 3] and ends.tolist() == [0, 2, 2]
    assert np.array_equal(list_offsets(pa.array([], pa.list_(pa.int64())))[1], [0])


def test_batches_get_smaller_only(spark):
    before = spark.conf.get(BATCH_BYTES)
    try:
        for given, expected in (("64m", str(16 << 20)), ("1048576", "1048576"), (str(1 << 30), str(16 << 20))):
            spark.conf.set(BATCH_BYTES, given)
            small_batches(spark)
            assert spark.conf.get(BATCH_BYTES) in (expected, f"{expected}b")
    finally:
        spark.conf.set(BATCH_BYTES, before)
