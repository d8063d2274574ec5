"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: str = "*", app: str = "crawlmill", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a local session without that setting gets
    a folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder would lose data with its machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if not configured:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="crawlmill-")
        spark.conf.set(CHECKPOINT_DIR, configured)
    return configured.rstrip("/")


def new_work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage on reliable storage, fixes the rows for every later use,
    and gives the optimizer real file sizes to choose joins by.
    """
    spark = df.sparkSession
    path = new_work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_all(**frames: DataFrame) -> dict[str, DataFrame]:
    """Write several tables that do not depend on each other, side by side."""
    with ThreadPoolExecutor(len(frames)) as jobs:
        written = jobs.map(lambda item: materialize(item[1], item[0]), frames.items())
        return dict(zip(frames, written))


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a table go when it is written, and not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class History:
    """Written tables of one schema that grow step by step, read together as one."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self._spark = spark
        self._root = new_work_path(spark, label)
        self._schema = None
        self._paths: list[str] = []

    def __len__(self) -> int:
        return len(self._paths)

    def add(self, df: DataFrame) -> DataFrame:
        """Write the next step and give it back as a table of its own."""
        path = f"{self._root}/{len(self._paths)}"
        df.write.parquet(path)
        self._schema = df.schema
        self._paths.append(path)
        return self._spark.read.schema(self._schema).parquet(path)

    def all(self) -> DataFrame:
        """All steps so far, as one scan."""
        return self._spark.read.schema(self._schema).parquet(*self._paths)
