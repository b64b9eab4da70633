"""Session settings and the shared scratch folder."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "loglake", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings every job here relies on (UTC, AQE)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Only a local session may do without the setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="loglake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_job: ContextVar[str] = ContextVar("job", default="")


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end.

    What is built inside must be consumed inside: a table that reads them is lost afterwards.
    """
    name = f"job-{uuid.uuid4().hex}/"
    token = _job.set(name)
    try:
        yield
    finally:
        _job.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/loglake/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table inside the shared folder."""
    return f"{shared_folder(spark)}/loglake/{_job.get()}{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage like a checkpoint, but keeps a columnar table with statistics
    that later steps can prune and that outlives a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python tasks that are run inside get at most so many rows at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release_memory() -> None:
    """Hands back to the system what this process has freed; the allocators of Arrow and C keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The same task, which hands its memory back when it ends: Spark keeps Python workers for later stages."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def by_key(rows: DataFrame, key: str, rows_a_task: int) -> DataFrame:
    """Rows of one key together, about ``rows_a_task`` in a task and at least a task a core.

    For scans whose rows grow a lot before they are grouped by the key: tasks of a scan, and partitions that are
    joined by their size, would hold more groups the larger the input is.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // rows_a_task))
    return rows.repartition(tasks, key)


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a plain scan on at least as many partitions as there are cores.

    A large table has far more splits than cores and is returned as it is. A single
    small or unsplittable file (gzip, one row group) would leave all other cores idle,
    so its rows are dealt out once. Use it on scans only: counting the partitions of a
    plan with shuffles would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
