"""The folder that the driver and all executors share, and tables kept there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows of a file, where the rows to come are known: a table of a few thousand rows isn't dealt over hundreds of files.
FILE_ROWS = 500_000

#: Spark's setting by which a query's shuffle files go when the query ends (4.1 on; other versions ignore it).
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folders that ``keep`` made, by application, until they are dropped.
_kept: dict[str, set[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only where it is unset and the master is local."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get().rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="gridloom-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def keep(df: DataFrame, name: str, rows: int | None = None, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage is cut, and a lost executor costs nothing that is done.

    rows: df is known to have so many rows at most; its last stage takes a task for each FILE_ROWS of them, no more.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _kept.setdefault(spark.sparkContext.applicationId, set()).add(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._kept_at = path
    return made


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind; else those stay until the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def tasks(spark: SparkSession) -> int:
    """Tasks for work that is heavy for its rows or makes many of few: sizes in bytes, which AQE and file splits go by, say nothing of it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def meet(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The join on buckets, dealt by key to a fixed number of tasks. Neither side is broadcast: Spark's estimates know nothing of exploded rows."""
    n = tasks(a.sparkSession)
    return a.repartition(n, *keys).hint("merge").join(b.repartition(n, *keys), keys)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop(*tables: DataFrame | None) -> None:
    """Delete tables that ``keep`` gave and nothing reads any more; others are left alone."""
    for df in tables:
        path = df.__dict__.pop("_kept_at", None) if df is not None else None
        if path:
            _delete(df.sparkSession, path)
            _kept.get(df.sparkSession.sparkContext.applicationId, set()).discard(path)


def clear(spark: SparkSession) -> None:
    """Delete every table that this application keeps. Results that were not written yet can no longer be read."""
    for path in _kept.pop(spark.sparkContext.applicationId, set()):
        _delete(spark, path)
