"""Where jobs keep files that several executors must see.

On a cluster that is the shared folder named by ``spark.checkpoint.dir``. Only a local session
without that setting (tests) falls back to a temporary folder of this machine.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_local_fallback: str | None = None
_open_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    global _local_fallback
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="shelfcast-")
    return _local_fallback


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable; a folder already set on the session is left alone."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, unique per call; nothing is created yet."""
    path = f"{shared_dir(spark)}/shelfcast/{label}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes what is written below ``scratch_path`` inside the block when it ends.

    For work that ends in tables of its own: frames that read scratch data can't be used afterwards.
    """
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield made
    finally:
        _open_scopes.remove(made)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for name in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the files of shuffles whose frames are gone: it does when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_database(spark: SparkSession, label: str) -> str:
    """A new database whose managed tables live in the shared folder."""
    name = f"shelfcast_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")
    return name


def drop_database(spark: SparkSession, name: str) -> None:
    """Stop the session's streams and remove a database with all its tables, as after a trial run."""
    for query in spark.streams.active:
        query.stop()
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python tasks that are run inside the block get at most so many rows in an Arrow batch.

    A batch is held whole on both sides, in buffers of up to twice its size.
    """
    before = spark.conf.get(_ROWS_SETTING)
    if not 0 < int(before) <= rows:
        spark.conf.set(_ROWS_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_ROWS_SETTING, before)


def write_and_reopen(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage with a written dataset: it outlives any executor, and readers prune columns."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
