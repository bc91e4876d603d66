"""File streams: rate-limited reading, appending, and enrichment with a static table.

Every sink takes its own checkpoint location. A checkpoint names the files already taken, so it
belongs to one target and must outlive the query.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.joins import keep_right_key_left_join
from ..sinks.tables import append_evolving, drop_rows_of
from ..sizing import BROADCAST_LIMIT, fits_broadcast

_BATCH = "_batch"

#: Age up to which files are read, counted back from the newest one. The source's own default is a
#: week, and a file that lands later with an older time (a backfill, a copy that keeps times) would
#: never be read. The price: the log of files seen is never shortened.
MAX_FILE_AGE = "36500d"


def open_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int = 1,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """New Parquet files under ``path`` as a stream, at most so many per micro-batch, whatever their
    modification times up to ``max_file_age``."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("maxFileAge", max_file_age)
        .parquet(path)
    )


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema of the files already there, read once in batch, to be passed to the stream."""
    return spark.read.parquet(path).schema


def append_to_table(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    *,
    every: str | None = None,
    path: str | None = None,
) -> StreamingQuery:
    """Append to a Parquet table. ``every`` is a processing-time interval such as ``1 seconds``;
    without it the query takes what is there now and stops.

    The table's file log counts batches, so a new checkpoint on a filled table would have its first
    batches taken for repeats and silently dropped. That combination is refused.
    """
    spark = stream.sparkSession
    if (
        spark.catalog.tableExists(table)
        and not _has_checkpoint(spark, checkpoint)
        and not spark.table(table).isEmpty()
    ):
        raise ValueError(f"{table} has rows but {checkpoint} is new: they do not belong together")
    writer = _triggered(stream.writeStream, every).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append").format("parquet")
    if path:
        writer = writer.option("path", path)
    return writer.toTable(table)


def append_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    every: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append each micro-batch to a folder of its own, overwriting it when replayed.

    The folder is named by the query's identity, which its checkpoint holds, and the batch's number:
    only a true replay overwrites, and streams with other checkpoints add to the same path.
    ``transform`` is applied to the micro-batch as a batch frame, so it may measure and spread, as
    ``lookup_left_join`` does. Batches may differ in their columns; ``read_batches`` lines them up.
    """

    def write_one(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        own = f"{_query_id(batch.sparkSession, checkpoint)}-{batch_id}"
        rows.write.mode("overwrite").parquet(f"{path}/{_BATCH}={own}")

    writer = _triggered(stream.writeStream, every).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write_one).start()


def append_to_evolving_table(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    *,
    every: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append to a Parquet table and add the columns that it lacks; rows before them read NULL.

    Each micro-batch is a partition of the table, named by the query's identity and its number in
    the column ``_batch``. A replayed batch first drops its partition, so it is there once.
    ``transform`` may give later batches more columns.
    """

    def write_one(batch: DataFrame, batch_id: int) -> None:
        own = f"{_query_id(batch.sparkSession, checkpoint)}-{batch_id}"
        rows = transform(batch) if transform else batch
        drop_rows_of(rows.sparkSession, table, _BATCH, own)
        append_evolving(rows.withColumn(_BATCH, F.lit(own)), table, partition_by=_BATCH)

    writer = _triggered(stream.writeStream, every).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write_one).start()


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All appended batches. With a declared schema no footer is read ahead, and columns a batch
    lacks are NULL; without one the schemas of all files are merged."""
    reader = spark.read
    if schema is None:
        return reader.option("mergeSchema", True).parquet(path).drop(_BATCH)
    return reader.schema(schema).parquet(path).select(*schema.names)


def enrich_stream(
    stream: DataFrame, static: DataFrame, key: str, *, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Key-dropping left join of a stream with a static table.

    Stateless: every micro-batch joins the table as it is then, but its size is measured once, here.
    For a query that keeps running against a table that grows, or where keys may be hot, pass
    ``lookup_left_join`` to ``append_batches`` as its ``transform``: it measures each time.
    """
    if fits_broadcast(static, broadcast_limit):
        static = F.broadcast(static)
    return keep_right_key_left_join(stream, static, key)


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a query keeps over restarts from its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _has_checkpoint(spark: SparkSession, checkpoint: str) -> bool:
    try:
        spark.read.text(f"{checkpoint}/metadata")
    except AnalysisException:
        return False
    return True
