"""Batch file scans with declared schemas, and an inventory of landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under a declared schema: no footer inference; absent columns read as NULL."""
    return spark.read.schema(schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and a declared schema.

    ``enforceSchema=False`` makes a header in another order an error; Spark's default would
    silently assign the columns by position. A cell that does not parse becomes NULL.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Landed files: ``file_path, file_name, file_size, modified_at``.

    Only file metadata is read: the content column of the scan is pruned away.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.col("path").alias("file_path"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows each source file contributes to a file-based frame. No data column is read, and the
    counts are combined before the shuffle, so one huge file is no hot spot."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))
