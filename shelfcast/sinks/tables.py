"""Table sinks. Each writes straight from the tasks that produced the rows: no extra shuffle, and
nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_table(df: DataFrame, table: str) -> None:
    """Create the table; fails if it exists."""
    df.write.format("parquet").mode("errorifexists").saveAsTable(table)


def create_table_as(spark: SparkSession, table: str, query: str, replace: bool = False) -> None:
    """``CREATE TABLE … AS SELECT``, after a drop when ``replace`` is set."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet AS {query}")


def replace_table(df: DataFrame, table: str) -> None:
    """Overwrite the table, schema included. Spark refuses if ``df`` reads the same table."""
    df.write.format("parquet").mode("overwrite").saveAsTable(table)


def append_evolving(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """Append by column name. Columns the table lacks are added to it (older rows read NULL);
    columns the frame lacks are written as NULL. A changed type is an error. A new table is
    partitioned by ``partition_by``."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.write.format("parquet").mode("errorifexists")
        (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(table)
        return
    known = {f.name.lower(): f.dataType for f in spark.table(table).schema}
    for field in df.schema:
        present = known.get(field.name.lower())
        if present is not None and present != field.dataType:
            raise ValueError(
                f"{field.name} is {field.dataType.simpleString()}, "
                f"the table has {present.simpleString()}"
            )
    added = [f for f in df.schema if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    given = {f.name.lower() for f in df.schema}
    in_table_order = [
        F.col(f.name) if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema
    ]
    df.select(*in_table_order).write.insertInto(table)


def drop_rows_of(spark: SparkSession, table: str, column: str, value: str) -> None:
    """Drop one partition of a table, if both are there."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{value}')")
