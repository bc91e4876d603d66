"""Catalog scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> DataFrame:
    """A catalog table or view, cut to ``columns`` where given (the cut reaches the scan)."""
    table = spark.table(name)
    return table.select(*columns) if columns else table
