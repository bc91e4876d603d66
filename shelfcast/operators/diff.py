"""Differences between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that one side has more copies of: the columns, ``change_type`` and ``n_copies``.

    Both multiset differences from one aggregation. Copies are counted before the shuffle, so many
    equal rows make no hot group, and NULLs compare as equal. Columns only one side has are NULL on
    the other.
    """
    step = "__step"
    both = before.withColumn(step, F.lit(-1)).unionByName(
        after.withColumn(step, F.lit(1)), allowMissingColumns=True
    )
    columns = [c for c in both.columns if c != step]
    net = both.groupBy(*columns).agg(F.sum(step).alias(step)).filter(F.col(step) != 0)
    return net.select(
        *columns,
        F.when(F.col(step) > 0, "added").otherwise("removed").alias("change_type"),
        F.abs(step).alias("n_copies"),
    )


def keyed_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, change_type`` (insert, update, delete) for tables with a unique key.

    Each side is reduced to its key and a digest of the other columns, and both are combined per key
    in one aggregation: the wide rows do not move. The digest is over values with their lengths, NULL
    apart from every text, and moments as microseconds: it depends on no separator and no time zone.
    Arrays and structs go along as they are. A column only one side has counts as NULL on the other. A
    repeated key is an error.
    """
    keys = list(keys)
    columns = sorted((set(before.columns) | set(after.columns)) - set(keys))
    nested = {
        f.name
        for df in (before, after)
        for f in df.schema
        if isinstance(f.dataType, (T.ArrayType, T.StructType)) and f.name in columns
    }

    def fingerprint(df: DataFrame, side: int) -> DataFrame:
        kinds = {f.name: f.dataType for f in df.schema}
        plain = [_exact_text(c, kinds[c]) if c in kinds else F.lit("-") for c in columns if c not in nested]
        whole = [(F.col(f"`{c}`") if c in kinds else F.lit(None)).alias(f"n{i}") for i, c in enumerate(sorted(nested))]
        digest = F.struct(F.sha2(F.concat(F.lit(""), *plain), 256).alias("digest"), *whole)
        return df.select(*[F.col(f"`{k}`") for k in keys], F.lit(side).alias("__side"), digest.alias("__digest"))

    def of(side: int) -> Column:
        return F.max(F.when(F.col("__side") == side, F.col("__digest")))

    def copies(side: int) -> Column:
        return F.count_if(F.col("__side") == side)

    per_key = (
        fingerprint(before, 0)
        .unionByName(fingerprint(after, 1))
        .groupBy(*keys)
        .agg(
            of(0).alias("__old"),
            of(1).alias("__new"),
            F.greatest(copies(0), copies(1)).alias("__copies"),
        )
    )
    change = (
        F.when(F.col("__copies") > 1, F.raise_error(F.lit("repeated key")).cast("string"))
        .when(F.col("__old").isNull(), "insert")
        .when(F.col("__new").isNull(), "delete")
        .when(~F.col("__old").eqNullSafe(F.col("__new")), "update")
    )
    return per_key.select(*keys, change.alias("change_type")).filter("change_type IS NOT NULL")


def _exact_text(column: str, kind: T.DataType) -> Column:
    """A text that two values share only if they are equal; with its length, so that texts can be laid end to end."""
    value = F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0)  # -0.0 equals 0.0
    elif isinstance(kind, T.BinaryType):
        value = F.hex(value)
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
