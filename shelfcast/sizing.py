"""Measured sizes, so that a side is broadcast only when it is known to fit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Upper bound for a broadcast side, in bytes of row data held by every executor.
BROADCAST_LIMIT = 64 << 20

_ROW_OVERHEAD = 48  # row header, null bits and hash-table slot
_SLOT = 8


def _row_bytes(schema: T.StructType) -> str | None:
    """SQL for the bytes of one in-memory row, or None when a column's width cannot be bounded."""
    terms = [f"{_ROW_OVERHEAD + _SLOT * len(schema)}L"]
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            terms.append(f"coalesce(octet_length(`{field.name}`) + {_SLOT}, 0)")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return None
    return " + ".join(terms)


def measured_bytes(df: DataFrame) -> int | None:
    """Row-data size from one distributed aggregate over the columns of variable width; None if it
    cannot be bounded."""
    size = _row_bytes(df.schema)
    if size is None:
        return None
    return df.agg(F.expr(f"coalesce(sum({size}), 0L)")).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    size = measured_bytes(df)
    return size is not None and size <= limit
