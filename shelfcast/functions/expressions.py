"""Scalar expressions whose null and error behaviour matters. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    """SQL text or a Column, as a Column."""
    return F.expr(value) if isinstance(value, str) else value


def holds(predicate: Column | str) -> Column:
    """True only where the predicate is TRUE: UNKNOWN counts as not true, as in DELETE and UPDATE."""
    return F.coalesce(as_column(predicate), F.lit(False))


def ratio(numerator: str, denominator: str) -> Column:
    """Double division that gives NULL for a zero divisor, also under ANSI mode."""
    return F.try_divide(F.col(numerator), F.col(denominator))


def truncated(value: Column | str) -> Column:
    """Whole part toward zero as long; NaN and out-of-range values become NULL, not an error."""
    column = F.col(value) if isinstance(value, str) else value
    return column.try_cast("long")


def fill_constant(name: str, constant: float | int | str) -> Column:
    """The column with its NULLs replaced; NaN is a value and stays."""
    return F.coalesce(F.col(name), F.lit(constant)).alias(name)


def typed_null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def null_flag(name: str) -> Column:
    """1 where the column is NULL, else 0."""
    return F.when(F.col(name).isNull(), 1).otherwise(0)
