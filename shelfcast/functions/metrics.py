"""Regression errors in one pass over the scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    scored: DataFrame, label: str, prediction: str, *by: str
) -> DataFrame:
    """``n_rows, n_left_out, mae, mse, r2`` over all rows, or per group of ``by``.

    Every number but ``n_left_out`` is over the rows that have both values; it counts the others.

    The total variance comes from ``var_pop`` (merged central moments), which stays accurate where
    sum-of-squares minus square-of-sum would cancel. For a constant label r2 is 1 when every
    prediction is exact and 0 otherwise.
    """
    both = F.col(prediction).isNotNull() & F.col(label).isNotNull()
    real = F.when(both, F.col(label).cast("double"))
    error = F.col(prediction).cast("double") - real
    mse, variance = F.avg(error * error), F.var_pop(real)
    return scored.groupBy(*by).agg(
        F.count_if(both).alias("n_rows"),
        F.count_if(~both).alias("n_left_out"),
        F.avg(F.abs(error)).alias("mae"),
        mse.alias("mse"),
        F.when(variance == 0, F.when(mse == 0, 1.0).otherwise(0.0))
        .otherwise(F.lit(1.0) - F.try_divide(mse, variance))
        .alias("r2"),
    )
