"""Scoring: predictions stay on the row they belong to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.expressions import truncated
from ..operators.joins import lookup_left_join
from ..sizing import BROADCAST_LIMIT
from ..workspace import scratch_path, write_and_reopen
from .training import RAW


def scored_rows(
    raw: DataFrame, keep: Sequence[str] = (), features: Sequence[str] = schemas.FEATURES
) -> DataFrame:
    """Features, ``prediction`` and ``Real_Sales`` side by side, from rows with a raw prediction.

    The stored prediction is cut to a whole number; errors are measured on the raw one.
    """
    return raw.select(
        *keep,
        *features,
        truncated(RAW).alias("prediction"),
        F.col(schemas.LABEL).alias("Real_Sales"),
    )


def scoring_table(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``Store, prediction, Real_Sales`` and any ``keep`` columns (such as the row key)."""
    return raw.select(
        schemas.KEY,
        truncated(RAW).alias("prediction"),
        F.col(schemas.LABEL).alias("Real_Sales"),
        *keep,
    )


def mean_by_store(train: DataFrame) -> DataFrame:
    """The baseline model: per store ``mean_store, sum_sales, n_sales``; NULL is one of the stores."""
    return train.groupBy(F.col(schemas.KEY).alias("mean_store")).agg(
        F.sum(schemas.LABEL).alias("sum_sales"), F.count(schemas.LABEL).alias("n_sales")
    )


def predict_store_mean(
    df: DataFrame, train: DataFrame, *, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """``df`` with the baseline's raw prediction: the store's mean, or the overall one if unseen.

    The sums per store are written once: the training rows are read a single time, and what follows
    (the overall mean, the size check, the join) reads the small result.
    """
    spark = df.sparkSession
    sums = write_and_reopen(mean_by_store(train), scratch_path(spark, "store-means"))
    overall = sums.agg(F.sum("sum_sales") / F.sum("n_sales")).first()[0]
    means = sums.filter(F.col("mean_store").isNotNull()).select(
        "mean_store", (F.col("sum_sales") / F.col("n_sales")).alias("mean_sales")
    )
    # The join drops its left key, so it gets a copy.
    keyed = df.withColumn("mean_store", F.col(schemas.KEY))
    matched = lookup_left_join(keyed, means, "mean_store", broadcast_limit=broadcast_limit)
    return matched.withColumn(RAW, F.coalesce("mean_sales", F.lit(overall))).drop(
        "mean_store", "mean_sales"
    )
