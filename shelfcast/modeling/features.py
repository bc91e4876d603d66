"""Model inputs as DataFrame columns.

Label and features stay on one row throughout, so nothing is ever paired by position. Missing-value
handling is a pipeline stage, so a saved model takes silver rows as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..sizing import BROADCAST_LIMIT, fits_broadcast
from ..workspace import scratch_path, write_and_reopen

#: Stands for a missing value; below every value the features take.
MISSING = -1.0
VECTOR = "features"


def input_names(features: Sequence[str] = schemas.FEATURES) -> list[str]:
    """Vector slots: each feature's value and then its missing flag."""
    return [c for name in features for c in (f"x_{name}", f"x_{name}_missing")]


def feature_inputs(features: Sequence[str] = schemas.FEATURES) -> SQLTransformer:
    """Adds ``x_<name>`` (double) and ``x_<name>_missing`` (0 or 1) per feature.

    Tree learners here reject NaN: a missing value becomes a sentinel below all others, and the flag
    lets a split tell it apart.
    """
    columns = ", ".join(
        f"coalesce(CAST(`{name}` AS DOUBLE), CAST({MISSING} AS DOUBLE)) AS `x_{name}`, "
        f"CAST(`{name}` IS NULL AS DOUBLE) AS `x_{name}_missing`"
        for name in features
    )
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def assembler(features: Sequence[str] = schemas.FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=input_names(features), outputCol=VECTOR, handleInvalid="error")


def feature_frame(
    df: DataFrame, keep: Sequence[str] = (), features: Sequence[str] = schemas.FEATURES
) -> DataFrame:
    """``keep`` and the flat model inputs."""
    return feature_inputs(features).transform(df).select(*keep, *input_names(features))


def category_indexer(columns: Sequence[str] = tuple(schemas.CATEGORIES)) -> StringIndexer:
    """Category codes by falling frequency (ties by name); unseen and NULL get the next code.

    A pipeline stage, which keeps the labels in the model and so on the driver: for columns with few
    categories. ``category_codes`` gives the same codes for any number.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}Index" for c in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def category_codes(
    df: DataFrame,
    columns: Sequence[str] = tuple(schemas.CATEGORIES),
    *,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``df`` with ``<column>Index`` as ``category_indexer`` gives them, labels staying in a table.

    Labels are counted before they are shuffled and ranked as a table of one row each; it is joined
    back by broadcast if it is measured to fit, else by shuffle.
    """
    for column in columns:
        counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("__label")).count()
        code = F.row_number().over(Window.orderBy(F.desc("count"), "__label")) - 1
        ranked = write_and_reopen(
            counted.select("__label", code.cast("double").alias("__code")),
            scratch_path(df.sparkSession, "category-codes"),
        )
        labels = ranked.count()
        side = F.broadcast(ranked) if fits_broadcast(ranked, broadcast_limit) else ranked
        joined = df.join(side, F.col(column) == F.col("__label"), "left")
        df = joined.withColumn(f"{column}Index", F.coalesce("__code", F.lit(float(labels)))).drop(
            "__label", "__code"
        )
    return df
