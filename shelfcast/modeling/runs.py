"""Training runs as rows of a table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Metrics that are better the lower they are.
ERRORS = frozenset({"mae", "mse", "rmse", "loss"})

_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("model_path", T.StringType()),
        T.StructField("data_version", T.LongType()),
    ]
)


class RunLog:
    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table = spark, table

    def record(
        self,
        params: Mapping[str, str],
        metrics: Mapping[str, float],
        model_path: str | None = None,
        data_version: int | None = None,
    ) -> str:
        """Append one run; returns its id."""
        run_id = uuid.uuid4().hex
        row = (
            run_id,
            datetime.now(timezone.utc),
            dict(params),
            {k: float(v) for k, v in metrics.items()},
            model_path,
            data_version,
        )
        self.spark.createDataFrame([row], _SCHEMA).write.mode("append").saveAsTable(self.table)
        return run_id

    def runs(self) -> DataFrame:
        return self.spark.table(self.table)

    def best(self, metric: str = "r2", lowest: bool | None = None) -> DataFrame:
        """The run with the best value of a metric (ties: the earliest); NULL and NaN are no values.

        Best is the lowest for the metrics in ``ERRORS`` and the highest for others, unless stated.
        """
        value = F.col("metrics")[metric]
        order = value.asc() if (metric in ERRORS if lowest is None else lowest) else value.desc()
        known = value.isNotNull() & ~F.isnan(value)
        return self.runs().filter(known).orderBy(order, "recorded_at").limit(1)
