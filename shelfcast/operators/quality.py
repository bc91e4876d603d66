"""Profiling: null counts, grouped medians, counts and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.expressions import null_flag
from ..workspace import scratch_path, write_and_reopen

_FIRST = Window.unboundedPreceding


def null_profile(df: DataFrame) -> DataFrame:
    """``column_name, n_nulls`` for every column, all counted in one pass."""
    counts = df.selectExpr(*[f"count_if(`{c}` IS NULL) AS `{c}`" for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "n_nulls")


def null_count(df: DataFrame, column: str) -> DataFrame:
    """One row ``<column>_NULL``. A sum over CASE: NULL, not 0, when there are no rows at all."""
    return df.agg(F.sum(null_flag(column)).alias(f"{column}_NULL"))


def row_count(df: DataFrame, condition: Column | str | None = None) -> DataFrame:
    kept = df if condition is None else df.filter(condition)
    return kept.agg(F.count(F.lit(1)).alias("n_rows"))


def preview(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-n per task, then a merge; no full sort)."""
    return df.orderBy(*order_by).limit(n)


def approx_grouped_median(
    df: DataFrame, group: str, value: str, accuracy: int = 10_000
) -> DataFrame:
    """``group, median``: an actual element within ``1/accuracy`` of the middle rank.

    NULL groups are left out. Tasks merge sketches of fixed size, so a group may be any size.
    """
    known = df.filter(F.col(group).isNotNull())
    return known.groupBy(group).agg(F.percentile_approx(value, 0.5, accuracy).alias("median"))


def exact_grouped_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """``group, median`` as double: the middle element, or the mean of the middle two.

    The built-in exact median holds a group's values in one task. Here the rows are first reduced to
    counts of distinct values, combined before the shuffle. These are range-partitioned by group and
    value and written once with the number of their partition; counts per partition tell which one
    holds the middle rank of each group, and only the values there are ranked. A group whose values
    are all NULL has the median NULL.
    """
    known = df.filter(F.col(group).isNotNull())
    counts = known.groupBy(F.col(group), F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    everything = write_and_reopen(
        counts.repartitionByRange(group, "__v").withColumn("__slot", F.spark_partition_id()),
        scratch_path(df.sparkSession, "value-counts"),
    )
    counted = everything.filter(F.col("__v").isNotNull())
    void = everything.groupBy(group).agg(F.count("__v").alias("n")).filter("n = 0")
    # Ranks of the middle element, or of the middle two.
    lower, upper = F.floor((F.col("__n") + 1) / 2), F.floor((F.col("__n") + 2) / 2)
    by_slot = Window.partitionBy(group).orderBy("__slot")
    slots = (
        counted.groupBy(group, "__slot")
        .agg(F.sum("__c").alias("__held"))
        .withColumn("__upto", F.sum("__held").over(by_slot.rowsBetween(_FIRST, 0)))
        .withColumn("__n", F.sum("__held").over(Window.partitionBy(group)))
        .withColumn("__before", F.col("__upto") - F.col("__held"))
    )
    holding = slots.filter((F.col("__before") < upper) & (F.col("__upto") >= lower))
    by_value = Window.partitionBy(group, "__slot").orderBy("__v")
    ranked = counted.join(holding, [group, "__slot"]).withColumn(
        "__rank", F.col("__before") + F.sum("__c").over(by_value.rowsBetween(_FIRST, 0))
    )

    def value_at(rank: Column) -> Column:
        return F.min(F.when(F.col("__rank") >= rank, F.col("__v"))).cast("double")

    medians = ranked.groupBy(group).agg(((value_at(lower) + value_at(upper)) / 2).alias("median"))
    return medians.unionByName(void.select(group, F.lit(None).cast("double").alias("median")))
