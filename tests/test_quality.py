from __future__ import annotations

import math
import random
import statistics

import pytest
from helpers import bag
from pyspark.sql import functions as F

from shelfcast.functions import regression_metrics, split_label, truncated
from shelfcast.operators import (
    approx_grouped_median,
    exact_grouped_median,
    null_count,
    null_profile,
    preview,
    row_count,
)


def test_null_profile_counts_every_column(spark):
    rows = [(1, None, "x"), (None, None, "y"), (3, 1.5, "z")]
    df = spark.createDataFrame(rows, "a long, b double, c string")
    assert bag(null_profile(df)) == {("a", 1): 1, ("b", 2): 1, ("c", 0): 1}
    nan = spark.createDataFrame([(float("nan"),)], "b double")
    assert bag(null_profile(nan)) == {("b", 0): 1}


def test_null_count_of_no_rows_is_null(spark):
    empty = spark.createDataFrame([], "m long")
    assert null_count(empty, "m").first()["m_NULL"] is None
    assert bag(null_profile(empty)) == {("m", 0): 1}
    some = spark.createDataFrame([(1,), (None,)], "m long")
    assert null_count(some, "m").first()["m_NULL"] == 1


def test_medians_of_an_even_group(spark):
    df = spark.createDataFrame(
        [("a", v) for v in (1, 2, 3, 10)] + [("b", 5), (None, 9)], "g string, v long"
    )
    assert bag(approx_grouped_median(df, "g", "v")) == {("a", 2): 1, ("b", 5): 1}
    assert bag(exact_grouped_median(df, "g", "v")) == {("a", 2.5): 1, ("b", 5.0): 1}


@pytest.mark.parametrize("partitions", [1, 7, 100])
def test_exact_median_equals_statistics_median(spark, partitions):
    rng = random.Random(partitions)
    groups = {
        "one": [4],
        "two": [1, 9],
        "ties": [7] * 500 + [1, 2, 3],
        "half": [1] * 50 + [2] * 50,
        "wide": [rng.randrange(10**9) for _ in range(5001)],
        "even": [rng.randrange(-1000, 1000) for _ in range(4000)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("one", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v long").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r["g"]: r["median"] for r in exact_grouped_median(df, "g", "v").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {g: float(statistics.median(values)) for g, values in groups.items()}


def test_exact_median_of_fractions_and_infinities(spark):
    values = [float("-inf"), -0.5, 0.25, 0.25, 1.5, float("inf")]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    assert exact_grouped_median(df, "g", "v").first()["median"] == 0.25


def test_exact_median_keeps_a_group_of_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None)], "g string, v long")
    assert bag(exact_grouped_median(df, "g", "v")) == {("a", 2.0): 1, ("b", None): 1}


def test_metrics_leave_out_rows_without_a_prediction(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 1.0), (1000, None)], "y long, p double")
    row = regression_metrics(df, "y", "p").first()
    assert (row["n_rows"], row["n_left_out"], row["mae"], row["r2"]) == (2, 1, 1.0, -3.0)


def test_split_of_timestamps_does_not_follow_the_time_zone(spark):
    seconds = spark.range(500).select((F.col("id") * 7919 * 60).alias("s"))
    labels = []
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = seconds.select("s", F.timestamp_seconds("s").alias("t"))
            labels.append(dict(df.select("s", split_label(["t"], schema=df.schema)).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert labels[0] == labels[1] and len(set(labels[0].values())) == 3


def test_row_count_and_preview(spark):
    df = spark.range(10)
    assert row_count(df).first()["n_rows"] == 10
    assert row_count(df, "id >= 4").first()["n_rows"] == 6
    assert [r["id"] for r in preview(df.orderBy(F.desc("id")), 3, "id").collect()] == [0, 1, 2]


def test_truncation_goes_toward_zero_and_nan_is_null(spark):
    df = spark.createDataFrame([(-1.7,), (1.9,), (float("nan"),), (None,), (1e30,)], "p double")
    got = [r[0] for r in df.select(truncated("p")).collect()]
    assert got == [-1, 1, None, None, None]


def test_metrics_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = spark.range(500).select(
        (F.col("id") % 37 + 1e6).alias("y"), (F.col("id") % 41 + 1e6).cast("double").alias("p")
    )
    row = regression_metrics(df, "y", "p").first()
    assert row["n_rows"] == 500
    for metric in ("mae", "mse", "r2"):
        wanted = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=metric).evaluate(df)
        assert math.isclose(row[metric], wanted, rel_tol=1e-6), metric


def test_metrics_of_a_constant_label(spark):
    exact = spark.createDataFrame([(2.0, 2.0)] * 3, "y double, p double")
    wrong = spark.createDataFrame([(2.0, 3.0)] * 3, "y double, p double")
    assert regression_metrics(exact, "y", "p").first()["r2"] == 1.0
    assert regression_metrics(wrong, "y", "p").first()["r2"] == 0.0


def test_split_is_complete_stable_and_near_its_shares(spark):
    df = spark.range(8000).withColumn("part", split_label(["id"]))
    first = {r["id"]: r["part"] for r in df.collect()}
    again = {r["id"]: r["part"] for r in df.repartition(13).collect()}
    assert first == again and len(first) == 8000
    share = {p: list(first.values()).count(p) / 8000 for p in ("train", "validation", "test")}
    assert abs(share["test"] - 0.25) < 0.02 and abs(share["validation"] - 0.15) < 0.02
    assert math.isclose(sum(share.values()), 1.0)
    two_way = spark.range(8000).withColumn("part", split_label(["id"], 4, 0))
    tests = {r["id"] for r in two_way.filter("part = 'test'").collect()}
    assert tests == {k for k, p in first.items() if p == "test"}


def test_split_tells_null_keys_from_empty_ones(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    from shelfcast.functions.split import hash_bucket

    buckets = [r[0] for r in df.select(hash_bucket(["x", "y"], 2**31)).collect()]
    assert len(set(buckets)) == 3
