"""Key-dropping left joins: semantics, and every strategy against plain Python."""

from __future__ import annotations

import random

import pytest
from helpers import bag
from pyspark.sql import functions as F

from shelfcast import schemas, sizing
from shelfcast.operators import (
    enrich,
    fanout_rows,
    keep_right_key_left_join,
    lookup_left_join,
    spread_left_join,
    with_states,
    with_stores,
)
from shelfcast.operators.joins import hot_keys


def brute_force(left, right):
    """(key, payload) rows joined by hand; the key kept is the right one."""
    out = []
    for key, payload in left:
        partners = [r for r in right if key is not None and r[0] == key]
        out += [(payload, *r) for r in partners] or [(payload, None, None)]
    return sorted(out, key=repr)


def test_unmatched_row_loses_its_key(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "Store long, p string")
    b = spark.createDataFrame([(1, "s1"), (2, "s2")], "Store long, State string")
    out = keep_right_key_left_join(a, b, "Store")
    assert out.columns == ["p", "Store", "State"]
    assert bag(out) == {("x", 1, "s1"): 1, ("y", 2, "s2"): 1, ("z", None, None): 1}


def test_same_as_star_except_in_sql(spark):
    a = spark.createDataFrame([(1, "x"), (3, "z")], "Store long, p string")
    b = spark.createDataFrame([(1, "s1"), (2, "s2")], "Store long, State string")
    by_sql = spark.sql(
        "SELECT * EXCEPT (l.Store) FROM {a} l LEFT JOIN {b} r ON l.Store = r.Store", a=a, b=b
    )
    ours = keep_right_key_left_join(a, b, "Store")
    assert ours.columns == by_sql.columns
    assert bag(ours) == bag(by_sql)


def test_store_missing_from_states_gets_no_store_attributes(spark):
    tx = spark.createDataFrame([(1, 10), (3, 30), (None, 5)], "Store long, Sales long")
    states = spark.createDataFrame([(1, "BY"), (2, "HE")], "Store long, State string")
    stores = spark.createDataFrame([(1, "a"), (3, "c")], "Store long, StoreType string")
    chained = with_stores(with_states(tx, states), stores)
    expected = {(10, "BY", 1, "a"): 1, (30, None, None, None): 1, (5, None, None, None): 1}
    assert chained.columns == ["Sales", "State", "Store", "StoreType"]
    assert bag(chained) == expected
    for limit in (0, sizing.BROADCAST_LIMIT):
        at_once = enrich(tx, states, stores, broadcast_limit=limit)
        assert at_once.columns == chained.columns
        assert bag(at_once) == expected


@pytest.mark.parametrize("seed", range(4))
def test_one_join_equals_two_also_with_repeated_and_null_lookup_keys(spark, seed):
    rng = random.Random(seed)
    keys = [None, 1, 2, 3, 4, 5, 6]
    tx = spark.createDataFrame(
        [(rng.choice(keys), i) for i in range(40)], "Store long, Sales long"
    )
    states = spark.createDataFrame(
        [(rng.choice(keys), f"s{i}") for i in range(6)], "Store long, State string"
    )
    stores = spark.createDataFrame(
        [(rng.choice(keys), f"t{i}") for i in range(6)], "Store long, StoreType string"
    )
    chained = with_stores(with_states(tx, states), stores)
    for limit in (0, sizing.BROADCAST_LIMIT):
        assert bag(enrich(tx, states, stores, broadcast_limit=limit)) == bag(chained)


def test_repeated_right_key_multiplies_rows(spark):
    silver = spark.createDataFrame([(1, i) for i in range(3)], "Store long, Sales long")
    scoring = spark.createDataFrame([(1, 7), (1, 8)], "Store long, prediction long")
    out = lookup_left_join(silver, scoring, "Store")
    assert out.count() == 6
    assert fanout_rows(silver, scoring, "Store").first()["n_rows"] == 6


def test_row_count_is_kept_when_right_key_is_unique(spark):
    left = spark.range(1000).select((F.col("id") % 90).alias("k"), F.col("id").alias("p"))
    right = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for limit in (0, sizing.BROADCAST_LIMIT):
        assert lookup_left_join(left, right, "k", broadcast_limit=limit).count() == 1000


@pytest.mark.parametrize("hot_side", ["left", "right", "both", "none", "copies"])
def test_spread_join_equals_brute_force(spark, hot_side):
    rng = random.Random(hot_side)
    left = [(rng.choice([None, *range(40)]), i) for i in range(120)]
    right = [(rng.randrange(45), f"r{i}") for i in range(60)]
    if hot_side in ("left", "both"):
        left += [(7, 1000 + i) for i in range(80)]
    if hot_side in ("right", "both"):
        right += [(7, f"h{i}") for i in range(40)]
    if hot_side == "copies":
        left += [(9, 5)] * 90
    a = spark.createDataFrame(left, "k long, p long").repartition(5)
    b = spark.createDataFrame(right, "k long, v string").repartition(3)
    share = 0.9 if hot_side == "none" else 0.2
    out = spread_left_join(a, b, "k", hot_share=share)
    assert out.columns == ["p", "k", "v"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_force(left, right)
    assert fanout_rows(a, b, "k").first()["n_rows"] == len(brute_force(left, right))


def test_hot_key_on_the_right_only_and_absent_left(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k long, p long")
    b = spark.createDataFrame([(9, f"h{i}") for i in range(30)] + [(1, "x")], "k long, v string")
    out = spread_left_join(a, b, "k", hot_share=0.1)
    assert bag(out) == {(10, 1, "x"): 1, (20, None, None): 1}


def test_hot_keys_finds_the_heavy_ones(spark):
    rows = [(1,)] * 50 + [(2,)] * 30 + [(i,) for i in range(100, 120)] + [(None,)] * 40
    found = hot_keys(spark.createDataFrame(rows, "k long"), "k", 0.2)
    assert [(k, round(s, 2)) for k, s in found] == [(1, 0.5), (2, 0.3)]
    assert hot_keys(spark.createDataFrame([], "k long"), "k") == []


def test_hot_rows_are_spread_over_tasks(spark):
    left = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("p")
    )
    right = spark.range(4000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = spread_left_join(left, right, "k")
        sizes = out.filter("k = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 2001  # id 1 is one of the odd ones
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2001


def test_a_key_of_less_than_a_percent_is_spread_where_tasks_are_many(spark):
    """400 partitions, a key of 0.9 per cent: 3.6 times a task's mean share."""
    left = spark.range(40_000).select(
        F.when(F.col("id") < 360, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("p")
    )
    right = left.select("k").distinct().withColumn("v", F.lit("x"))
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "400",
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert [k for k, _ in hot_keys(left, "k")] == [-1]
        out = spread_left_join(left, right, "k")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k in settings:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(sizes) == 40_000 and max(sizes) < 2.5 * 100


def test_shared_columns_are_refused(spark):
    a = spark.createDataFrame([(1, 2)], "k long, p long")
    with pytest.raises(ValueError, match="both sides"):
        keep_right_key_left_join(a, a, "k")


def test_measured_bytes_grow_with_the_data(spark):
    small = spark.range(10).selectExpr("id", "repeat('x', 100) AS s")
    large = spark.range(1000).selectExpr("id", "repeat('x', 100) AS s")
    assert 1000 < sizing.measured_bytes(small) < sizing.measured_bytes(large) / 50
    assert sizing.fits_broadcast(small, 10_000) and not sizing.fits_broadcast(large, 10_000)
    assert sizing.measured_bytes(spark.range(3).selectExpr("array(id) AS a")) is None
    assert sizing.measured_bytes(spark.createDataFrame([], "k long")) == 0


def test_column_lists_of_the_data_model():
    assert schemas.TRANSACTIONS_AND_STATES_COLUMNS == [
        "DayOfWeek", "Date", "Sales", "Customers", "Open", "Promo", "StateHoliday",
        "SchoolHoliday", "Store", "State", "Latitude", "Longitude",
    ]
    assert len(schemas.SILVER_COLUMNS) == 21
    assert schemas.SILVER_COLUMNS[:8] == schemas.TRANSACTIONS_AND_STATES_COLUMNS[:8]
    assert schemas.SILVER_COLUMNS[8:12] == ["State", "Latitude", "Longitude", "Store"]
    assert schemas.GOLD_COLUMNS[-3:] == ["Store", "prediction", "Real_Sales"]
