from __future__ import annotations

import pytest
from helpers import bag
from pyspark.sql import functions as F

from shelfcast.functions import ratio
from shelfcast.operators import (
    add_column,
    changed_rows,
    delete_where,
    fill_nulls,
    keyed_changes,
    null_profile,
    update_where,
    upsert,
)


def test_delete_keeps_rows_where_the_predicate_is_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a long")
    assert bag(delete_where(df, "a > 2")) == {(1,): 1, (None,): 1}


def test_delete_then_profile_finds_no_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "m long, o long")
    profile = dict(bag(null_profile(delete_where(df, "m IS NULL OR m IS NULL"))).keys())
    assert profile == {"m": 0, "o": 1}


def test_update_touches_only_true_rows_and_keeps_order_and_types(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 5, "y")], "a long, w long, s string")
    out = update_where(df, {"w": "0"}, "w IS NULL")
    assert out.dtypes == df.dtypes
    assert bag(out) == {(1, 0, "x"): 1, (2, 5, "y"): 1}
    unknown = update_where(df, {"a": "9"}, "w > 1")
    assert bag(unknown) == {(1, None, "x"): 1, (9, 5, "y"): 1}


def test_update_reads_the_old_row(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert bag(update_where(df, {"a": "b", "b": "a"})) == {(2, 1): 1}
    with pytest.raises(ValueError):
        update_where(df, {"c": "1"})


def test_fill_equals_update_where_null(spark):
    df = spark.createDataFrame([(None, 1.0), (3, float("nan")), (4, None)], "w long, d double")
    assert bag(fill_nulls(df, {"w": 0}).select("w")) == bag(
        update_where(df, {"w": "0"}, "w IS NULL").select("w")
    )
    assert df.filter("isnan(d)").count() == fill_nulls(df, {"d": 1.0}).filter("isnan(d)").count()


def test_sales_per_customer(spark):
    df = spark.createDataFrame([(10, 2), (20, 0), (30, None)], "Sales long, Customers long")
    out = update_where(add_column(df, "spc", "double"), {"spc": ratio("Sales", "Customers")})
    assert out.dtypes[-1] == ("spc", "double")
    assert [r["spc"] for r in out.orderBy("Sales").collect()] == [5.0, None, None]
    with pytest.raises(ValueError):
        add_column(df, "sales", "double")


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_upsert_updates_inserts_and_ignores_null_keys(spark, limit):
    target = spark.createDataFrame([(1, "a"), (2, None), (2, "dup"), (None, "n")], "k long, v string")
    source = spark.createDataFrame([(2, "new"), (3, "c"), (None, "m")], "k long, v string")
    out = upsert(target, source, ["k"], broadcast_limit=limit)
    assert bag(out) == {
        (1, "a"): 1, (2, "new"): 2, (None, "n"): 1, (3, "c"): 1, (None, "m"): 1,
    }


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_upsert_with_a_hot_key_and_with_two_keys(spark, limit):
    hot = spark.range(300).selectExpr("if(id % 2 = 0, 1, id) AS k", "id AS v")
    source = spark.createDataFrame([(1, -1), (1000, -2)], "k long, v long")
    out = upsert(hot, source, ["k"], broadcast_limit=limit)
    assert out.columns == ["k", "v"]
    got = bag(out)
    assert got[(1, -1)] == 151 and got[(1000, -2)] == 1 and sum(got.values()) == 301
    two = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k long, l long, v string")
    news = spark.createDataFrame([(1, 2, "c"), (2, 2, "d")], "k long, l long, v string")
    assert bag(upsert(two, news, ["k", "l"], broadcast_limit=limit)) == {
        (1, 1, "a"): 1, (1, 2, "c"): 1, (2, 2, "d"): 1,
    }


def test_upsert_can_set_null_and_takes_columns_by_name(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    source = spark.createDataFrame([(None, 1)], "v string, k long")
    assert bag(upsert(target, source, ["k"])) == {(1, None): 1}


def test_upsert_refuses_a_repeated_source_key(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    with pytest.raises(ValueError, match="more than one row"):
        upsert(target, spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string"), ["k"])


def test_changed_rows_counts_copies_and_treats_nulls_as_equal(spark):
    old = spark.createDataFrame([(1, None)] * 3 + [(2, "x")], "a long, b string")
    new = spark.createDataFrame([(1, None)] * 5 + [(3, "y")], "a long, b string")
    assert bag(changed_rows(old, new)) == {
        (1, None, "added", 2): 1, (2, "x", "removed", 1): 1, (3, "y", "added", 1): 1,
    }
    assert changed_rows(old, old).isEmpty()


def test_keyed_changes(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k long, s string, n long")
    new = spark.createDataFrame([(1, "a", None), (2, None, 1), (4, "d", 1)], "k long, s string, n long")
    assert bag(keyed_changes(old, new, ["k"])) == {
        (2, "update"): 1, (3, "delete"): 1, (4, "insert"): 1,
    }
    with pytest.raises(Exception, match="repeated key"):
        keyed_changes(old.union(old), new, ["k"]).collect()


def test_keyed_changes_compares_values_not_texts(spark):
    from shelfcast.operators import keyed_changes

    rows = "id long, a string, b string, t timestamp"
    old = spark.createDataFrame(
        [(1, None, "x", None), (2, "p\x1fq", "r", None), (3, "same", "same", None)], rows
    )
    new = spark.createDataFrame(
        [(1, "\\N", "x", None), (2, "p", "q\x1fr", None), (3, "same", "same", None)], rows
    )
    assert bag(keyed_changes(old, new, ["id"])) == {(1, "update"): 1, (2, "update"): 1}
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # an hour that a clock change repeats
        one, other = (
            spark.range(1).select("id", F.timestamp_seconds(F.lit(s)).alias("t"))
            for s in (1_730_611_800, 1_730_615_400)
        )
        assert bag(keyed_changes(one, other, ["id"])) == {(0, "update"): 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_keyed_changes_of_arrays_and_structs(spark):
    from shelfcast.operators import keyed_changes

    old = spark.createDataFrame([(1, [1, 2]), (2, [3]), (3, None)], "id long, a array<long>")
    new = spark.createDataFrame([(1, [1, 2]), (2, [4]), (3, [])], "id long, a array<long>")
    assert bag(keyed_changes(old, new, ["id"])) == {(2, "update"): 1, (3, "update"): 1}


def test_update_ignores_the_case_of_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "id long, v long")
    assert bag(update_where(df, {"V": "7"}, "ID = 1")) == {(1, 7): 1}
