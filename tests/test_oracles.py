"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

from importlib import import_module

import pytest
from check_oracles import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from shelfcast.plans.oracles import ORACLES
from shelfcast.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    good, note = compare(spark, con, name, SF)
    assert good, note


@pytest.mark.parametrize(
    "name",
    ["enrich_states", "enrich_stores", "upsert_stores", "scoring_baseline", "gold_fanout", "gold_by_row"],
)
def test_query_matches_sql_without_any_broadcast(spark, con, name, monkeypatch):
    for module in ("enrich", "gold", "joins", "mutations"):
        target = import_module(f"shelfcast.operators.{module}")
        monkeypatch.setattr(target, "fits_broadcast", lambda df, limit=0: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        good, note = compare(spark, con, name, SF)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert good, note


def test_every_query_but_the_models_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"gbt_scoring", "boosted_scoring"}
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry_gives_one_row_per_store_type(spark):
    df = entry(spark)
    assert df.columns == ["StoreType", "median"]
    assert df.count() == 4


def test_expected_values_of_the_retail_mapping(spark):
    """Counts at sf0.01 as worked out by hand in FIXTURES.md."""
    from shelfcast.plans import registry

    sf = "/root/testdata/sf0.01"
    nulls = {r["column_name"]: r["n_nulls"] for r in registry.silver_null_profile(spark, sf).collect()}
    assert nulls["Store"] == 1782 and nulls["State"] == 1481
    assert nulls["CompetitionOpenSinceMonth"] == 6124
    assert nulls["Promo2SinceWeek"] == 7741 and nulls["CompetitionDistance"] == 3016
    assert registry.delete_null_competition(spark, sf).count() == 8876
    exact = {
        r["StoreType"]: r["median"]
        for r in registry.median_sales_by_store_type_exact(spark, sf).collect()
    }
    assert exact == {"a": 248601.0, "b": 252141.0, "c": 257662.0, "d": 250190.5}
    assert registry.gold_store_level_rows(spark, sf).first()["n_rows"] == 24348
    gold = registry.gold_store_level(spark, sf)
    assert gold.filter("prediction IS NOT NULL").count() == 23740
