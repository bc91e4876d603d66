"""The plans Spark makes of the queries: what is read, what is pushed down, what is shuffled."""

from __future__ import annotations

import re

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from shelfcast.operators import approx_grouped_median, delete_where, enrich, null_profile
from shelfcast.plans.registry import QUERIES
from shelfcast.sources import retail

SF = "/root/testdata/sf0.01"


def silver(spark, **options):
    tables = (retail.transactions, retail.states, retail.stores)
    return enrich(*[t(spark, SF) for t in tables], **options)


def test_enrichment_reads_the_fact_once_and_does_not_shuffle_it(spark):
    plan = plan_of(silver(spark))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 4  # orders, customer x2, nation


def test_median_reads_two_columns_of_the_fact(spark):
    plan = plan_of(approx_grouped_median(silver(spark), "StoreType", "Sales"))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan
    assert "ObjectHashAggregate" in plan and plan.count("Exchange hashpartitioning") <= 3


def test_profile_is_one_aggregate(spark):
    plan = plan_of(null_profile(silver(spark)))
    assert plan.count("HashAggregate (") <= 6 and "Python" not in plan
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 4


def test_beyond_the_broadcast_limit_the_fact_is_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(silver(spark, broadcast_limit=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Arguments: hashpartitioning\(([^\n]*)", plan)
    assert len([e for e in exchanges if "__left_key" in e]) == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_delete_predicate_reaches_the_scan(spark, path):
    silver(spark).write.parquet(path)
    kept = delete_where(spark.read.parquet(path), "CompetitionOpenSinceMonth IS NULL")
    assert "IsNotNull(CompetitionOpenSinceMonth)" in plan_of(kept.select("Sales"))
    over = delete_where(spark.read.parquet(path), "Sales > 5").select("Sales")
    assert "PushedFilters: [Or(LessThanOrEqual(Sales,5),IsNull(Sales))]" in plan_of(over)
    assert "PushedFilters: [IsNotNull(Store), LessThan(Store,50)]" in plan_of(
        spark.read.parquet(path).filter(F.col("Store") < 50)
    )


@pytest.mark.parametrize(
    "name",
    ["enrich_stores", "silver_cleaned", "add_sales_per_customer", "feature_matrix", "gold_fanout"],
)
def test_no_python_and_no_cartesian_product(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("Python", "Cartesian", "NestedLoop", "SinglePartition"):
        assert bad not in plan
