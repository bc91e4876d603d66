from __future__ import annotations

import pytest
from helpers import bag
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.modeling import GBTParams
from shelfcast.operators import VersionedTable, fanout_rows, gold_fanout
from shelfcast.operators.gold import FanoutTooLarge
from shelfcast.plans.flows import Tables, batch_flow, forecast_flow, stream_flow
from shelfcast.sources import retail

SF = "/root/testdata/sf0.001"
FAST = GBTParams(max_iter=2, max_depth=3)


def test_batch_flow(spark, database, path):
    tx, states, stores = (f(spark, SF) for f in (retail.transactions, retail.states, retail.stores))
    metrics = batch_flow(spark, database, tx, states, stores, f"{path}/model", params=FAST, gold_mode="store")
    names = Tables(database)
    assert metrics["n_rows"] == spark.table(names.scoring).count() == 202
    silver = VersionedTable(spark, names.silver)
    assert silver.head() == 3
    assert silver.current().count() == 856
    assert silver.current().filter("CompetitionDistance IS NULL OR Promo2SinceWeek IS NULL").isEmpty()
    gold = spark.table(names.gold)
    assert gold.count() == 2169
    assert gold.columns == ["RowId", *schemas.GOLD_COLUMNS]
    run = spark.table(names.runs).first()
    assert run["data_version"] == 3 and set(run["metrics"]) == {"n_rows", "n_left_out", "mae", "mse", "r2"}

    before = bag(spark.table(names.scoring))
    forecast_flow(spark, database, f"{path}/model")
    assert bag(spark.table(names.scoring)) == before
    by_row = spark.table(names.gold)
    assert by_row.count() == 856
    assert by_row.filter("prediction IS NOT NULL").count() == 202
    assert by_row.filter("Real_Sales <> Sales").isEmpty()

    # The flow can be run again over its own database.
    again = batch_flow(spark, database, tx, states, stores, f"{path}/model", params=FAST)
    assert again == metrics
    assert spark.table(names.runs).count() == 2


def test_stream_flow_without_a_row_key(spark, database, path):
    tx = retail.transactions(spark, SF).select(*schemas.TRANSACTIONS.names)
    tx.withColumn("Date", F.col("Date").cast("timestamp")).repartition(3).write.parquet(f"{path}/in")
    report = stream_flow(
        spark,
        database,
        f"{path}/in",
        retail.states(spark, SF),
        retail.stores(spark, SF),
        f"{path}/model",
        f"{path}/checkpoint",
        params=FAST,
        retain_hours=0.0,
    )
    names = Tables(database)
    assert spark.table(names.bronze_transactions).count() == 1500
    silver = VersionedTable(spark, names.silver)
    assert silver.current().columns == [*schemas.SILVER_COLUMNS, "SalesPerCustomer"]
    assert report.nulls_before_delete == 1500 - 856
    counts = {r["column_name"]: r["n_nulls"] for r in report.null_counts.collect()}
    assert counts["CompetitionOpenSinceMonth"] == 1500 - 856 and counts["Sales"] == 0
    assert {r["StoreType"] for r in report.median_sales.collect()} == set("abcd")
    assert [r["operation"] for r in report.history.collect()] == [
        "UPDATE", "ADD COLUMNS", "UPDATE", "DELETE", "CREATE TABLE AS SELECT",
    ]
    assert report.expired == [0, 1, 2, 3]
    scoring, gold = spark.table(names.scoring), spark.table(names.gold)
    assert scoring.columns == schemas.SCORING_COLUMNS
    assert gold.columns == [
        *[c for c in schemas.SILVER_COLUMNS if c != "Store"], "SalesPerCustomer", *schemas.SCORING_COLUMNS,
    ]
    expected = int(fanout_rows(silver.current(), scoring, "Store").first()["n_rows"])
    assert gold.count() == expected


def test_fanout_beyond_the_budget_is_refused_whole(spark):
    silver = spark.createDataFrame([(1, i) for i in range(5)], "Store long, Sales long")
    scoring = spark.createDataFrame(
        [(1, i, i) for i in range(4)], "Store long, prediction long, Real_Sales long"
    )
    assert gold_fanout(silver, scoring, row_budget=20).count() == 20
    with pytest.raises(FanoutTooLarge, match="20 rows"):
        gold_fanout(silver, scoring, row_budget=19)
    spread = gold_fanout(silver, scoring, broadcast_limit=0, hot_share=0.5)
    assert bag(spread) == bag(gold_fanout(silver, scoring))
