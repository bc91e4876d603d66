from __future__ import annotations

import math

import pytest
from helpers import bag
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.functions import regression_metrics
from shelfcast.modeling import (
    GBTParams,
    RunLog,
    category_indexer,
    feature_frame,
    fit,
    load_model,
    predict_store_mean,
    scored_rows,
    scoring_table,
    split_rows,
)
from shelfcast.modeling.features import assembler, input_names
from shelfcast.modeling.training import RAW


@pytest.fixture(scope="module")
def silver(spark):
    """Sales follow promotion and customers, plus a little deterministic noise."""
    i = F.col("id")
    df = spark.range(1200).select(
        i.alias("RowId"),
        (i % 20).alias("Store"),
        (i % 7 + 1).alias("DayOfWeek"),
        (i * 7919 % 101).alias("Customers"),
        (i % 2).alias("Promo"),
        (1000 * 3 * (i % 2) + 200 * (i * 7919 % 101) + i % 5).alias("Sales"),
    )
    for name in schemas.FEATURES:
        if name not in df.columns:
            df = df.withColumn(name, F.when(F.col("RowId") % 3 != 0, 1).cast("long"))
    return df.cache()


def test_missing_features_get_a_sentinel_and_a_flag(spark):
    row = {name: 2 for name in schemas.FEATURES}
    row["Promo2SinceWeek"] = None
    df = spark.createDataFrame([row], ", ".join(f"{c} long" for c in schemas.FEATURES))
    out = feature_frame(df, ["Store"])
    assert out.columns == ["Store", *input_names()]
    got = out.first()
    assert (got["x_Promo2SinceWeek"], got["x_Promo2SinceWeek_missing"]) == (-1.0, 1.0)
    assert (got["x_Store"], got["x_Store_missing"]) == (2.0, 0.0)
    vector = assembler().transform(out).first()["features"]
    assert len(vector) == 28 and not any(math.isnan(v) for v in vector)


def test_boosted_trees_beat_the_mean_and_survive_a_save(spark, silver, path):
    rows = split_rows(silver)
    model = fit(rows, GBTParams(max_iter=8, max_depth=4))
    test = rows.filter("split = 'test'")
    raw = model.transform(test)
    r2 = regression_metrics(raw, "Sales", RAW).first()["r2"]
    assert r2 > 0.9
    model.save(path)
    again = scoring_table(load_model(path).transform(test), ["RowId"])
    assert bag(again) == bag(scoring_table(raw, ["RowId"]))
    assert again.columns == ["Store", "prediction", "Real_Sales", "RowId"]
    assert dict(again.dtypes)["prediction"] == "bigint"
    assert again.count() == test.count()


def test_two_way_split_watches_the_test_rows(spark, silver):
    rows = split_rows(silver, validate_on_test=True)
    assert {r["split"] for r in rows.select("split").distinct().collect()} == {"train", "test"}
    model = fit(rows, GBTParams(max_iter=2, max_depth=2), watch="test")
    assert model.stages[-1].getNumTrees <= 2


def test_rounds_go_on_until_patience_ends_and_the_best_are_kept(spark, silver):
    rows = split_rows(silver)
    params = GBTParams(max_iter=12, patience=2, max_depth=2, step_size=0.1)
    model = fit(rows, params)
    trees = model.stages[-1].getNumTrees
    assert 3 < trees <= 12  # the first fit has 3 rounds
    watched = model.transform(rows.filter("split = 'validation'").drop(RAW))
    errors = model.stages[-1].evaluateEachIteration(
        watched.withColumn("Sales", F.col("Sales").cast("double")).drop(RAW), "squared"
    )
    assert errors.index(min(errors)) == trees - 1


def test_label_and_features_share_the_row(spark, silver):
    raw = silver.withColumn(RAW, F.col("Sales") + 0.9)
    out = scored_rows(raw, ["RowId"])
    assert out.columns == ["RowId", *schemas.FEATURES, "prediction", "Real_Sales"]
    assert out.filter("prediction <> Real_Sales").isEmpty()


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_store_means_and_the_fallback(spark, limit):
    train = spark.createDataFrame([(1, 10), (1, 20), (2, 60)], "Store long, Sales long")
    test = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (None, 0)], "Store long, Sales long")
    out = predict_store_mean(test, train, broadcast_limit=limit)
    assert bag(out) == {(1, 0, 15.0): 1, (2, 0, 60.0): 1, (3, 0, 30.0): 1, (None, 0, 30.0): 1}


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "StoreType string")
    indexer = category_indexer(["StoreType"])
    coded = indexer.fit(df).transform(df)
    assert bag(coded) == {
        ("b", 0.0): 2, ("a", 1.0): 1, ("c", 2.0): 1, (None, 3.0): 1,
    }


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_category_codes_of_a_table_are_those_of_the_indexer(spark, limit):
    from shelfcast.modeling import category_codes

    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "StoreType string")
    coded = category_codes(df, ["StoreType"], broadcast_limit=limit)
    assert bag(coded) == bag(category_indexer(["StoreType"]).fit(df).transform(df))


def test_runs_are_kept_and_the_best_is_found(spark, database):
    log = RunLog(spark, f"{database}.runs")
    log.record({"max_depth": "5"}, {"r2": 0.2, "mae": 3.0}, "/models/a", 1)
    best = log.record({"max_depth": "7"}, {"r2": 0.7, "mae": 1.0}, "/models/b", 2)
    log.record({}, {"mae": 0.5})
    assert log.runs().count() == 3
    row = log.best().first()
    assert (row["run_id"], row["model_path"], row["data_version"]) == (best, "/models/b", 2)
    assert row["params"] == {"max_depth": "7"}
    assert log.best("mae").first()["metrics"]["mae"] == 0.5
    assert log.best("mae", lowest=False).first()["metrics"]["mae"] == 3.0
    log.record({}, {"r2": float("nan"), "mae": float("nan")})
    assert log.best().first()["run_id"] == best
    assert log.best("mae").first()["metrics"]["mae"] == 0.5


def test_the_best_rounds_are_those_of_a_fit_of_so_many(spark, silver, monkeypatch, path):
    from pyspark.ml.regression import GBTRegressor

    rows, fitted = split_rows(silver), []
    original = GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: fitted.append(self.getMaxIter()) or original(self, df))
    model = fit(rows, GBTParams(max_iter=6, patience=2, max_depth=2, step_size=1.0)).stages[-1]
    best = model.getNumTrees
    assert best < fitted[-1] and fitted == sorted(set(fitted))  # no fit is repeated for the best number of rounds
    again = fit(rows.filter("split = 'train'"), GBTParams(max_iter=best, patience=2, max_depth=2, step_size=1.0)).stages[-1]
    assert model.toDebugString.split("\n", 1)[1] == again.toDebugString.split("\n", 1)[1]
    assert (model.treeWeights, model.getMaxIter(), model.numFeatures) == (again.treeWeights, best, again.numFeatures)
    model.write().save(path)
    assert type(model).load(path).treeWeights == model.treeWeights
