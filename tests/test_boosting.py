"""The regularised learner against a plain numpy version that visits every split of every node."""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.modeling import BoostParams, Node, TreeModel, fit_boosted, load_model
from shelfcast.modeling import boosting

FEATURES = ["a", "b", "c"]
SMALL = BoostParams(max_iter=4, patience=100, max_leaves=8, max_depth=4, block_rounds=2, max_bins=128)


def table(spark, rows):
    """Rows (split, label, a, b, c) with columns whose names clash with the learner's own."""
    df = spark.createDataFrame(rows, "split string, Sales double, a double, b double, c double")
    return df.withColumn("bins", F.lit("own")).withColumn("margin", F.lit("own")).withColumn("node", F.lit("own"))


def sample(n=400, seed=0, missing=0.2):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 6, n), rng.integers(0, 30, n) / 4, rng.normal(size=n).round(1)], 1)
    y = 50 * (x[:, 0] > 2) + 9 * x[:, 1] + rng.normal(size=n) * 5
    x[rng.random(x.shape) < missing] = np.nan
    y = np.where(np.isnan(x[:, 1]), y - 300, y).round(3)
    split = np.where(rng.random(n) < 0.25, "validation", "train")
    return [(s, float(t), *(None if np.isnan(v) else float(v) for v in r)) for s, t, r in zip(split, y, x, strict=True)]


def shrunk(g, params):
    return math.copysign(max(abs(g) - params.alpha, 0.0), g)


def score(g, h, params):
    return shrunk(g, params) ** 2 / (h + params.reg_lambda)


def plain_split(x, g, values, params):
    best = None
    for f in range(x.shape[1]):
        for k, v in enumerate(values[f]):
            for missing_left in (True, False):
                known = ~np.isnan(x[:, f])
                left = np.where(known, x[:, f] <= v, missing_left)
                h = left.sum(), (~left).sum()
                if min(h) < max(params.min_child_weight, 1):
                    continue
                sides = math.fsum(g[left]), math.fsum(g[~left])  # rounded once: equal parts have equal sums
                gain = score(sides[0], h[0], params) + score(sides[1], h[1], params) - score(math.fsum(g), len(g), params)
                if gain > params.min_gain and (best is None or gain > best[0]):
                    following = values[f][k + 1] if k + 1 < len(values[f]) else np.inf
                    best = gain, f, following, missing_left, left
    return best


def plain_boosting(rows, params):
    """(base, per round the prediction of each row, errors), strictly best first."""
    train = np.array([r[0] == "train" for r in rows])
    y = np.array([r[1] for r in rows])
    x = np.array([[np.nan if v is None else v for v in r[2:]] for r in rows], float)
    values = [sorted(set(x[train][:, f][~np.isnan(x[train][:, f])])) for f in range(x.shape[1])]
    base = y[train].mean() if params.base_score is None else params.base_score
    margin, rounds, errors = np.full(len(y), float(base)), [], []
    for _ in range(params.max_iter):
        g = margin - y
        leaves = [(np.ones(len(y), bool), 0)]

        def offer(leaf, g=g):
            rows_in, depth = leaf
            used = rows_in & train
            return plain_split(x[used], g[used], values, params) if depth < params.max_depth else None

        splits = [offer(leaves[0])]
        while len(leaves) < params.max_leaves and any(splits):
            i = max((s[0], -k) for k, s in enumerate(splits) if s)[1] * -1
            _, f, threshold, missing_left, _ = splits[i]
            (rows_in, depth), value = leaves[i], x[:, f]
            left = np.where(np.isnan(value), missing_left, value < threshold)
            leaves[i], splits[i] = (rows_in & left, depth + 1), None
            leaves.append((rows_in & ~left, depth + 1))
            splits[i] = offer(leaves[i])
            splits.append(offer(leaves[-1]))
        for rows_in, _ in leaves:
            used = rows_in & train
            margin = margin + rows_in * -shrunk(g[used].sum(), params) / (used.sum() + params.reg_lambda) * params.step_size
        rounds.append(margin)
        errors.append(((margin - y)[~train] ** 2).mean())
    return base, rounds, errors


def predicted(model, df):
    return np.array([r[0] for r in df.select(model.prediction()).collect()])


@pytest.mark.parametrize(
    "params",
    [
        replace(SMALL, splits_per_pass=1),
        replace(SMALL, max_leaves=64, max_depth=3),  # the depth ends the growth: any order gives the same trees
        replace(SMALL, splits_per_pass=1, alpha=40.0, reg_lambda=7.0, min_child_weight=25.0, base_score=0.5),
        replace(SMALL, max_depth=65, max_leaves=400, min_child_weight=30.0, step_size=1.0, max_iter=2),
    ],
)
def test_trees_equal_the_plain_version(spark, params):
    rows = sample()
    df = table(spark, rows).repartition(3).sort("Sales")
    _, rounds, errors = plain_boosting(rows, params)
    model = fit_boosted(df, params, features=FEATURES)
    best = int(np.argmin(errors))
    assert len(model.trees) == best + 1
    order = np.argsort([r[1] for r in rows], kind="stable")
    got = predicted(model, df)
    assert np.sort(got) == pytest.approx(np.sort(rounds[best]), rel=1e-9)
    assert got == pytest.approx(rounds[best][order], rel=1e-9)


def test_null_that_carries_the_signal_is_one_split(spark):
    rows = [("train", 100.0 if i % 2 else 0.0, None if i % 2 else float(i), 1.0, None) for i in range(40)]
    model = fit_boosted(table(spark, rows), replace(SMALL, max_iter=1, max_leaves=2), features=FEATURES)
    root = model.trees[0][0]
    assert (root.feature, root.threshold, root.missing_left) == ("a", math.inf, False)
    assert set(predicted(model, table(spark, rows)).round(6)) == {
        round(50 - (1000 - 0.15) / 20.2 * 0.4, 6), round(50 + (1000 - 0.15) / 20.2 * 0.4, 6)
    }
    nan = table(spark, [("test", 0.0, math.nan, 1.0, None), ("test", 0.0, None, 1.0, None)])
    assert len(set(predicted(model, nan))) == 1


def test_training_that_stops_and_goes_on_gives_the_same_trees(spark, path):
    rows = table(spark, sample(seed=3)).repartition(4)
    whole = fit_boosted(rows, SMALL, features=FEATURES, state=f"{path}/whole")
    passes = []
    original = boosting._pass
    boosting._pass = lambda *a: passes.append(1) or original(*a)
    try:
        first = fit_boosted(rows.repartition(2), replace(SMALL, max_iter=2), features=FEATURES, state=f"{path}/parts")
        before = len(passes)
        again = fit_boosted(rows, SMALL, features=FEATURES, state=f"{path}/parts")
        assert before < len(passes)
        done = len(passes)
        assert fit_boosted(rows, SMALL, features=FEATURES, state=f"{path}/parts") == again
        assert len(passes) == done  # nothing is computed again
    finally:
        boosting._pass = original
    assert again == whole and first.trees == whole.trees[: len(first.trees)]
    with pytest.raises(ValueError, match="other parameters"):
        fit_boosted(rows, replace(SMALL, alpha=1.0), features=FEATURES, state=f"{path}/parts")


def test_patience_ends_the_rounds_and_the_best_are_kept(spark):
    rows = sample(n=150, seed=5)
    params = replace(SMALL, max_iter=40, patience=3, step_size=1.0, max_leaves=30, splits_per_pass=1)
    _, rounds, errors = plain_boosting(rows, replace(params, max_iter=12))
    model = fit_boosted(table(spark, rows), params, features=FEATURES)
    best = int(np.argmin(errors))
    assert best < 8 and len(model.trees) == best + 1


def test_many_values_are_cut_by_quantiles(spark):
    cuts = boosting.feature_cuts(
        spark.range(10_000).selectExpr("CAST(id AS DOUBLE) AS a", "id % 5 AS b", "CAST(NULL AS DOUBLE) AS c"),
        FEATURES, 8,
    )
    assert cuts[1:] == [[1.0, 2.0, 3.0, 4.0], []]
    assert cuts[0] == pytest.approx([1250 * i for i in range(1, 8)], abs=5)


def test_tables_without_rows_or_watched_rows(spark):
    rows = [("train", float(i % 3), float(i % 3), None, None) for i in range(30)] + [("train", None, 1.0, 1.0, 1.0)]
    model = fit_boosted(table(spark, rows), replace(SMALL, max_iter=3), features=FEATURES)
    assert len(model.trees) == 3
    with pytest.raises(ValueError, match="no rows"):
        fit_boosted(table(spark, []), SMALL, features=FEATURES)


def test_a_model_survives_a_save_and_scores_by_a_compiled_projection(spark, path):
    rows = table(spark, sample(seed=7))
    model = fit_boosted(rows, SMALL, features=FEATURES)
    model.save(path)
    again = load_model(path)
    assert again == TreeModel(model.base_score, [list(t) for t in model.trees])
    plan = again.transform(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "*(1) Project" in plan
    assert predicted(again, rows).tolist() == predicted(model, rows).tolist()


def test_a_thousand_rounds_are_one_expression(spark):
    tree = [Node(feature="a", threshold=1.0, missing_left=True, left=1, right=2), Node(weight=1.0), Node(weight=2.0)]
    model = TreeModel(0.5, [tree] * 1000)
    df = table(spark, [("test", 0.0, None, 1.0, 1.0), ("test", 0.0, 1.0, 1.0, 1.0)])
    assert predicted(model, df).tolist() == [1000.5, 2000.5]
    assert predicted(TreeModel(3.0, []), df).tolist() == [3.0, 3.0]


def test_every_pass_is_dealt_to_all_cores(spark, path):
    rows = table(spark, sample(seed=8)).coalesce(1)
    fit_boosted(rows, replace(SMALL, max_iter=1), features=FEATURES, state=path)
    files = spark.read.parquet(f"{path}/margins-0").inputFiles()
    assert len(files) >= spark.sparkContext.defaultParallelism


def test_sums_of_large_numbers_are_exact():
    rng = np.random.default_rng(9)
    values, cell = rng.integers(-(1 << 50), 1 << 50, 5000), rng.integers(0, 7, 5000)
    expected = [sum(int(v) for v in values[cell == c]) for c in range(7)]
    assert boosting._exact_sums(cell, values, 7).tolist() == expected
