"""Whitening against an eigensolver over plainly formed covariances, and its steps one by one."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

EMBEDDINGS = "vec_id long, embedding array<double>, label int"


def frame(spark, rows, kind="double"):
    df = spark.createDataFrame([(*r, None) for r in rows], EMBEDDINGS)
    df = df.withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    for name in ("x", "length", "component", "n", "i", "r"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def plain(rows, scale=256, components=4):
    """Per (vec_id, component) the expected row; whitened up to its sign."""
    usable = [
        (i, tuple(math.floor(scale * c) for c in v))
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({x for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    x = np.array(fit, float)
    centred = x - x.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    out = []
    for i, v in usable:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        for k, j in enumerate(order):
            w = (np.array(v) - x.mean(0)) @ vectors[:, j] / np.sqrt(values[j])
            out.append((i, k + 1, n, deviation, w, values[j] / values.sum()))
    return out


def check(found, expected, tolerance=1e-8):
    found = sorted(found, key=lambda r: (r.vec_id is None, r.vec_id, r.component, abs(r.whitened)))
    expected = sorted(expected, key=lambda r: (r[0] is None, r[0], r[1], abs(r[4])))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in found] == [r[:4] for r in expected]
    for component in {r.component for r in found}:
        got = np.array([r.whitened for r in found if r.component == component])
        want = np.array([r[4] for r in expected if r[1] == component])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < tolerance
    for r, e in zip(found, expected, strict=True):
        assert r.explained == pytest.approx(e[5], rel=1e-9)
        assert r.identity_error < 1e-9


def run(df, components=4):
    from shelfcast.llm.whitening import fit_whitening, whiten

    return whiten(df, fit_whitening(df, 256, components)).collect()


@pytest.mark.parametrize("kind", ["double", "float"])
def test_rows_equal_those_of_a_plain_eigensolver(spark, kind):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(400, 12)) * np.linspace(0.02, 0.6, 12) + rng.normal(size=12)
    base = base.astype(np.float32).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[5][1]) for i in range(300)] + [rows[7]] * 3 + [(None, rows[8][1])]
    bad = [(2000, None), (2001, [None] * 12), (2002, [math.nan, *rows[0][1][1:]]), (2003, [math.inf, *rows[0][1][1:]])]
    bad += [(2004, [None, *rows[0][1][1:]])]
    for layout in (1, 6):
        check(run(frame(spark, rows + bad, kind).repartition(layout)), plain(rows))


def test_other_lengths_and_too_large_entries_are_dropped(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 3)))]
    odd = [(100, []), (101, [1.0]), (102, [1.0, 2.0]), (103, [1e300, 0.0, 0.0]), (104, [1.0] * 4)]
    found = run(frame(spark, rows + odd))
    assert {r.component for r in found} == {1, 2, 3}
    check(found, plain(rows))


def test_vectors_without_variance_and_empty_tables(spark):
    found = run(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])]))
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found] == [
        (i, c, 1, 0, 0.0, 0.0, 1.0) for i in (1, 2) for c in (1, 2)
    ]
    line = run(frame(spark, [(i, [i / 8, i / 4, 0.0]) for i in range(20)]))
    assert {r.whitened for r in line if r.component > 1} == {0.0}
    assert all(r.explained == pytest.approx(1.0) for r in line if r.component == 1)
    for rows in ([], [(1, None), (2, []), (3, [None])]):
        empty = run(frame(spark, rows))
        assert empty == []


def test_deviation_is_exact_until_64_bits_end():
    from shelfcast.llm.whitening import _deviation

    rng = np.random.default_rng(3)
    for n, bits in [(1, 31), (1000, 21), (10**6, 11), (10**9, 1), (3, 40), (10**9, 8), (2, 60)]:
        x = rng.integers(-(1 << bits), 1 << bits, (40, 3))
        sums = [int(v) for v in x.astype(object).sum(0)]
        exact = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
        assert _deviation(x, n, sums) == [v if v < 1 << 63 else None for v in exact]


def solved(r, wanted):
    from shelfcast.llm.whitening import principal_directions

    directions, values, total = principal_directions(r, wanted)
    scale = np.linalg.norm(r) ** 2
    assert np.abs(directions.T @ directions - np.eye(wanted)).max() < 1e-12
    assert np.abs(r.T @ (r @ directions) - directions * values).max() < 1e-13 * scale
    expected = np.sort(np.linalg.svd(r)[1] ** 2)[::-1]
    assert values == pytest.approx(expected[:wanted], rel=1e-10, abs=1e-14 * scale)
    assert total == pytest.approx(expected.sum(), rel=1e-12)


@pytest.mark.parametrize("size", [1, 2, 3, 8, 64])
def test_directions_of_triangles(size):
    rng = np.random.default_rng(size)
    wanted = min(4, size)
    solved(np.triu(rng.normal(size=(size, size))), wanted)
    solved(np.linalg.qr(rng.normal(size=(3 * size, size)) * np.geomspace(1, 1e-9, size), "r"), wanted)
    solved(np.eye(size) * 3.0, wanted)
    solved(np.diag(np.repeat([5.0, 1.0], size)[:size]), wanted)
    rank_two = rng.normal(size=(3 * size, 2)) @ rng.normal(size=(2, size))
    solved(np.linalg.qr(rank_two, "r"), wanted)
    near = np.linalg.qr(rng.normal(size=(size, size)))[0]
    solved(np.linalg.qr(np.diag(1 + 1e-13 * np.arange(size)) @ near, "r"), wanted)


def test_dqds_keeps_the_digits_of_small_values():
    from shelfcast.llm.whitening import dqds

    rng = np.random.default_rng(4)
    for size in (2, 5, 40):
        q = np.exp(rng.uniform(-30, 5, size))
        e = np.exp(rng.uniform(-30, 5, size - 1))
        found = dqds(q.tolist(), e.tolist())
        assert len(found) == size and found == sorted(found, reverse=True)
        assert sum(np.log(found)) == pytest.approx(np.log(q).sum(), rel=1e-10)  # the determinant
        assert sum(found) == pytest.approx(q.sum() + e.sum(), rel=1e-12)  # the trace
        b = np.diag(np.sqrt(q)) + np.diag(np.sqrt(e), 1)
        inverse = np.linalg.inv(b)  # exact to a few digits for bidiagonals: no cancellation
        assert sum(1 / np.array(found)) == pytest.approx((inverse**2).sum(), rel=1e-8)


def test_triangles_merge_in_rounds(spark, monkeypatch):
    from shelfcast.llm import whitening

    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(90, 4)))]
    check(run(frame(spark, rows).repartition(9)), plain(rows))
