"""The pipeline's stages on NULLs, repeated ids, empty tables and clashing column names."""

from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"


def prose(rng, n=60):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_copies_go_under_repeated_and_null_ids(spark, documents):
    from corpus_pipeline import deduplicate

    rng = random.Random(1)
    a, b, c, d = (prose(rng) for _ in range(4))
    near = c.split(" ")
    near[-1] = "other"
    rows = [(3, a), (7, a), (7, b), (None, a), (None, b), (9, c), (9, c), (8, " ".join(near)), (5, ""), (5, None)]
    rows += [(None, d), (None, d), (None, None), (4, "one word")]
    out = deduplicate(spark, documents(rows), SF)
    assert out.columns == documents(rows).columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    expected = [(3, a), (7, b), (8, " ".join(near)), (5, ""), (5, None), (None, d), (None, None), (4, "one word")]
    assert kept == sorted(expected, key=repr)


def test_plain_ids_keep_the_smallest(spark, documents):
    from corpus_pipeline import deduplicate

    rng = random.Random(2)
    a, b = prose(rng), prose(rng)
    rows = [(5, a), (2, a), (9, b), (1, None), (4, "")]
    assert sorted(r.doc_id for r in deduplicate(spark, documents(rows), SF).collect()) == [1, 2, 4, 9]


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_empty_tables(spark, documents, stage):
    import corpus_pipeline

    name, function = corpus_pipeline.STAGES[stage]
    out = function(spark, documents([]), SF)
    assert out.collect() == [], name
    assert set(documents([]).columns) <= set(out.columns)
