"""The bounded sample takes part of every label, however many there are."""

from __future__ import annotations

import pytest


@pytest.mark.parametrize("fits", [True, False])
def test_all_labels_are_sampled(spark, monkeypatch, fits):
    from shelfcast.llm import holdout

    monkeypatch.setattr(holdout, "fits_broadcast", lambda df: fits)
    rows = [(i, f"text {i}", f"label {i % 1500}") for i in range(3000)] + [(7, f"more {i}", "hot") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["lang"]: r["count"] for r in holdout.bounded_sample(df, "lang", 400).groupBy("lang").count().collect()}
    assert len(found) == 1501
    assert 300 < found["hot"] < 500  # rows of one id are sampled like others
