"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import collections
import os
import sys

import duckdb
import pytest
from brute import brute_components, words

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def rows_of(df):
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", ["op3_line_dedup", "op7_rendezvous_sharding", "op13_source_divergence"])
def test_queries_equal_their_sql(spark, name):
    from shelfcast.llm.oracles import ORACLES
    from shelfcast.llm.queries import QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = QUERIES[name](spark, SF)
    expected = con.sql(ORACLES[name])
    order = [expected.columns.index(c) for c in sorted(expected.columns)]
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows_of(found) == sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=repr)


def test_every_operator_has_a_query():
    from shelfcast.llm.queries import QUERIES

    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_the_stages_do_what_their_operators_say(spark, corpus):
    import corpus_pipeline

    from shelfcast.llm.quality import THRESHOLD, fit_quality_model, score_quality
    from shelfcast.workspace import scratch_path, write_and_reopen

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = write_and_reopen(stage(spark, docs, SF), scratch_path(spark, f"test-stage-{i}"))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        kept.append([r.asDict() for r in out.collect()])
        docs = out
    quality, unique, clean, mixed, sharded = kept

    model = fit_quality_model(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    scores = score_quality(spark.read.parquet(f"{SF}/documents.parquet"), model).collect()
    assert {r["doc_id"] for r in quality} == {r.doc_id for r in scores if r.score >= THRESHOLD}
    assert len(quality) < len(corpus)

    groups = brute_components({r["doc_id"]: r["text"] for r in quality})
    assert {r["doc_id"] for r in unique} == set(groups.values())

    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    planted = {r["doc_id"] for r in unique if any(" ".join(words(b)) in " ".join(words(r["text"])) for b in benchmark)}
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in unique} - planted

    size = collections.Counter()
    for r in clean:
        size[r["source"]] += len(words(r["text"]))
    taken, copies = collections.Counter(), collections.Counter(r["doc_id"] for r in mixed)
    for r in mixed:
        taken[r["source"]] += len(words(r["text"]))
    assert set(copies) <= {r["doc_id"] for r in clean} and max(copies.values()) <= 3
    assert sum(taken.values()) == pytest.approx(sum(size.values()), rel=0.05)
    first = sorted(size)[0]
    assert taken[first] / sum(taken.values()) > size[first] / sum(size.values()) * 0.9

    assert collections.Counter(r["doc_id"] for r in sharded) == copies
    by_document = collections.defaultdict(set)
    for r in sharded:
        by_document[r["doc_id"]].add(r["shard"])
    assert all(len(x) == 1 and 0 <= min(x) < 24 for x in by_document.values())


def test_the_rest_of_the_library_does_not_import_this_package():
    import re

    for folder, _, names in os.walk(os.path.join(ROOT, "shelfcast")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as file:
                        assert not re.search(r"\bllm\b|corpus_pipeline", file.read()), name
