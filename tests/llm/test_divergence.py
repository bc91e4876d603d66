"""The audit of sources against a plain version, which visits every kept term for every pair of groups."""

from __future__ import annotations

import collections
import random
import re

import pytest
from brute import lower

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain_audit(rows, least, top):
    counts, documents = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, text, lang, source in ((*r, *[None] * (4 - len(r))) for r in rows):
        terms = [lower(t) for t in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(terms)
        documents[lang or ""].update(set(terms))
    out = set()
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        groups = {s: counts[g, s] for g, s in counts if g == lang}
        groups[None] = sum(groups.values(), collections.Counter())  # the language
        p = {}
        for s, c in groups.items():
            total = sum(c[t] for t in kept)
            p[s] = {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        def f(a, b, t, p=p):
            return (p[a][t] - p[b][t]) ** 2 // p[b][t]

        for s in groups.keys() - {None}:
            pair = [(-sum(f(s, o, t) for t in kept), o) for o in groups.keys() - {None, s}]
            term = [(-f(s, None, t), t) for t in kept if groups[s][t] and p[s][t] > p[None][t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(items)}
    return out


def audited(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(rng, n, languages=("en", "de", ""), sources=("a", "b", "c", "é", "", None)):
    pool = ["the", "The", "of", "ärger", "Ärger", "文", "x1y", "mid-dot·", "it's"] + [f"w{chr(97 + i)}" for i in range(20)]
    for i in range(n):
        weights = [rng.random() ** 3 for _ in pool]
        text = " ".join(rng.choices(pool, weights, k=rng.choice([0, 1, 5, 40])))
        yield i, text, rng.choice(languages), rng.choice(sources)


@pytest.mark.parametrize("seed", range(3))
def test_audit_equals_the_plain_version(documents, seed):
    from shelfcast.llm.divergence import source_divergence

    rng = random.Random(seed)
    rows = list(corpus(rng, 150))
    rows += [rows[3]] * 4 + [(900, None, "en", "a"), (901, "", "fr", "only"), (902, "rare terms", "fr", "other")]
    rows += [(None, "x \n\t9 __ \x7f {|} of", None, None), (903, "word " * 5000, "en", "long")]
    for layout in (1, 4):
        assert audited(source_divergence(documents(rows).repartition(layout), 3, 5)) == plain_audit(rows, 3, 5)


def test_without_broadcast_and_in_small_slices(documents, monkeypatch):
    from shelfcast.llm import divergence

    rng = random.Random(9)
    rows = list(corpus(rng, 120))
    monkeypatch.setattr(divergence, "fits_broadcast", lambda df: False)
    assert audited(divergence.source_divergence(documents(rows), 3, 200)) == plain_audit(rows, 3, 200)


def test_slices_of_pairs_do_not_change_the_sums(spark):

    from shelfcast.llm import divergence

    rng = random.Random(2)
    lists = [rng.sample("abcdefgh", rng.randrange(9)) for _ in range(40)]
    rows = [(rng.choice(["en", "de"]), x, [rng.randrange(1, 10**9) for _ in x], [rng.randrange(1, 99) for _ in x]) for x in lists]
    frame = spark.createDataFrame(rows, "lang string, source array<string>, p array<long>, p0 array<long>").coalesce(1)
    expected = collections.Counter()
    for lang, source, p, p0 in rows:
        for i, a in enumerate(source):
            for j, b in enumerate(source):
                if i != j:
                    f = lambda x, y: (x - y) ** 2 // y
                    expected[lang, a, b] += f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
    for size in (1, 7, 1 << 20):
        divergence.PAIRS, before = size, divergence.PAIRS
        try:
            got = collections.Counter()
            for r in divergence.common_parts(frame).collect():
                got[r.lang, r.a, r.b] += r.value
        finally:
            divergence.PAIRS = before
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in expected.items() if v}


def test_smoothing_is_exact_beyond_64_bit_products(spark):
    from pyspark.sql import functions as F

    from shelfcast.llm.divergence import smoothed

    rows = [(0, 0, 1), (9, 9, 1), (10**12, 3 * 10**12 + 7, 10**9), (5 * 10**14, 9 * 10**14, 12345), (3, 17, 5)]
    df = spark.createDataFrame(rows, "n long, total long, terms long")
    got = [r.p for r in df.select(smoothed(F.col("n"), F.col("total"), F.col("terms")).alias("p")).collect()]
    assert got == [1 + 10**9 * (n + 1) // (t + v) for n, t, v in rows]


def test_an_empty_table_gives_an_empty_result(documents):
    from shelfcast.llm.divergence import source_divergence

    out = source_divergence(documents([]), 3, 200)
    assert out.collect() == [] and out.columns == ["lang", "source", "part", "item", "value", "rank"]
