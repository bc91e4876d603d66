"""Audit of how the sources of a language differ in their terms.

Each document is cut into terms by a translate table: one pass lowers A-Z and blanks every ASCII byte that is
no letter, one split gives the terms, and one Counter their frequencies. Frequencies are combined per task and
then shuffled: first by (language, source, term), which no source or term makes hot, then to one row per kept
term of a language with the sources that hold it.

Relative frequencies are smoothed, whole numbers of billionths, and all arithmetic is exact. The divergence of
a source ``a`` from a source ``b`` is a sum over all kept terms of the language, most of which neither holds.
With ``p0`` for the frequency of a term that a source lacks, it is put together from sparse parts::

    sum over the terms of a of f(p_a, p0_b)                 from a's histogram of counts
    + sum over the terms of b of f(p0_a, p_b)               from b's histogram of counts
    + (V - terms of a - terms of b) * f(p0_a, p0_b)
    + sum over common terms of f(p_a, p_b) - f(p_a, p0_b) - f(p0_a, p_b) + f(p0_a, p0_b)

The last part is summed in the tasks for blocks of terms, in slices of a bounded number of pairs.

Defined results: NULL text, language and source are empty texts and take part; a document without terms counts
as one of its group, which is reported even if it has none; repeated rows are documents of their own; equal
values are ranked by the item's bytes; a language without kept terms has divergences of 0 and no terms; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.sizing import fits_broadcast
from shelfcast.workspace import scratch_path, write_and_reopen

#: (group, term) entries a task gathers before it passes them on.
GATHERED = 1 << 19
#: Pairs of sources a task compares at a time.
PAIRS = 1 << 20
#: Parts into which a language's histograms are spread if its sources are not broadcast.
SPREAD = 64

# Lowers A-Z, keeps a-z and all non-ASCII bytes, blanks the rest.
TRANSLATE = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences and documents of every term of every group."""

    def gather(batches):
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out():
            for (lang, source), (uses, documents) in groups.items():
                n = len(uses)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * n, pa.string()),
                        pa.array([source] * n, pa.string()),
                        pa.array(list(uses), pa.binary()).cast(pa.string()),
                        pa.array(list(uses.values()), pa.int64()),
                        pa.array([documents[t] for t in uses], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "n_docs"],
                )

        held = 0
        for batch in batches:
            columns = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(*columns, batch.column("text").cast(pa.large_binary()), strict=True):
                counted = Counter((text.as_py() or b"").translate(TRANSLATE).split())
                entry = groups.get((lang or "", source or ""))
                if entry is None:
                    entry = groups[lang or "", source or ""] = (Counter(), Counter())
                uses, documents = entry
                held -= len(uses)
                uses.update(counted)
                documents.update(counted.keys())
                held += len(uses)
                if held >= GATHERED:
                    yield from out()
                    groups, held = {}, 0
        yield from out()

    schema = "lang string, source string, term string, n long, n_docs long"
    found = docs.select("lang", "source", "text").mapInArrow(gather, schema)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def kept_terms(counts: DataFrame, least_documents: int) -> DataFrame:
    """(lang, term, n, entries): the terms in enough documents of the language, with the groups that hold them."""
    return (
        counts.groupBy("lang", "term")
        .agg(
            F.sum("n_docs").alias("documents"),
            F.sum("n").alias("n"),
            F.collect_list(F.struct("source", "n")).alias("entries"),
        )
        .filter(F.col("documents") >= least_documents)
        .select("lang", "term", "n", "entries")
    )


def smoothed(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (n + 1) / (total + terms)) by long division, three digits at a time: exact in 64 bits."""
    quotient, rest, divisor = F.lit(0).cast("long"), n + 1, total + terms
    for _ in range(3):
        rest = rest * 1000
        quotient, rest = quotient * 1000 + F.call_function("div", rest, divisor), rest % divisor
    return quotient + 1


def _divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def group_statistics(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, n_terms, terms, p0) of every group; p0 is the frequency of a term it lacks."""
    languages = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    held = (
        kept.select("lang", F.explode("entries").alias("e"))
        .groupBy("lang", F.col("e.source").alias("source"))
        .agg(F.sum("e.n").alias("total"), F.count("*").alias("n_terms"))
    )
    occurring = docs.select(*(F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    zero = F.lit(0).cast("long")
    return (
        occurring.join(held, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "n_terms", "terms")))
        .withColumn("p0", F.when(F.col("terms") > 0, smoothed(zero, F.col("total"), F.col("terms"))))
    )


def common_parts(entries: DataFrame) -> DataFrame:
    """(lang, a, b, value): the last part of the sum, for pairs of groups with common terms.

    ``entries`` has one row per kept term: lang and the arrays source, p and p0 of the groups that hold it.
    """

    def f(p, q):
        return (p - q) ** 2 // q

    def compare(batches):
        for batch in batches:
            lists = batch.column("source")
            starts = lists.offsets.to_numpy().astype(np.int64)
            starts, held = starts[:-1] - starts[0], np.diff(starts)
            langs, sources = (x.dictionary_encode() for x in (batch.column("lang"), lists.flatten()))
            lang, source = (x.indices.to_numpy().astype(np.int64) for x in (langs, sources))
            p, p0 = (batch.column(c).flatten().to_numpy() for c in ("p", "p0"))
            row = np.repeat(np.arange(len(held)), held)
            width = len(sources.dictionary)
            ends = np.cumsum(held[row])  # pairs up to each entry
            at, keys, sums = 0, [], []
            while at < len(row):
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
                partners = held[row[at:upto]]
                a = np.repeat(np.arange(at, upto), partners)
                b = np.repeat(starts[row[at:upto]] - (np.cumsum(partners) - partners), partners) + np.arange(len(a))
                other = a != b
                a, b = a[other], b[other]
                value = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
                key, which = np.unique((lang[row[a]] * width + source[a]) * width + source[b], return_inverse=True)
                total = np.zeros(len(key), np.int64)
                np.add.at(total, which, value)
                keys.append(key)
                sums.append(total)
                at = upto
            if not keys:
                continue
            key, which = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, which, np.concatenate(sums))
            names = sources.dictionary
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(key // width**2)),
                    names.take(pa.array(key // width % width)),
                    names.take(pa.array(key % width)),
                    pa.array(total),
                ],
                ["lang", "a", "b", "value"],
            )

    return entries.mapInArrow(compare, "lang string, a string, b string, value long")


def source_divergence(docs: DataFrame, least_documents: int, top_terms: int) -> DataFrame:
    """lang, source, part, item, value, rank: each source against the others of its language (``pair``, all of
    them), and the ``top_terms`` terms that it has above the language's share by the most (``term``)."""
    spark = docs.sparkSession
    kept = write_and_reopen(kept_terms(term_counts(docs), least_documents), scratch_path(spark, "divergence-terms"))
    groups = write_and_reopen(group_statistics(docs, kept), scratch_path(spark, "divergence-groups"))
    small = fits_broadcast(groups)
    side = F.broadcast(groups) if small else groups

    totals = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"))
    totals = F.broadcast(totals) if fits_broadcast(totals) else totals
    held = (
        kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("entries").alias("e"))
        .select("lang", "term", "lang_n", F.col("e.source").alias("source"), F.col("e.n").alias("n"))
        .join(side, ["lang", "source"])
        .join(totals, "lang")
        .select(
            "lang",
            "term",
            "source",
            "n",
            "p0",
            smoothed(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            smoothed(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
        )
    )

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = held.filter("p > q").select("lang", "source", F.col("term").alias("item"), _divergence("p", "q").alias("value"))
    terms = above.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_terms)

    lists = held.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("entries"))
    common = common_parts(lists.select("lang", *(F.col("entries")[c].alias(c) for c in ("source", "p", "p0"))))

    # every (lang, a, b): the histogram of a's counts against b, and of b's against a
    histogram = held.groupBy("lang", "source", "p").agg(F.count("*").alias("times"), F.first("p0").alias("p0"))
    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    if small:
        met = histogram.join(F.broadcast(others), "lang")
    else:  # a language may hold most of the rows: each part of its histograms meets a copy of its sources
        part = F.pmod(F.xxhash64("source", "p"), F.lit(SPREAD)).cast("int")
        copies = others.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        met = histogram.withColumn("_part", part).join(copies, ["lang", "_part"])
    met = met.filter("source <> other")
    forward = met.select("lang", F.col("source").alias("a"), F.col("other").alias("b"), (F.col("times") * _divergence("p", "q0")).alias("value"))
    backward = met.select("lang", F.col("other").alias("a"), F.col("source").alias("b"), (F.col("times") * _divergence("q0", "p")).alias("value"))
    # groups that lack a term, and the rows of pairs without any term
    first = groups.select("lang", F.col("source").alias("a"), F.col("n_terms").alias("a_terms"), "terms", "p0")
    second = groups.select("lang", F.col("source").alias("b"), F.col("n_terms").alias("b_terms"), F.col("p0").alias("q0"))
    rest = (F.col("terms") - F.col("a_terms") - F.col("b_terms")) * _divergence("p0", "q0")
    absent = (
        first.join(F.broadcast(second) if small else second, "lang")
        .filter("a <> b")
        .select("lang", "a", "b", F.coalesce(rest, F.lit(0).cast("long")).alias("value"))
    )
    summed = (
        forward.unionByName(backward).unionByName(absent).unionByName(common)
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    pairs = summed.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair"))
        .select(*columns)
        .unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
    )
