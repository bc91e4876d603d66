"""Mixing sources to target weights by entropy balancing.

Rates ``r`` of the documents minimise the relative entropy to "every document once",
``sum(r ln r - r + 1)``, under one token constraint per source, ``sum(size * r) = target``, and
``0 <= r <= cap``. The solution tilts exponentially: ``r = min(cap, exp(lambda * size / scale))`` with
one dual variable ``lambda`` per source. Newton steps on the convex dual find it: each step is one
aggregate over the cells (source, size, number of documents), for all sources at once. The rates are
then rounded to whole copies so that each source meets its target to within a few small documents.

Only DataFrame functions are used. Cells are aggregated before they are shuffled, so that a source
with a third of all rows is a list of its distinct sizes; documents are ranked inside (cell, range)
groups of bounded size. Tables with one row per source are ordered in one task: for the weights by
rank and the sharing of what the caps leave over.

Defined results: NULL text has size 0; a document of size 0 is taken 0 words (it keeps one copy);
a NULL source is a source of its own, last in the order; repeated rows are documents of their own;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.workspace import scratch_path, write_and_reopen

#: A run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one cell that one task ranks.
RANGE_ROWS = 100_000
#: Newton ends when every source is this near its target, or after so many steps.
TOLERANCE, MAX_STEPS = 1e-9, 80

_STATE = ["source", "source_size", "target", "scale", "lam", "lo", "hi", "error"]


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and a hash of the document that orders equal sizes."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        docs["doc_id"],
        docs["source"],
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(docs["doc_id"], docs["text"]).alias("row_hash"),
    )


def source_targets(sources: DataFrame, weights: Sequence[float], cap: float, share: float = 1.0) -> DataFrame:
    """Adds ``target``: ``share`` of all words by repeating weights, none above ``cap`` times its source.

    With the sources in the order of cap / weight, the first ones stop at their cap, the others get
    ``weight * level``. The level is that of the first source which stays below its cap when all
    before it are at theirs.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.col("_rank") - 1, len(weights)) + 1)
    return (
        sources.withColumn("_rank", F.row_number().over(by_name))
        .withColumn("_weight", weight)
        .withColumn("_most", F.col("source_size") * float(cap))
        .withColumn("_ratio", F.col("_most") / F.col("_weight"))
        .withColumn("_spent", F.sum("_most").over(by_ratio) - F.col("_most"))
        .withColumn("_rest", F.sum("_weight").over(everything) - F.sum("_weight").over(by_ratio) + F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(everything) * float(share))
        .withColumn("_level", (F.col("_total") - F.col("_spent")) / F.col("_rest"))
        .withColumn(
            "_level",
            F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(everything)["_level"],
        )
        .withColumn("target", F.least(F.col("_most"), F.coalesce(F.col("_weight") * F.col("_level"), F.col("_most"))))
        .select(*sources.columns, "target")
    )


def _rate(cap: float):
    return F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("size") / F.col("scale")))


def balance(cells: DataFrame, sources: DataFrame, cap: float, label: str) -> DataFrame:
    """The dual variables: Newton steps for all sources at once, each from one aggregate over the cells.

    The step is that of ``ln(sum(size * r))``, which is nearly straight in lambda. A bracket of the
    root guards it: a step that leaves the bracket is replaced by its middle. Sources whose target is
    the cap times their size have no finite lambda and start, solved, at one that caps every rate.
    """
    spark = cells.sparkSession
    full = F.col("target") >= F.col("source_size") * float(cap) * (1 - 1e-12)
    none = F.lit(None).cast("double")
    state = sources.select(
        "source",
        "source_size",
        "target",
        F.greatest(F.col("source_size") / F.col("documents"), F.lit(1e-300)).alias("scale"),
        F.when(full, F.lit(1e300)).otherwise(0.0).alias("lam"),
        none.alias("lo"),
        none.alias("hi"),
        F.when(full, 0.0).otherwise(1.0).alias("error"),
    )
    for step in range(MAX_STEPS):
        state = write_and_reopen(state, scratch_path(spark, f"{label}-dual-{step}"))
        if (state.agg(F.max("error")).first()[0] or 0.0) < TOLERANCE:
            break
        words = F.col("n") * F.col("size") * _rate(cap)
        sums = (
            cells.alias("c")
            .join(state.alias("s"), F.expr("c.source <=> s.source"))
            .select("s.*", "size", "n")
            .groupBy(*(c for c in _STATE))
            .agg(
                F.sum(words).alias("got"),
                F.sum(F.when(_rate(cap) < cap, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"),
            )
        )
        below = F.col("got") < F.col("target")
        lo = F.when(below, F.greatest("lo", "lam")).otherwise(F.col("lo"))
        hi = F.when(~below, F.least("hi", "lam")).otherwise(F.col("hi"))
        newton = F.col("lam") + F.ln(F.col("target") / F.col("got")) * F.try_divide(F.col("got"), F.col("slope"))
        reach = 4 * F.greatest(F.lit(1.0), F.abs("lam"))
        guarded = (
            F.when(
                F.col("lo").isNotNull() & F.col("hi").isNotNull(),
                F.when((newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise(
                    (F.col("lo") + F.col("hi")) / 2
                ),
            )
            .when(F.col("lo").isNotNull(), F.least(F.coalesce(newton, F.lit(1e300)), F.col("lam") + reach))
            .otherwise(F.greatest(F.coalesce(newton, F.lit(-1e300)), F.col("lam") - reach))
        )
        open_ = F.col("error") >= TOLERANCE
        error = F.abs(F.col("got") / F.col("target") - 1)
        state = (
            sums.withColumn("lo", lo)
            .withColumn("hi", hi)
            .withColumn("_error", F.when(open_, error).otherwise(F.col("error")))
            .withColumn("lam", F.when(F.col("_error") >= TOLERANCE, guarded).otherwise(F.col("lam")))
            .withColumn("error", F.col("_error"))
            .select(*_STATE)
        )
    return state


def _rounded_cells(cells: DataFrame, state: DataFrame, cap: int) -> DataFrame:
    """Whole copies per cell.

    Going down by size, the running sum of rates is rounded; as sizes fall along the way, the error in
    words stays below one document. What is left of it is then made up by copies of the smallest documents.
    """
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    up = Window.partitionBy("source").orderBy("size")
    whole = Window.partitionBy("source")
    room = F.when(F.col("_short") > 0, cap * F.col("n") - F.col("_copies")).otherwise(F.col("_copies"))
    return (
        cells.alias("c")
        .join(state.alias("s"), F.expr("c.source <=> s.source"))
        .select("c.source", "size", "n", "source_size", "target", _rate(cap).alias("rate"))
        .withColumn("_run", F.floor(F.sum(F.col("n") * F.col("rate")).over(down) + 0.5))
        .withColumn("_copies", F.col("_run") - F.coalesce(F.lag("_run").over(down), F.lit(0)))
        .withColumn("_copies", F.least(F.greatest(F.col("_copies"), F.lit(0)), cap * F.col("n")))
        .withColumn("_short", F.round(F.col("target") - F.sum(F.col("_copies") * F.col("size")).over(whole)).cast("long"))
        .withColumn("_room", room)
        .withColumn("_before", F.sum(F.col("_room") * F.col("size")).over(up) - F.col("_room") * F.col("size"))
        .withColumn("_fit", F.floor(F.try_divide(F.abs("_short") - F.col("_before"), F.col("size"))))
        .withColumn("_fit", F.least(F.greatest(F.coalesce("_fit", F.lit(0)), F.lit(0)), F.col("_room")))
        .withColumn("copies", F.col("_copies") + F.signum(F.col("_short").cast("double")).cast("long") * F.col("_fit"))
        .select("source", "size", "n", "source_size", "target", "rate", "copies")
    )


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), cap: int = 3, share: float = 1.0
) -> DataFrame:
    """doc_id, source, row_hash, size, source_size, target, rate and copies of every document.

    ``weights`` repeat over the sources in code-point order, NULL last. No document has more than
    ``cap`` copies. Which documents of a cell get one copy more is decided by a hash, so reruns agree.
    """
    spark = docs.sparkSession
    sized = write_and_reopen(sized_rows(docs), scratch_path(spark, "mix-sizes"))
    cells = write_and_reopen(
        sized.groupBy("source", "size").agg(F.count("*").alias("n")), scratch_path(spark, "mix-cells")
    )
    sources = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("documents")
    )
    state = balance(cells, source_targets(sources, weights, cap, share), float(cap), "mix")
    rounded = write_and_reopen(_rounded_cells(cells, state, cap), scratch_path(spark, "mix-copies"))
    ranged = (
        sized.alias("d")
        .join(rounded.alias("c"), F.expr("d.source <=> c.source AND d.size = c.size"))
        .select("d.*", "c.n", "c.source_size", "c.target", "c.rate", F.col("c.copies").alias("_all"))
        .withColumn("_range", F.pmod(F.col("row_hash"), F.ceil(F.col("n") / RANGE_ROWS)))
    )
    group = ["source", "size", "_range"]
    counts = ranged.groupBy(*group).agg(F.count("*").alias("_count"))
    before = counts.withColumn(
        "_before", F.sum("_count").over(Window.partitionBy("source", "size").orderBy("_range")) - F.col("_count")
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("row_hash", "doc_id"))
    extra = (F.col("_rank") + F.col("_before") <= F.expr("_all % n")).cast("long")
    return (
        ranged.withColumn("_rank", rank)
        .alias("r")
        .join(before.alias("b"), F.expr("r.source <=> b.source AND r.size = b.size AND r._range = b._range"))
        .select("r.*", "b._before")
        .select(
            "doc_id",
            "source",
            "row_hash",
            "size",
            "source_size",
            "target",
            "rate",
            (F.expr("_all div n") + extra).alias("copies"),
        )
    )


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as ``mixed`` has copies of them, with the columns of ``docs``.

    Equal rows share their copies. The texts are shuffled once, by document.
    """
    copies = mixed.groupBy("doc_id", "row_hash").agg(F.sum("copies").alias("all"), F.count("*").alias("rows"))
    keyed = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc"),
        docs["doc_id"].alias("id"),
        F.xxhash64(docs["doc_id"], docs["text"]).alias("hash"),
    )
    nth = F.row_number().over(Window.partitionBy("id", "hash").orderBy("hash"))
    take = F.expr("all div rows") + (F.col("nth") <= F.expr("all % rows")).cast("long")
    return (
        keyed.withColumn("nth", nth)
        .alias("d")
        .join(copies.alias("c"), F.expr("d.id <=> c.doc_id AND d.hash = c.row_hash"))
        .select("d.doc", take.cast("int").alias("take"))
        .filter("take > 0")
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("take"))))
        .select("doc.*")
    )
