"""What the two trained operators share: the held-out fold and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.sizing import fits_broadcast

#: Rows whose CRC-32 of the id, as text, leaves 0 by this number are held out: no model learns from them.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """TRUE for the held-out fold; a NULL id counts as the empty text (whose CRC-32 is 0: held out)."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(text), F.lit(FOLDS)) == 0


def bounded_sample(labelled: DataFrame, label: str, rows: int) -> DataFrame:
    """About ``rows`` rows at most for each label, chosen by a hash of id and text; the label's count decides the rate.

    One count per label, then a filter: nothing is sorted, and reruns agree. All labels take part; their counts are
    broadcast if they are measured to fit, else joined by a shuffle. Many different texts under one id are sampled
    like others.
    """
    counts = labelled.groupBy(label).count()
    side = F.broadcast(counts) if fits_broadcast(counts) else counts
    rate = F.lit(float(rows)) / F.col("count") * float(1 << 20)
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < rate
    return labelled.join(side, label).filter(chosen).drop("count")
