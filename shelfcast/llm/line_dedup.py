"""Removal of lines that recur across documents, as keep bitmaps.

A line's key is hashed to 128 bits. The rows (hash, document, position) are range-partitioned and sorted, documents
descending, so that a hash whose line is in a large part of all documents is spread over several partitions. Each
partition is streamed once: the first document of a hash keeps its lines; from the third on, all lines go, and
with them those of the second. Only the hashes at a partition's ends can't be decided there. For them the first
three documents are reported, joined over the partitions, and their lines decided by a join with that small table.

The result is a compressed bitmap of kept lines per document, which ``kept_text`` applies; texts are not returned.
Documents are told apart by doc_id and a 64-bit hash of the text.

Defined results: NULL and empty texts have one empty line, which stays; rows with the same doc_id count as one
document, and equal rows get equal bitmaps; a NULL doc_id counts as one, smallest, document; an empty table gives an
empty result; other columns are ignored, or kept where texts are replaced, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.word_arrays import SPACES, byte_values, mix, text_slices
from shelfcast.sizing import fits_broadcast
from shelfcast.workspace import scratch_path, write_and_reopen

#: Code points of a key, and documents that hold it, from which its lines are duplicates.
LEAST_LENGTH, LEAST_DOCUMENTS = 20, 3

_DROPPED, _OPEN, _SUMMARY = 0, 1, 2
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def packed(positions: np.ndarray, n: int | None = None) -> bytes:
    """A compressed bitmap with the bits at ``positions`` set."""
    bits = np.zeros(int(n if n is not None else positions.max(initial=-1) + 1), np.uint8)
    bits[positions] = 1
    return zlib.compress(np.packbits(bits).tobytes(), 6)


def unpacked(bitmap: bytes, n: int) -> np.ndarray:
    """The first ``n`` bits; bits beyond the end are 0."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n]
    return np.pad(bits, (0, n - len(bits))).astype(bool)


class LineHasher:
    """Line keys of a slice as pairs of 64-bit hashes, from running sums over its bytes."""

    def __init__(self):
        self.is_space = np.zeros(256, bool)
        self.is_space[list(SPACES)] = True
        values = byte_values()
        self.values = (values, np.append(values[1:], values[:1]) * np.uint64(0xA0761D6478BD642F) | np.uint64(1))
        self.values[1][65:91] = self.values[1][97:123]
        self.powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * 2

    def lines(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, position, hash, other hash) of the lines whose key is long enough."""
        n = len(data)
        if len(self.powers[0][0]) <= n:
            self.powers = []
            for base in _BASES:
                pair = []
                for b in (base, pow(base, -1, 1 << 64)):
                    steps = np.full(n + (1 << 20), b, np.uint64)
                    steps[0] = 1
                    pair.append(np.multiply.accumulate(steps))
                self.powers.append(tuple(pair))
        breaks = np.flatnonzero(data == 0x0A)
        # An empty line at a document's end begins where the next document does: it has no key and may be left out.
        starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
        starts = starts[starts < n]
        document = np.searchsorted(offsets, starts, "right") - 1
        line_at = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[document])
        ends = np.minimum(np.append(breaks, n)[np.searchsorted(breaks, starts)], offsets[document + 1])
        solid = np.flatnonzero(~self.is_space[data])
        lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        some = hi > lo
        starts, document, line_at = starts[some], document[some], line_at[some]
        begin, end = solid[lo[some]], solid[hi[some] - 1] + 1
        leads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        long = leads[end] - leads[begin] >= LEAST_LENGTH
        begin, end, document, line_at = begin[long], end[long], document[long], line_at[long]
        hashes = []
        for values, (power, inverse) in zip(self.values, self.powers, strict=True):
            run = np.zeros(n + 1, np.uint64)
            np.cumsum(values[data] * power[:n], out=run[1:])
            hashes.append(mix((run[end] - run[begin]) * inverse[begin]))
        return document, line_at, hashes[0], hashes[1]


def line_keys(docs: DataFrame) -> DataFrame:
    """h1, h2, doc_id, content and position of every line with a key."""

    def run(batches: Iterator[pa.RecordBatch]):
        hasher = LineHasher()
        for batch in batches:
            for first, _, data, offsets in text_slices(batch.column("text")):
                document, position, h1, h2 = hasher.lines(data, offsets)
                rows = pa.array(document + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h1.view(np.int64)),
                        pa.array(h2.view(np.int64)),
                        batch.column("doc_id").take(rows),
                        batch.column("content").take(rows),
                        pa.array(position.astype(np.int64)),
                    ],
                    ["h1", "h2", "doc_id", "content", "position"],
                )

    schema = T.StructType(
        [
            T.StructField("h1", T.LongType()),
            T.StructField("h2", T.LongType()),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("content", T.LongType()),
            T.StructField("position", T.LongType()),
        ]
    )
    return docs.select("doc_id", F.xxhash64("text").alias("content"), "text").mapInArrow(run, schema)


def stream_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decides the lines of one sorted partition; see the module's text.

    In memory: a batch, and the lines of the second document of one hash until a third one comes.
    """
    group, document, kind = None, None, None
    rank, first, largest, waiting = -1, True, [], []

    def marked(batch: pa.RecordBatch, what: np.ndarray) -> pa.RecordBatch:
        n = batch.num_rows
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(what, pa.int32()), pa.nulls(n, pa.list_(kind))], [*batch.schema.names, "what", "documents"]
        )

    def summary() -> pa.RecordBatch:
        columns = [pa.array([h], pa.int64()) for h in group] + [pa.nulls(1, kind)] + [pa.nulls(1, pa.int64())] * 2
        columns += [pa.array([_SUMMARY], pa.int32()), pa.array([largest], pa.list_(kind))]
        return pa.RecordBatch.from_arrays(columns, [*names, "what", "documents"])

    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        names, kind = batch.schema.names, batch.schema.field("doc_id").type
        ids = batch.column("doc_id")
        keys = (batch.column("h1").to_numpy(), batch.column("h2").to_numpy())
        codes = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        new[1:] = (codes[1:] != codes[:-1]) | (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
        starts = np.flatnonzero(new)
        runs = zip(
            starts.tolist(),
            np.append(starts[1:], n).tolist(),
            keys[0][starts].tolist(),
            keys[1][starts].tolist(),
            ids.take(pa.array(starts)).to_pylist(),
            strict=True,
        )
        what = np.full(n, -1, np.int32)
        for lo, hi, h1, h2, doc in runs:
            if group != (h1, h2):
                if group is not None:
                    if first:
                        yield summary()
                    first = False
                group, rank, largest, waiting = (h1, h2), -1, [], []
            if rank < 0 or doc != document:
                rank, document = rank + 1, doc
                if rank < LEAST_DOCUMENTS:
                    largest.append(doc)
            if first:
                what[lo:hi] = _OPEN
            elif rank >= LEAST_DOCUMENTS - 1:
                what[lo:hi] = _DROPPED
                for before, at, end in waiting:
                    if before is batch:
                        what[at:end] = _DROPPED
                    else:
                        yield marked(before.slice(at, end - at), np.full(end - at, _DROPPED, np.int32))
                waiting = []
            elif rank > 0:
                waiting.append((batch, lo, hi))
        chosen = pa.array(np.flatnonzero(what >= 0))
        if len(chosen):
            yield marked(batch.take(chosen), what[what >= 0])
        waiting = [
            (b, at, end) if b is not batch else (batch.slice(at, end - at), 0, end - at) for b, at, end in waiting
        ]
    if group is not None:
        yield summary()
        if not first:
            for before, at, end in waiting:
                yield marked(before.slice(at, end - at), np.full(end - at, _OPEN, np.int32))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, content and position of every line that goes."""
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("content"), F.col("position")]
    keys = line_keys(docs)
    kind = keys.schema["doc_id"].dataType
    schema = T.StructType(
        [*keys.schema.fields, T.StructField("what", T.IntegerType()), T.StructField("documents", T.ArrayType(kind))]
    )
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    decided = write_and_reopen(ranged.mapInArrow(stream_sorted, schema), scratch_path(docs.sparkSession, "lines"))
    # at most two summaries for each partition
    ends = (
        decided.filter(F.col("what") == _SUMMARY)
        .select("h1", "h2", F.explode("documents").alias("d"))
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.max("d").alias("largest"), F.count("*").alias("n"))
        .filter(F.col("n") >= LEAST_DOCUMENTS)
        .select("h1", "h2", "largest")
    )
    ends = write_and_reopen(ends, scratch_path(docs.sparkSession, "line-ends"))
    side = F.broadcast(ends) if fits_broadcast(ends) else ends  # then the lines of a common hash stay where they are
    late = decided.filter(F.col("what") == _OPEN).join(side, ["h1", "h2"]).filter("NOT doc_id <=> largest")
    columns = ["doc_id", "content", "position"]
    return decided.filter(F.col("what") == _DROPPED).select(columns).unionByName(late.select(columns))


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """doc_id, content, n_lines, n_dropped and keep_bitmap of every document; no text is shuffled."""
    grouped = dropped_lines(docs).groupBy("doc_id", "content").agg(F.collect_set("position").alias("positions"))
    text = F.coalesce("text", F.lit(""))
    lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long")
    narrow = docs.select("doc_id", F.xxhash64("text").alias("content"), lines.alias("n_lines"))
    joined = (
        narrow.alias("d")
        .join(grouped.alias("g"), F.expr("d.doc_id <=> g.doc_id AND d.content = g.content"), "left")
        .select("d.*", "g.positions")
    )

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            maps, dropped = [], []
            for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("positions").to_pylist(), strict=True):
                keep = np.setdiff1d(np.arange(n), np.array(gone or [], np.int64))
                maps.append(packed(keep, n))
                dropped.append(n - len(keep))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())],
                ["doc_id", "content", "n_lines", "n_dropped", "keep_bitmap"],
            )

    fields = [*narrow.schema.fields, T.StructField("n_dropped", T.LongType()), T.StructField("keep_bitmap", T.BinaryType())]
    return joined.mapInArrow(run, T.StructType(fields))


def kept_text(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut down to the kept lines (NULL becomes the empty text).

    Bitmaps of documents that lose lines are sent to the texts if they are small, by measurement; else both are shuffled.
    """
    losing = bitmaps.filter("n_dropped > 0").select("doc_id", "content", "n_lines", "keep_bitmap").distinct()
    losing = write_and_reopen(losing, scratch_path(docs.sparkSession, "line-bitmaps"))
    keyed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), F.xxhash64(docs["text"]).alias("content"))
    side = F.broadcast(losing) if fits_broadcast(losing) else losing
    joined = (
        keyed.alias("d")
        .join(side.alias("b"), F.expr("d.doc.doc_id <=> b.doc_id AND d.content = b.content"), "left")
        .select("d.doc", "b.n_lines", "b.keep_bitmap", F.coalesce("d.doc.text", F.lit("")).alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            maps, counts = batch.column("keep_bitmap").to_pylist(), batch.column("n_lines").to_pylist()
            for i, (bitmap, n) in enumerate(zip(maps, counts, strict=True)):
                if bitmap is not None:
                    keep = unpacked(bitmap, n)
                    texts[i] = "\n".join(line for line, k in zip(texts[i].split("\n"), keep.tolist(), strict=True) if k)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], ["doc", "text"])

    schema = T.StructType([joined.schema["doc"], T.StructField("text", T.StringType())])
    out = joined.mapInArrow(run, schema)
    return out.select(*(F.col("text") if c == "text" else F.col(f"doc.{c}").alias(c) for c in docs.columns))
