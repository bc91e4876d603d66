"""Best-fit decreasing packing of documents into sequences of a fixed number of tokens.

A document is its token ids and an end id; only documents longer than a sequence are cut, into pieces of a
whole sequence and a last, shorter one. Pieces are packed in the order of falling length, each into the
open sequence with the least room that still holds it; a segment tree over the remaining capacities finds
that sequence in a number of steps logarithmic in the capacity.

Where a piece goes depends on its length alone, and pieces of one length are interchangeable. So the packing
of the whole table is decided from its histogram of lengths, which has no more rows than a sequence has
tokens: a run of equal pieces takes a run of equally filled sequences, with the result that best fit has one
piece after the other. The histogram and the runs are all the driver sees, however large the table. The
pieces are then numbered inside their length (in ranges of a digest, so that no length is one task's) and
look up their run.

A word's ids do not depend on the words around it, since the vocabulary's rules cut at white space and between
letters, digits and other characters, and fold case. Each task therefore encodes a distinct word once and lays
the ids of the documents together with numpy. Words are known by 64-bit hashes in a task's table of bounded size
(``KNOWN_WORDS``): of n words n * n / 2**65 pairs can be expected to clash, 3 * 10**-8 for a full table.

Defined results: NULL and empty texts are the end id alone; texts of any length are encoded whole, a slice at
a time; repeated rows are documents of their own; documents of equal length keep the order of a digest, so
reruns agree; a NULL doc_id is kept; an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.word_arrays import SLICE_BYTES, SPACES, WordHasher, mix, text_slices
from shelfcast.workspace import scratch_path, write_and_reopen

#: Words whose ids a task keeps; a full table is emptied.
KNOWN_WORDS = 1 << 20
#: The id after every document.
END_ID = 0
#: Cells per shuffle partition into which the pieces are ranked.
CELLS = 4

_PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]
_RANK_BITS = 40


class OpenSequences:
    """Runs of equally filled sequences under their remaining capacity, in a segment tree over capacities."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)  # runs below each node
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _count(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.open[node] += change
            node >>= 1

    def add(self, room: int, first: int, sequences: int) -> None:
        if sequences:
            self.runs[room].append((first, sequences))
            self._count(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._count(room, -1)
        return self.runs[room].pop()

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of ``length`` or more that an open sequence has."""
        node = length + self.leaves
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):  # up, until there is something to the right
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:  # down again, to the left where possible
                node = 2 * node + (not self.open[2 * node])
        return node - self.leaves


def best_fit_runs(counts: Mapping[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing for ``counts[length]`` pieces of each length.

    One row per run: length, rank of its first piece, first sequence, pieces per sequence, offset of the
    first piece in a sequence. The rows are in the order of length and rank.
    """
    tree, sequences, runs = OpenSequences(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:  # as many new sequences as the rest will take
                new = -(-left // (capacity // length))
                tree.add(capacity, sequences, new)
                sequences += new
                continue
            first, n = tree.take(room)
            each = room // length  # the tightest sequence stays so until it can't take another
            full = min(n, left // each)
            if full:
                runs.append((length, rank, first, each, capacity - room))
                tree.add(room - each * length, first, full)
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and left:  # fewer pieces than this sequence could take
                runs.append((length, rank, first, left, capacity - room))
                tree.add(room - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            tree.add(room, first, n)
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


class PretokenHasher(WordHasher):
    """Words cut further where the vocabulary's rules surely cut: between ASCII letters, digits (each alone) and
    other ASCII characters. An apostrophe may belong to either side and a non-ASCII character may compose with
    what is before it, so there is no cut beside them."""

    def __init__(self):
        super().__init__(fold_case=False)
        self.kind = np.zeros(256, np.uint8)
        for i in range(128):
            if i not in SPACES and chr(i) != "'":
                self.kind[i] = 1 if chr(i).isalpha() else 2 if chr(i).isdigit() else 3

    @staticmethod
    def folded(data: np.ndarray) -> np.ndarray:
        """A-Z as a-z, but for letters before a non-ASCII character."""
        data = data.copy()
        upper = (data >= 65) & (data <= 90)
        upper[:-1] &= data[1:] < 128
        data[upper] += 32
        return data

    def words(self, data, offsets):
        n = len(data)
        inside, kind = self.is_word[data], self.kind[data]
        edge = np.zeros(n + 1, bool)
        left, right = kind[:-1], kind[1:]
        edge[1:n] = (inside[1:] != inside[:-1]) | ((left > 0) & (right > 0) & ((left != right) | (left == 2)))
        edge[0] = edge[n] = True
        edge[offsets] = True
        bounds = np.flatnonzero(edge)
        starts, ends = bounds[:-1], bounds[1:]
        keep = inside[starts] if n else np.zeros(0, bool)
        starts, ends = starts[keep], ends[keep]
        self._grow(n + 1)
        running = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:n], out=running[1:])
        hashes = mix((running[ends] - running[starts]) * self.inverses[starts])
        return starts, ends, np.searchsorted(offsets, starts, "right") - 1, hashes


class WordIds:
    """Token ids of texts; every distinct word is encoded once as long as the table has room."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode_batch_fast
        self.specials = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        self.pretokens, self.whole_words = PretokenHasher(), WordHasher(fold_case=False)
        self._empty()

    def _empty(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)  # a name's place in the lists
        self.firsts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, names: np.ndarray, words: list[str]) -> None:
        found = [e.ids for e in self.encode(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.firsts = np.append(self.firsts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.at = np.append(self.at, np.arange(len(self.sizes), len(self.sizes) + len(sizes)))
        self.sizes = np.append(self.sizes, sizes)
        self.ids = np.append(self.ids, np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum())))
        self.names = np.append(self.names, names)
        order = np.argsort(self.names)
        self.names, self.at = self.names[order], self.at[order]

    def of_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a slice end to end, offsets of the texts in them)."""
        raw = data.tobytes()
        if any(x in raw for x in self.specials):  # one token each, if they stay whole and keep their case
            hasher = self.whole_words
        else:
            hasher, data = self.pretokens, self.pretokens.folded(data)
        starts, ends, document, hashes = hasher.words(data, offsets)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.names) + len(distinct) > KNOWN_WORDS:
            self._empty()
        unknown = ~np.isin(distinct, self.names, assume_unique=True)
        if unknown.any():
            raw, at = data.tobytes(), first[unknown]
            words = [raw[s:e].decode() for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            self._learn(distinct[unknown], words)
        place = self.at[np.searchsorted(self.names, distinct)][which]
        sizes = self.sizes[place]
        total = int(sizes.sum())
        before = np.cumsum(sizes) - sizes
        ids = self.ids[np.repeat(self.firsts[place] - before, sizes) + np.arange(total)]
        per_text = np.bincount(document, sizes, len(offsets) - 1).astype(np.int64)
        return ids, np.append(0, np.cumsum(per_text))

    def of_texts(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, offsets) of slices; a long text is worked on in parts that end at white space."""
        for first, end, data, offsets in text_slices(texts, SLICE_BYTES):
            if len(data) <= 2 * SLICE_BYTES:
                yield first, end, *self.of_slice(data, offsets)
                continue
            cuts = [0]
            while cuts[-1] < len(data):
                at = cuts[-1] + SLICE_BYTES
                space = np.flatnonzero(np.isin(data[at : at + SLICE_BYTES], SPACES))
                while not len(space) and at < len(data):
                    at += SLICE_BYTES
                    space = np.flatnonzero(np.isin(data[at : at + SLICE_BYTES], SPACES))
                cuts.append(at + int(space[0]) if len(space) else len(data))
            parts = [self.of_slice(data[a:b], np.array([0, b - a]))[0] for a, b in zip(cuts, cuts[1:], strict=False)]
            ids = np.concatenate(parts)
            yield first, end, ids, np.array([0, len(ids)])


def token_pieces(docs: DataFrame, path: str, capacity: int, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, ``copy`` telling equal rows of a batch apart, and
    the ids themselves with ``keep_ids``. The vocabulary file must be readable at ``path`` on every executor."""

    def cut(batches):
        encoder = WordIds(path)
        for batch in batches:
            for first, end, ids, offsets in encoder.of_texts(batch.column("text")):
                n = end - first
                closed = np.full(len(ids) + n, END_ID, np.uint32)
                closed[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
                offsets = offsets + np.arange(n + 1)
                size = np.diff(offsets)
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(n), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                spans = list(zip((offsets[row] + start).tolist(), length.tolist(), strict=True))
                little = closed.astype("<u4", copy=False)
                doc_id = batch.column("doc_id").slice(first, n).take(pa.array(row))
                out = pd.DataFrame(
                    {
                        "piece": piece.astype(np.int32),
                        "start": start,
                        "length": length,
                        "ids_crc32": np.array([zlib.crc32(little[a : a + k]) for a, k in spans], np.int64),
                    }
                )
                same = out.assign(doc_id=doc_id.to_pandas()).groupby([*out.columns, "doc_id"], dropna=False)
                columns = [doc_id, *(pa.array(out[c]) for c in out), pa.array(same.cumcount().astype(np.int32))]
                names = [*_PIECE, "copy"]
                if keep_ids:
                    bounds = pa.array(np.append(0, np.cumsum(length)).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(closed.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")),
            T.StructField("copy", T.IntegerType()),
            *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to written pieces (their lengths from 1 to ``capacity``).

    Pieces of one length are numbered by a digest; a cell is a range of it, and no cell holds much more than
    a ``CELLS``-th of a partition's share of all pieces.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = best_fit_runs(counts, capacity)
    partitions = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, sum(counts.values()) // (CELLS * partitions))
    cells = [0] + [-(-counts.get(length, 0) // share) for length in range(1, capacity + 1)]
    digest = F.shiftrightunsigned(F.xxhash64(*_PIECE, "copy"), 1)
    cell = F.floor(F.col("_at") / F.lit(2.0**63) * F.col("_cells")).cast("int")
    ranged = (
        pieces.withColumn("_at", digest)
        .withColumn("_cells", F.get(F.lit(cells), F.col("length").cast("int")))
        .withColumn("_cell", F.least(cell, F.col("_cells") - 1))
    )
    before, total = {}, {}
    for r in sorted(ranged.groupBy("length", "_cell").count().collect()):
        before[r["length"], r["_cell"]] = total.get(r["length"], 0)
        total[r["length"]] = total.get(r["length"], 0) + r["count"]
    run_keys = (runs[:, 0] << _RANK_BITS) + runs[:, 1]

    def place(batches):
        current, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            cell = batch.column("_cell").to_numpy()
            edge = np.flatnonzero(np.append(True, (length[1:] != length[:-1]) | (cell[1:] != cell[:-1])))
            sizes = np.diff(np.append(edge, len(length)))
            firsts = []
            for at, size in zip(edge.tolist(), sizes.tolist(), strict=True):
                key = (int(length[at]), int(cell[at]))
                seen = seen if key == current else 0
                firsts.append(before[key] + seen - at)
                current, seen = key, seen + size
            rank = np.arange(len(length)) + np.repeat(np.array(firsts, np.int64), sizes)
            run = runs[np.searchsorted(run_keys, (length << _RANK_BITS) + rank, "right") - 1]
            at = rank - run[:, 1]
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(run[:, 2] + at // run[:, 3]), pa.array(run[:, 4] + at % run[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    kept = [c for c in pieces.columns if c != "copy"]
    schema = T.StructType(
        [pieces.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]
    )
    order = ["length", "_cell", "_at", *_PIECE]
    dealt = ranged.repartition("length", "_cell").sortWithinPartitions(*order)
    return dealt.select(*kept, "_cell").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document."""
    pieces = token_pieces(docs, path, capacity)
    return place_pieces(write_and_reopen(pieces, scratch_path(docs.sparkSession, "pack-pieces")), capacity)


def packed_sequences(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """sequence_id and ids of every sequence: the training rows themselves."""
    pieces = token_pieces(docs, path, capacity, keep_ids=True)
    placed = place_pieces(write_and_reopen(pieces, scratch_path(docs.sparkSession, "pack-ids")), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
