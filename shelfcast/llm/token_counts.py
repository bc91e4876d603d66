"""Token counts of documents without tokenising the documents.

A byte-level tokenizer first cuts a text into pre-tokens and then encodes each alone. So every distinct
pre-token is encoded once, its number of pieces is joined to the pre-token frequencies of the documents
and summed; no token id of a document is ever made.

Pre-tokens are found for whole batches with numpy, by the rule of the vocabulary file's pre-tokenizer
(contractions, an optional space before letters, digits or other characters, white space), and named by
64-bit hashes. Most occurrences are of a bounded number of frequent pre-tokens, whose pieces every
executor gets as one table of fixed size; the frequencies of all other ones are shuffled and joined. Of
n distinct pre-tokens, n * n / 2**65 pairs can be expected to share a name.

Special strings inside a text are one token each, as the library takes them by default.

Defined results: NULL and empty texts have no tokens; repeated rows are counted each; a NULL doc_id is kept;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.word_arrays import mix, text_slices
from shelfcast.workspace import scratch_path, write_and_reopen

#: Frequent pre-tokens whose pieces are sent to every executor: 12 bytes each.
FREQUENT = 1 << 17
#: Distinct pre-tokens a task gathers before it passes them on.
GATHERED = 1 << 17

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# The contractions of the pre-tokenizer's rule, in its order.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

# The characters with the White_Space property of Unicode.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)


def character_classes(path: str) -> np.ndarray:
    """Class of every code point: letter (L*), number (N*), white space or other.

    Code points that Python's Unicode tables don't know yet are tried with the library itself: after a letter or
    a digit, does it stay in one pre-token with it?
    """
    from tokenizers import Tokenizer

    kinds = {"L": LETTER, "N": NUMBER}
    names = [unicodedata.category(chr(i)) for i in range(0x110000)]
    classes = np.array([kinds.get(name[0], OTHER) for name in names], np.uint8)
    classes[list(WHITE_SPACE)] = SPACE
    unknown = [i for i in range(0x40000) if names[i] == "Cn"]
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    for before, kind in (("a", LETTER), ("1", NUMBER)):
        for at in range(0, len(unknown), 10_000):
            part = unknown[at : at + 10_000]
            spans = split("".join(f"{before}{chr(i)}\n" for i in part))
            together = [s // 3 for _, (s, e) in spans if s % 3 == 0 and e - s >= 2]
            classes[np.array(part)[together]] = kind
    return classes


def pretoken_bounds(points: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the pre-tokens of texts laid end to end as code points; none crosses a text's end."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes[points]
    cut = np.zeros(n + 1, bool)
    cut[0] = cut[n] = True
    cut[1:n] = kind[1:] != kind[:-1]
    text_edge = np.zeros(n + 1, bool)
    text_edge[offsets] = True
    cut |= text_edge
    last_space = np.zeros(n, bool)  # the last of a run of white space, with more text behind
    last_space[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~text_edge[1:n]
    at = np.flatnonzero(last_space)
    cut[at] = True
    cut[at[points[at] == 0x20] + 1] = False  # a blank goes with what follows
    quote = np.flatnonzero((points == 0x27) & cut[:n])  # a pre-token that begins with an apostrophe
    quote = quote[cut[quote + 1] & ~text_edge[quote + 1]]
    ahead = [np.where(quote + j < n, points[np.minimum(quote + j, n - 1)], 0) for j in (1, 2)]
    ahead[1] = np.where(text_edge[np.minimum(quote + 2, n)], 0, ahead[1])
    for suffix in CONTRACTIONS:
        fits = ahead[0] == ord(suffix[1])
        if len(suffix) == 3:
            fits &= ahead[1] == ord(suffix[2])
        found = quote[fits]
        cut[found + 1] = False
        cut[found + len(suffix)] = True
    bounds = np.flatnonzero(cut)
    return bounds[:-1], bounds[1:]


def _code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A slice of UTF-8 as code points, and the offsets counted in them."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return points, leads[offsets]


def _named(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: list) -> np.ndarray:
    """Hashes of spans from one running sum."""
    n = len(points)
    if len(powers[0]) <= n:
        for i, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(n + (1 << 20), base, np.uint64)
            steps[0] = 1
            powers[i] = np.multiply.accumulate(steps)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum((mix(points + np.uint64(1)) | np.uint64(1)) * powers[0][:n], out=running[1:])
    return mix((running[ends] - running[starts]) * powers[1][starts])


def pretokens(batches: Iterator[pa.RecordBatch], classes: np.ndarray, specials: list[str]):
    """(batch, first row, end row, code points, start, end, document, hash, special) of slices."""
    powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column("text")):
            points, at = _code_points(data, offsets)
            found: list[tuple[int, int]] = []
            for special in specials:  # rare: a string search over the slice
                raw, token = data.tobytes(), special.encode()
                spot = raw.find(token)
                while spot >= 0:
                    row = int(np.searchsorted(offsets, spot, "right")) - 1
                    if spot + len(token) <= offsets[row + 1]:
                        s = int(np.count_nonzero((data[:spot] & 0xC0) != 0x80))
                        found.append((s, s + len(special)))
                    spot = raw.find(token, spot + len(token))
            edges = np.unique(np.append(at, [x for pair in found for x in pair])).astype(np.int64)
            starts, ends = pretoken_bounds(points, edges, classes)
            inner = np.zeros(len(points) + 1, np.int64)
            for s, e in found:
                inner[s] += 1
                inner[e] -= 1
            inside = np.cumsum(inner)[starts] > 0 if found else np.zeros(len(starts), bool)
            if found:  # a special string is one span, not the pre-tokens in it
                begins = np.isin(starts, [s for s, _ in found])
                ends = np.where(inside & begins, 0, ends)
                for s, e in found:
                    ends[np.searchsorted(starts, s)] = e
                keep = ~inside | begins
                starts, ends, inside = starts[keep], ends[keep], inside[keep]
            document = np.searchsorted(at, starts, "right") - 1
            names = _named(points, starts, ends, powers)
            yield batch, first, end, points, starts, ends, document, names, inside


def special_tokens(path: str) -> list[str]:
    """The added tokens of a vocabulary file, which the library finds inside texts."""
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file).get("added_tokens", [])]


def piece_table(docs: DataFrame, path: str, classes, specials: list[str]) -> DataFrame:
    """(name, pieces, uses) of every distinct pre-token of the texts; each is encoded once."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def gather(batches):
        known: dict[int, list] = {}

        def out():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.fromiter(known, np.uint64, len(known)).view(np.int64)),
                    pa.array([x[0] for x in known.values()], pa.string()),
                    pa.array([x[1] for x in known.values()], pa.int64()),
                ],
                ["name", "pretoken", "uses"],
            )

        for _, _, _, points, starts, ends, _, names, inside in pretokens(batches, shared.value, specials):
            names, starts, ends = names[~inside], starts[~inside], ends[~inside]
            distinct, where, uses = np.unique(names, return_index=True, return_counts=True)
            for name, i, n in zip(distinct.tolist(), where.tolist(), uses.tolist(), strict=True):
                entry = known.get(name)
                if entry is None:
                    known[name] = [points[starts[i] : ends[i]].tobytes().decode("utf-32-le"), n]
                else:
                    entry[1] += n
            if len(known) >= GATHERED:
                yield out()
                known.clear()
        yield out()

    def count(batches):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = Tokenizer.from_file(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                encoded = tokenizer.encode_batch_fast(part.column("pretoken").to_pylist(), add_special_tokens=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column("name"), pa.array([len(e) for e in encoded], pa.int64()), part.column("uses")],
                    ["name", "pieces", "uses"],
                )

    found = docs.select("text").mapInArrow(gather, "name long, pretoken string, uses long")
    distinct = found.groupBy("name").agg(F.min("pretoken").alias("pretoken"), F.sum("uses").alias("uses"))
    return distinct.mapInArrow(count, "name long, pieces long, uses long")


def frequent_pretokens(pieces: DataFrame) -> DataFrame:
    """(name, pieces) of the most used pre-tokens, ``FREQUENT`` at most: those above a number of uses that a
    histogram of bounded size gives, so that no more than these rows reach the driver."""
    level = F.floor(F.log2("uses") * 8).cast("int").alias("level")
    left, least = FREQUENT, None
    for row in sorted(pieces.groupBy(level).count().collect(), key=lambda r: -r["level"]):
        left -= row["count"]
        if left < 0:
            break
        least = row["level"]
    return pieces.filter(F.lit(False) if least is None else level >= least).select("name", "pieces")


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document, by the byte-level BPE vocabulary file at ``path``.

    The file must be readable at ``path`` on every executor.
    """
    spark = docs.sparkSession
    classes, specials = character_classes(path), special_tokens(path)
    pieces = write_and_reopen(piece_table(docs, path, classes, specials), scratch_path(spark, "token-pieces"))
    top = frequent_pretokens(pieces).toPandas().sort_values("name")
    known = spark.sparkContext.broadcast((classes, top["name"].to_numpy(np.int64), top["pieces"].to_numpy(np.int64)))

    def frequencies(batches):
        """Per document one row with the tokens known already, and one row for each other pre-token."""
        classes, hot, hot_pieces = known.value
        for batch, first, end, _, _, _, document, names, inside in pretokens(batches, classes, specials):
            n = end - first
            texts = batch.column("text").slice(first, n).fill_null("")
            ids = batch.column("doc_id").slice(first, n)
            names = names.view(np.int64)
            spot = np.minimum(np.searchsorted(hot, names), max(len(hot) - 1, 0))
            is_hot = (hot[spot] == names) & ~inside if len(hot) else np.zeros(len(names), bool)
            tokens = np.bincount(document[inside], minlength=n) + np.bincount(
                document[is_hot], hot_pieces[spot[is_hot]], n
            ).astype(np.int64)
            rest = ~is_hot & ~inside
            order = np.lexsort((names[rest], document[rest]))
            owner, name = document[rest][order], names[rest][order]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])
            at = np.flatnonzero(new)
            uses = np.diff(np.append(at, len(owner)))
            rows = np.append(np.arange(n), owner[at])
            binary = texts.cast(pa.large_binary())
            size = np.diff(np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + n + 1])
            content = _content_names(binary, n)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(rows)),
                    pa.array(content[rows]),
                    pa.array(size[rows]),
                    pa.array(np.append(content, name[at])),
                    pa.array(np.append(tokens, uses)),
                    pa.array(np.append(np.ones(n, np.int64), np.zeros(len(at), np.int64))),
                ],
                ["doc_id", "content", "n_bytes", "name", "n", "document"],
            )

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("content", "n_bytes", "name", "n", "document")]
    )
    rows = docs.select("doc_id", "text").mapInArrow(frequencies, schema)
    joined = rows.alias("r").join(pieces.alias("p"), "name", "left")
    tokens = F.when(F.col("document") == 1, F.col("n")).otherwise(F.col("n") * F.col("pieces"))
    summed = joined.groupBy("doc_id", "content", "n_bytes").agg(
        F.sum(tokens).alias("all"), F.sum("document").alias("copies")
    )
    return summed.select(  # equal rows were summed together
        "doc_id",
        "n_bytes",
        F.expr("all div copies").alias("n_tokens"),
        F.explode(F.expr("sequence(1L, copies)")),
    ).drop("col")


def _content_names(binary: pa.Array, n: int) -> np.ndarray:
    """A 64-bit name of each text's bytes."""
    import hashlib

    digest = b"".join(hashlib.blake2b(memoryview(x.as_buffer()), digest_size=8).digest() for x in binary)
    return np.frombuffer(digest, np.int64) if n else np.zeros(0, np.int64)
