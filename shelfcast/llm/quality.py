"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Every token has a sparse ternary *index vector*, made from its hash. A *context vector* is the sum of the index
vectors of the neighbours of a token, over all documents, labelled or not. Tokens are the words and,
in a second stream, their shapes: upper case, digits, symbols, repetition. Context vectors of words are kept in a
fixed number of buckets (feature hashing): every word, however rare, has the vector of the bucket that its hash names, and the
words of one bucket share it. A document is the mean of the normalised vectors of its words and of their shapes, with the
mean rarity of its buckets and its length; a network of two layers, trained in numpy on a
bounded sample of labelled documents, gives a logit, and a temperature fitted on rows of their own makes its
probability calibrated.

The number of buckets is part of the model, as the number of dimensions is; it doesn't depend on the input, and neither does
what a task holds or what the model weighs. Tasks add contexts up in place, some thousand words at a time, and send them once
in compressed pieces of a range of buckets each; the pieces of a range are added up in one place, as they come. Sums
are of whole numbers, so they don't depend on order or layout.

Learning and scoring read every text as a whole, with no Python object per word; no text is shuffled.

Defined results: NULL and empty texts are pooled to zeros and scored like any other; labels that are NULL, or of
documents that aren't there, are not learned from, of several labels the highest counts, of several texts under one
labelled id the one with the smallest hash; repeated rows get
equal scores; without any usable label all scores are 0.5; an empty table gives an empty result; only doc_id and
text of the scored documents are read, other columns pass where documents are filtered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.holdout import held_out
from shelfcast.llm.word_arrays import WordHasher, giving_back, mix, text_slices
from shelfcast.workspace import arrow_rows, scratch_path, write_and_reopen

#: Labelled documents that are learned from, at most (about), and the share of them that sets the temperature.
SAMPLE_ROWS, CALIBRATION = 6_000, 0.2
#: Buckets of word vectors, as a power of two; a task's sums take 200 bytes for each, the model 49.
BUCKET_BITS = 19
#: Dimensions of the vectors, non-zero entries of an index vector, neighbours on each side.
DIMENSIONS, ENTRIES, REACH = 48, 4, 2
#: Units of the hidden layer; passes over the sample, rows of a step, step size, weight decay.
HIDDEN, PASSES, STEP_ROWS, RATE, DECAY = 24, 40, 64, 0.004, 1e-4
#: Score from which a document is predicted to be of quality 1.
THRESHOLD = 0.3

_SHAPES = 64
_SLICE = 1 << 19  # bytes of text whose words are made at a time
_BATCH_ROWS = 1_000  # of a batch that Spark hands to a task
_CHUNK = 1 << 15  # words of a text or of several whose contexts are summed at a time
_RANGE = 1 << 14  # buckets whose sums are added up together
_HELD = 1 << 25  # uses that a task adds up before it sends them: their sums fit 32 bits
_PARTS = 8  # tasks that pool the sample
_STEPS = 127  # of a whole number's range in a component of a unit vector
_RARITY = 3  # steps of rarity for each halving of a bucket's uses


def index_vectors(tokens: np.ndarray) -> np.ndarray:
    """Sparse ternary vectors: ``ENTRIES`` places and signs, from the token's hash alone."""
    out = np.zeros((len(tokens), DIMENSIONS), np.int8)
    rows = np.arange(len(tokens))
    for i in range(ENTRIES):
        h = mix(mix(tokens + np.uint64(i)))
        out[rows, (h >> np.uint64(33)) % np.uint64(DIMENSIONS)] += np.where(h & np.uint64(1), 1, -1).astype(np.int8)
    return out


def word_shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A number below 64 per word: letter case, symbols, digits, and whether it repeats one of the two words before."""

    def count(mask: np.ndarray) -> np.ndarray:
        run = np.append(0, np.cumsum(mask))
        return run[ends] - run[starts]

    upper = count((data >= 65) & (data <= 90))
    lower = count(((data >= 97) & (data <= 122)) | (data >= 128))
    digit = count((data >= 48) & (data <= 57))
    mild = count((data == 44) | (data == 46))
    symbol = (ends - starts) - upper - lower - digit
    case = np.where(upper == 0, 0, np.where(upper == 1, 1, np.where(lower == 0, 2, 3)))
    marks = np.where(symbol == 0, 0, np.where(upper + lower + digit == 0, 3, np.where(symbol == mild, 1, 2)))
    again = np.zeros(len(words), bool)
    for back in (1, 2):
        again[back:] |= (words[back:] == words[:-back]) & (owner[back:] == owner[:-back])
    return case * 16 + marks * 4 + (digit > 0) * 2 + again


def _tokens(batches: Iterator[pa.RecordBatch]):
    """(batch, first row, rows, document, word hashes, shapes) of slices."""
    hasher = WordHasher()
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column("text"), _SLICE):
            starts, ends, document, words = hasher.words(data, offsets)
            yield batch, first, end - first, document, words, word_shapes(data, starts, ends, words, document)


def buckets(words: np.ndarray) -> np.ndarray:
    """The bucket of each word."""
    return words >> np.uint64(64 - BUCKET_BITS)


def summed(keys: np.ndarray, n: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the totals of ``n`` and of the rows of ``sums``."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if not len(first):
        return keys, n.astype(np.int64), sums.astype(np.int64)
    return keys[first], np.add.reduceat(n[order].astype(np.int64), first), np.add.reduceat(sums[order], first, dtype=np.int64)


def context_sums(words: np.ndarray, owner: np.ndarray, shapes: np.ndarray, own: slice = slice(None)) -> list[tuple]:
    """(keys, uses, sums of the index vectors of the neighbours' words and shapes), of the ``own`` words' buckets and of their shapes."""
    distinct, at = np.unique(words, return_inverse=True)
    near = index_vectors(distinct)[at] + index_vectors(mix(np.arange(_SHAPES, dtype=np.uint64)))[shapes]
    total = np.zeros_like(near)  # 2 * REACH neighbours with 2 * ENTRIES at most: fits a byte
    for step in range(1, REACH + 1):
        same = (owner[step:] == owner[:-step])[:, None]
        total[step:] += near[:-step] * same
        total[:-step] += near[step:] * same
    words, shapes, total = words[own], shapes[own].astype(np.uint64), total[own]
    ones = np.ones(len(words), np.int64)
    return [summed(buckets(words), ones, total), summed(shapes, ones, total)]


def _context_chunks(words: np.ndarray, owner: np.ndarray, shapes: np.ndarray) -> Iterator[list[tuple]]:
    """``context_sums`` of all words, ``_CHUNK`` at a time: a long text needs no more memory than a short one."""
    for at in range(0, len(words), _CHUNK):
        end = min(at + _CHUNK, len(words))
        low, high = max(0, at - REACH), min(len(words), end + REACH)
        yield context_sums(words[low:high], owner[low:high], shapes[low:high], slice(at - low, end - low))


def _merged(parts: list[tuple]) -> tuple:
    return summed(*(np.concatenate(c) for c in zip(*parts, strict=True)))


def _planes(numbers: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones, and so on."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _numbers(data: memoryview, kind: np.dtype, count: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, count * kind.itemsize).reshape(kind.itemsize, count)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def compressed(keys: np.ndarray, n: np.ndarray, sums: np.ndarray) -> bytes:
    """Sorted keys, their uses and sums, in the narrowest whole numbers that hold the sums, compressed."""
    most = int(np.abs(sums).max(initial=0))
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
    steps = np.diff(keys, prepend=np.uint64(0))
    data = _planes(steps) + _planes(n.astype(np.int64)) + _planes(sums.astype(kind))
    return np.array([*sums.shape, np.dtype(kind).itemsize], np.int64).tobytes() + pa.compress(data, "zstd", asbytes=True)


def uncompressed(piece: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys, uses and sums of ``compressed``."""
    rows, columns, width = np.frombuffer(piece, np.int64, 3).tolist()
    kind = np.dtype(f"i{width}")
    data = memoryview(pa.decompress(piece[24:], rows * (16 + columns * width), "zstd", asbytes=True))
    keys = np.cumsum(_numbers(data, np.dtype(np.uint64), rows), dtype=np.uint64)
    n = _numbers(data[8 * rows :], np.dtype(np.int64), rows)
    return keys, n, _numbers(data[16 * rows :], kind, rows * columns).reshape(rows, columns)


_PIECES = "shape boolean, part long, piece binary"


def _pieces(shape: bool, keys: np.ndarray, n: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Compressed pieces of sorted keys, one or two of each range: sums that need more than a byte are apart."""
    for part in np.unique(keys // np.uint64(_RANGE)).tolist():
        low, high = np.searchsorted(keys, np.array([part, part + 1], np.uint64) * np.uint64(_RANGE))
        small = np.abs(sums[low:high]).max(1, initial=0) < 128
        rows = [low + np.flatnonzero(mask) for mask in (small, ~small) if mask.any()]
        pieces = [compressed(keys[r], n[r], sums[r]) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([shape] * len(pieces)), pa.array([part] * len(pieces), pa.int64()), pa.array(pieces, pa.binary())],
            ["shape", "part", "piece"],
        )


class ContextTable:
    """Uses and context sums of all buckets, added up in place."""

    def __init__(self):
        self.n = np.zeros(1 << BUCKET_BITS, np.int64)
        self.sums = np.zeros((1 << BUCKET_BITS, DIMENSIONS), np.int32)
        self.uses = 0

    def add(self, keys: np.ndarray, n: np.ndarray, sums: np.ndarray) -> None:
        """Add the sums of distinct buckets."""
        at = keys.astype(np.int64)
        self.n[at] += n
        self.sums[at] += sums.astype(np.int32)
        self.uses += int(n.sum())

    def emptied(self) -> Iterator[pa.RecordBatch]:
        """Pieces of what the table holds; then it holds nothing."""
        for low in range(0, len(self.n), _RANGE):
            at = low + np.flatnonzero(self.n[low : low + _RANGE])
            yield from _pieces(False, at.astype(np.uint64), self.n[at], self.sums[at])
            self.n[at], self.sums[at] = 0, 0
        self.uses = 0


@giving_back
def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, shapes_held = ContextTable(), []
    for _, _, _, document, words, shapes in _tokens(batches):
        for of_words, of_shapes in _context_chunks(words, document, shapes):
            shapes_held = [_merged([*shapes_held, of_shapes])]
            if table.uses + _CHUNK > _HELD:
                yield from table.emptied()
            table.add(*of_words)
    yield from table.emptied()
    if shapes_held:
        yield from _pieces(True, *shapes_held[0])


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(shape, keys, uses, sums) of each range, whose pieces come one after the other and are added up in place."""
    uses, totals, last = np.zeros(_RANGE, np.int64), np.zeros((_RANGE, DIMENSIONS), np.int64), None

    def whole():
        at = np.flatnonzero(uses)
        found = last[0], at.astype(np.uint64) + np.uint64(last[1] * _RANGE), uses[at], totals[at]
        uses[at], totals[at] = 0, 0
        return found

    for batch in batches:
        for shape, part, piece in zip(*(batch.column(i) for i in range(3)), strict=True):
            shape, part = shape.as_py(), part.as_py()
            if last is not None and (shape, part) != last:
                yield whole()
            last = shape, part
            keys, n, sums = uncompressed(piece.as_buffer())
            at = (keys - np.uint64(part * _RANGE)).astype(np.int64)
            uses[at] += n
            totals[at] += sums
    if last is not None:
        yield whole()


def corpus_contexts(docs: DataFrame) -> DataFrame:
    """shape, part and piece: uses and context sums of all shapes and of all buckets with a use, in compressed pieces."""

    @giving_back
    def totals(batches):
        for shape, keys, n, sums in _ranges(batches):
            yield from _pieces(shape, keys, n, sums)

    pieces = docs.select("text").mapInArrow(_contexts, _PIECES)
    return pieces.repartition("shape", "part").sortWithinPartitions("shape", "part").mapInArrow(totals, _PIECES)


def _unit(n: np.ndarray, sums: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Directions of the contexts less what a use of any word has, in whole ``_STEPS``."""
    own = sums - n[:, None] * usual
    return np.rint(_STEPS * own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-6)).astype(np.int8)


def _rarity(n: np.ndarray, total: int) -> np.ndarray:
    """Halvings from all uses to those of a bucket, in steps of ``_RARITY`` to one."""
    return np.clip(np.rint(_RARITY * np.log2(max(total, 1) / np.maximum(n, 1))), 0, 127).astype(np.int8)


class QualityModel:
    """Vectors of buckets and shapes, network and temperature."""

    def __init__(self, contexts: DataFrame):
        found = [uncompressed(r.piece) for r in contexts.filter("shape").collect()]  # one range: two pieces at most
        at, n, sums = _merged(found) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, DIMENSIONS)))
        total = int(n.sum())
        usual = sums.sum(0) / max(total, 1)  # every use has one shape
        self.shapes = np.zeros((_SHAPES, DIMENSIONS), np.float32)
        self.shapes[at.astype(np.int64)] = _unit(n, sums, usual) / _STEPS

        def vectors(batches):
            for batch in batches:
                for piece in batch.column("piece").to_pylist():
                    keys, n, sums = uncompressed(piece)
                    rows = np.column_stack([_unit(n, sums, usual), _rarity(n, total)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys.tobytes()], pa.binary()), pa.array([rows.tobytes()], pa.binary())], ["keys", "rows"]
                    )

        # by dimension, then the rarity; bounded by the number of buckets
        table = np.zeros((DIMENSIONS + 1, 1 << BUCKET_BITS), np.int8)
        table[-1] = _rarity(np.zeros(1), total)
        for row in contexts.filter("NOT shape").mapInArrow(vectors, "keys binary, rows binary").toLocalIterator():
            keys = np.frombuffer(row["keys"], np.uint64).astype(np.int64)
            table[:, keys] = np.frombuffer(row["rows"], np.int8).reshape(-1, DIMENSIONS + 1).T
        self.table = contexts.sparkSession.sparkContext.broadcast(table)
        self.layers: dict[str, np.ndarray] = {}
        self.center = self.spread = np.zeros(0)
        self.temperature = 1.0

    @property
    def words(self) -> np.ndarray:
        """The buckets' vectors, by dimension, and their rarity."""
        return self.table.value

    def features(self, document: np.ndarray, words: np.ndarray, shapes: np.ndarray, n: int) -> np.ndarray:
        """Means of the word vectors, the mean rarity, means of the shape vectors, logarithm of the length."""
        counts = np.bincount(document, minlength=n)
        some = counts > 0
        sums = np.zeros((n, DIMENSIONS + 1), np.int64)
        if len(words):
            first, at = (np.cumsum(counts) - counts)[some], buckets(words).astype(np.int64)
            for i, values in enumerate(self.words):  # one dimension at a time keeps memory small
                sums[some, i] = np.add.reduceat(values[at], first, dtype=np.int64)
        least = np.maximum(counts, 1)[:, None]
        scale = np.append(np.full(DIMENSIONS, _STEPS), 16 * _RARITY)
        shares = np.bincount(document * _SHAPES + shapes, minlength=n * _SHAPES).reshape(n, _SHAPES) / least
        return np.concatenate([sums / scale / least, shares @ self.shapes, np.log1p(counts)[:, None]], 1).astype(np.float32)

    def logits(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.center) / self.spread
        return np.tanh(x @ self.layers["w"] + self.layers["b"]) @ self.layers["v"] + self.layers["c"]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.tanh(0.5 * self.logits(features) / self.temperature))

    def fit(self, features: np.ndarray, labels: np.ndarray, calibrate: np.ndarray, seed: int = 11) -> None:
        """Adam on the rows that don't calibrate, then the temperature with the least loss on those that do."""
        rng = np.random.default_rng(seed)
        learn = ~calibrate if (~calibrate).any() else calibrate
        x, y = features[learn], labels[learn]
        self.center, self.spread = x.mean(0), x.std(0) + 1e-3
        x = (x - self.center) / self.spread
        d = x.shape[1]
        p = {"w": rng.normal(0, d**-0.5, (d, HIDDEN)), "b": np.zeros(HIDDEN), "v": rng.normal(0, 0.2, HIDDEN)}
        p["c"] = np.zeros(())
        moments = {k: [np.zeros_like(a), np.zeros_like(a)] for k, a in p.items()}
        step = 0
        for _ in range(PASSES):
            order = rng.permutation(len(x))
            for at in range(0, len(order), STEP_ROWS):
                rows = order[at : at + STEP_ROWS]
                hidden = np.tanh(x[rows] @ p["w"] + p["b"])
                error = (0.5 * (1 + np.tanh(0.5 * (hidden @ p["v"] + p["c"]))) - y[rows]) / len(rows)
                inner = error[:, None] * p["v"] * (1 - hidden * hidden)
                grads = {"w": x[rows].T @ inner, "b": inner.sum(0), "v": hidden.T @ error, "c": error.sum()}
                step += 1
                for k, g in grads.items():
                    m = moments[k]
                    m[0] = 0.9 * m[0] + 0.1 * g
                    m[1] = 0.99 * m[1] + 0.01 * g * g
                    p[k] = p[k] - RATE * (m[0] / (1 - 0.9**step) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8) + DECAY * p[k])
        self.layers = p
        if calibrate.any():
            z, y = self.logits(features[calibrate]), labels[calibrate]
            choices = np.geomspace(0.25, 8, 61)
            loss = [np.logaddexp(0, np.where(y > 0, -z, z) / t).mean() for t in choices]
            self.temperature = float(choices[int(np.argmin(loss))])


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, quality and text_hash of about ``SAMPLE_ROWS`` labelled documents outside the held-out fold, one for each id.

    The bounded list of chosen ids is broadcast, so that no text is shuffled but those of the sample.
    """
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    total = marked.count()
    by_hash = F.xxhash64("doc_id")
    chosen = marked.filter(F.pmod(by_hash, F.lit(1 << 20)) < (1 << 20) * SAMPLE_ROWS / max(total, 1))
    chosen = chosen.orderBy(by_hash, "doc_id").limit(2 * SAMPLE_ROWS)  # far above what the filter leaves: a bound for the broadcast
    found = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(F.broadcast(chosen), "doc_id")
    first = F.min(F.struct("text_hash", "text", "quality")).alias("first")
    return found.groupBy("doc_id").agg(first).select("doc_id", "first.text", "first.quality", "first.text_hash")


def fit_quality_model(docs: DataFrame, labels: DataFrame) -> QualityModel | None:
    """Vectors of all documents' words; network and temperature from a bounded sample."""
    with arrow_rows(docs.sparkSession, _BATCH_ROWS):
        return _fitted(docs, labels)


def _fitted(docs: DataFrame, labels: DataFrame) -> QualityModel | None:
    spark = docs.sparkSession
    sample = write_and_reopen(
        labelled_sample(docs, labels).repartition(_PARTS, "doc_id"), scratch_path(spark, "quality-sample")
    )
    if sample.isEmpty():
        return None
    model = QualityModel(write_and_reopen(corpus_contexts(docs), scratch_path(spark, "quality-contexts")))
    kept = ["doc_id", "quality", "text_hash"]
    schema = T.StructType([*(sample.schema[c] for c in kept), T.StructField("features", T.BinaryType())])

    @giving_back
    def run(batches):
        for batch, first, n, document, words, shapes in _tokens(batches):
            rows = [r.tobytes() for r in model.features(document, words, shapes, n)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(first, n) for c in kept), pa.array(rows, pa.binary())], schema.names
            )

    found = sample.mapInArrow(run, schema).toPandas()
    found["doc_id"] = found["doc_id"].astype(str)
    found = found.sort_values(["doc_id", "text_hash"])
    features = np.stack([np.frombuffer(f, np.float32) for f in found["features"]])
    number = np.array([int.from_bytes(d.encode(), "big") % 1_000_003 for d in found["doc_id"]], np.uint64)
    calibrate = mix(number) >> np.uint64(11) < np.uint64(CALIBRATION * (1 << 53))
    model.fit(features, found["quality"].to_numpy(np.float64), calibrate)
    return model


def _scored(batches: Iterator[pa.RecordBatch], model: QualityModel | None):
    """(batch, first row, rows, scores) of slices."""
    for batch, first, n, document, words, shapes in _tokens(batches):
        if model is None:
            yield batch, first, n, np.full(n, 0.5)
        else:
            yield batch, first, n, model.scores(model.features(document, words, shapes, n)).astype(np.float64)


def score_quality(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """doc_id and score of every document; no shuffle."""

    @giving_back
    def run(batches):
        for batch, first, n, scores in _scored(batches, model):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, n), pa.array(scores)], ["doc_id", "score"]
            )

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())]
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_quality(docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least the threshold, with all their columns; no shuffle."""

    @giving_back
    def run(batches):
        for batch, first, n, scores in _scored(batches, model):
            yield batch.slice(first, n).filter(pa.array(scores >= threshold))

    return docs.mapInArrow(run, docs.schema)
