"""The quality classifier's vectors, pooling and temperature against plain versions, word by word."""

from __future__ import annotations

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import lower, words


def name_of(word):
    from shelfcast.llm.word_arrays import WordHasher

    data = np.frombuffer(lower(word).encode(), np.uint8)
    return int(WordHasher().words(data, np.array([0, len(data)]))[3][0])


def plain_shapes(tokens):
    from shelfcast.llm.quality import word_shapes

    out = []
    for i, w in enumerate(tokens):  # one word at a time, without the words around it
        data = np.frombuffer(w.encode(), np.uint8)
        alone = word_shapes(data, np.array([0]), np.array([len(data)]), np.zeros(1, np.uint64), np.zeros(1, np.int64))
        out.append(int(alone[0]) + any(lower(w) == lower(v) for v in tokens[max(0, i - 2) : i]))
    return out


def plain_contexts(texts):
    """(is a shape, bucket of a word or shape) -> [uses, sum of the index vectors around it]."""
    from shelfcast.llm.quality import BUCKET_BITS, DIMENSIONS, REACH, index_vectors
    from shelfcast.llm.word_arrays import mix

    def index(token):
        return index_vectors(np.array([token], np.uint64))[0].astype(int)

    out = collections.defaultdict(lambda: [0, np.zeros(DIMENSIONS, int)])
    for text in texts:
        tokens = words(text)
        names, shapes = [name_of(w) for w in tokens], plain_shapes(tokens)
        vectors = [index(n) + index(mix(np.array([s], np.uint64))[0]) for n, s in zip(names, shapes, strict=True)]
        places = [n >> (64 - BUCKET_BITS) for n in names]
        for i, keys in enumerate(zip(places, shapes, strict=True)):
            around = sum((vectors[j] for j in range(max(0, i - REACH), min(len(names), i + REACH + 1)) if j != i), np.zeros(DIMENSIONS, int))
            for kind, key in enumerate(keys):
                out[bool(kind), key][0] += 1
                out[bool(kind), key][1] = out[bool(kind), key][1] + around
    return out


def some_texts(rng, n=25):
    pool = ["the", "The", "of", "NASA", "x1", "12", "ärger", "...", "end.", "a,b", "文"] + [f"w{i}" for i in range(40)]
    return [None, "", " \n"] + [" ".join(rng.choices(pool, k=rng.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize(("bits", "held", "chunk", "span"), [(19, 1 << 25, 1 << 17, 1 << 14), (4, 60, 20, 3)])
def test_contexts_equal_plain_sums(documents, monkeypatch, bits, held, chunk, span):
    from shelfcast.llm import quality

    for name, value in (("BUCKET_BITS", bits), ("_HELD", held), ("_CHUNK", chunk), ("_RANGE", span)):
        monkeypatch.setattr(quality, name, value)
    rng = random.Random(1)
    texts = some_texts(rng)
    expected = plain_contexts(texts)
    got, rows = {}, 0
    for r in quality.corpus_contexts(documents(list(enumerate(texts))).repartition(3)).collect():
        for key, n, sums in zip(*(a.tolist() for a in quality.uncompressed(bytes(r.piece))), strict=True):
            got[r.shape, key] = n, sums
            rows += 1
    assert len(got) == rows
    assert got == {k: (n, v.tolist()) for k, (n, v) in expected.items()}


@pytest.mark.parametrize("bits", [19, 4])
def test_pooled_features_and_scores_equal_plain_ones(spark, documents, monkeypatch, bits):
    from shelfcast.llm import quality

    monkeypatch.setattr(quality, "BUCKET_BITS", bits)
    rng = random.Random(2)
    texts = some_texts(rng, 90)
    docs = documents(list(enumerate(texts)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, quality int")
    model = quality.fit_quality_model(docs, labels)
    contexts = plain_contexts(texts)
    uses = sum(n for (shape, _), (n, _) in contexts.items() if shape)
    usual = sum(v for (shape, _), (_, v) in contexts.items() if shape) / uses

    def unit(n, v):
        own = v - n * usual
        return np.rint(127 * own / max(np.linalg.norm(own), 1e-6)) / 127

    vectors = {k: unit(n, v) for k, (n, v) in contexts.items()}
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    for i, text in enumerate(texts):
        tokens = words(text)
        n = max(len(tokens), 1)
        places = [(False, name_of(w) >> (64 - quality.BUCKET_BITS)) for w in tokens]
        mean = sum((vectors[p] for p in places), np.zeros(48)) / n
        rare = sum(np.rint(3 * np.log2(uses / contexts[p][0])) for p in places) / 48 / n
        shape = sum((vectors[True, s] for s in plain_shapes(tokens)), np.zeros(48)) / n
        x = np.concatenate([mean, [rare], shape, [np.log1p(len(tokens))]])
        hidden = np.tanh((x - model.center) / model.spread @ model.layers["w"] + model.layers["b"])
        logit = hidden @ model.layers["v"] + model.layers["c"]
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-logit / model.temperature)), abs=1e-4)


def test_temperature_is_the_best_of_its_choices():
    from shelfcast.llm.quality import QualityModel

    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    y = (x[:, 0] + rng.normal(size=600) * 2 > 0).astype(float)
    calibrate = np.arange(600) % 3 == 0
    model = QualityModel.__new__(QualityModel)
    model.temperature = 1.0
    model.fit(x, y, calibrate)

    def loss(t):
        p = 1 / (1 + np.exp(-model.logits(x[calibrate]) / t))
        return -np.mean(y[calibrate] * np.log(p) + (1 - y[calibrate]) * np.log(1 - p))

    assert loss(model.temperature) == pytest.approx(min(loss(t) for t in np.geomspace(0.25, 8, 61)))


def test_pieces_come_back_whole():
    from shelfcast.llm.quality import DIMENSIONS, compressed, uncompressed

    rng = np.random.default_rng(5)
    for rows in (0, 1, 700):
        for most in (1, 100, 30_000, 1 << 30, 1 << 40):
            keys = np.sort(rng.integers(0, 1 << 64, rows, np.uint64, endpoint=False))
            n = rng.integers(1, 1 << 40, rows)
            sums = rng.integers(-most, most + 1, (rows, DIMENSIONS))
            for found, expected in zip(uncompressed(compressed(keys, n, sums)), (keys, n, sums), strict=True):
                assert (found == expected).all() and len(found) == rows


@pytest.mark.parametrize("chunk", [1, 3, 1 << 17])
def test_contexts_of_chunks_equal_those_of_whole_texts(monkeypatch, chunk):
    from shelfcast.llm import quality
    from shelfcast.llm.word_arrays import mix

    rng = np.random.default_rng(6)
    words, shapes = mix(rng.integers(0, 9, 50).astype(np.uint64)), rng.integers(0, 64, 50)
    owner = np.sort(rng.integers(0, 6, 50))
    expected = quality.context_sums(words, owner, shapes)
    monkeypatch.setattr(quality, "_CHUNK", chunk)
    parts = zip(*quality._context_chunks(words, owner, shapes), strict=True)
    for found, whole in zip((quality._merged(list(p)) for p in parts), expected, strict=True):
        assert all((a == b).all() for a, b in zip(found, whole, strict=True))


def traced(work):
    """The most bytes that numpy holds at a time while the work is done."""
    import tracemalloc

    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_sums_of_a_range_take_its_memory_once():
    import pyarrow as pa

    from shelfcast.llm import quality

    rng = np.random.default_rng(7)
    keys = np.arange(quality._RANGE, dtype=np.uint64) + np.uint64(quality._RANGE)
    sums = rng.integers(-90, 91, (len(keys), quality.DIMENSIONS))
    piece = quality.compressed(keys, np.full(len(keys), 3), sums)
    columns = [pa.array([False] * 6), pa.array([1] * 6), pa.array([piece] * 6, pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, ["shape", "part", "piece"])
    found = []
    assert traced(lambda: found.extend(quality._ranges(iter([batch, batch])))) < 32e6  # 88 MB before
    ((shape, got, n, total),) = found
    assert not shape and (got == keys).all() and (n == 36).all() and (total == 12 * sums).all()


def test_a_slice_of_text_takes_little_memory():
    import pyarrow as pa

    from shelfcast.llm import quality

    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(200_000)}" for _ in range(300)) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])

    def work():
        for _, _, _, document, words, shapes in quality._tokens(iter([batch])):
            for _ in quality._context_chunks(words, document, shapes):
                pass

    assert traced(work) < 90e6  # 191 MB before
