"""Best-fit packing against the tokenizer library and a packer that places one piece after the other."""

from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pytest

CAPACITY = 64


def vocabulary():
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def plain_best_fit(lengths, capacity):
    """Remaining capacities after each piece went to the sequence with the least room that holds it."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_equal_pieces_end_as_single_pieces_do(seed):
    from shelfcast.llm.packing import best_fit_runs

    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 64, 100])
    weights = [rng.random() ** 4 for _ in range(capacity)]
    lengths = rng.choices(range(1, capacity + 1), weights, k=rng.choice([1, 40, 900]))
    counts = collections.Counter(lengths)
    runs = best_fit_runs(counts, capacity)
    rooms, spans, placed = {}, collections.defaultdict(list), collections.Counter()
    for i, (length, rank, sequence, each, offset) in enumerate(runs.tolist()):
        following = runs[i + 1] if i + 1 < len(runs) else None
        end = int(following[1]) if following is not None and following[0] == length else counts[length]
        for k in range(end - rank):
            spans[sequence + k // each].append((offset + k % each * length, length))
            placed[length] += 1
    assert placed == counts
    for sequence, parts in spans.items():
        parts.sort()
        assert [a for a, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
        rooms[sequence] = capacity - sum(n for _, n in parts)
    assert sorted(rooms.values()) == plain_best_fit(lengths, capacity)


def texts_of_every_kind(rng):
    letters = ["a", "B", "é", "é", "ß", "Σ", "İ", "文", "ก", "9", "٣", "'", "'s", "'LL", "!", "…", "\U0001f600", "_"]
    blanks = [" ", "\n", "\t", "\x0b", "\x0c", "\r", "\xa0", " ", "　", "\x85", "\x1c", "́", "  "]
    letters += ["h\u0331", "H\u0331", "E\u0301", "=\u0338", "don't", "''s", ".'s", "1've", "'tis", "ABC", "x12y", "Z", "k", "#"]
    special = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "\x00", "​", "ͅ"]
    pool = letters * 4 + blanks * 3 + special
    for n in [0, 1, 2, 3, 5, 10, 30, 200, 900]:
        for _ in range(12):
            yield "".join(rng.choice(pool) for _ in range(n))


def expected_pieces(tokenizer, rows, capacity=CAPACITY):
    out = collections.Counter()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def check_packing(rows, capacity=CAPACITY):
    """Sequences are gapless; returns their fill."""
    spans = collections.defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
    for parts in spans.values():
        parts.sort()
        assert [a for a, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
    fill = [sum(n for _, n in parts) for parts in spans.values()]
    assert max(fill, default=0) <= capacity
    return fill


def test_pieces_are_the_librarys_and_packed_by_best_fit(documents, tokenizer):
    from shelfcast.llm.packing import pack_documents

    rng = random.Random(3)
    rows = list(enumerate(texts_of_every_kind(rng)))
    rows += [(None, None), (None, "null id"), (7, "same id"), (5000, None), (5001, "word " * 3000)]
    rows += [(6000, "a repeated row")] * 200 + [(6001 + i, "copies of one text") for i in range(300)]
    found = pack_documents(documents(rows).repartition(5), vocabulary(), CAPACITY).collect()
    expected = expected_pieces(tokenizer, rows)
    got = collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    assert got == expected
    fill = check_packing(found)
    lengths = [k[3] for k, n in expected.items() for _ in range(n)]
    assert sorted(CAPACITY - n for n in fill) == plain_best_fit(lengths, CAPACITY)


def test_packing_does_not_depend_on_the_layout(documents):
    from shelfcast.llm.packing import pack_documents

    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(90)))) for i in range(400)]
    one = pack_documents(documents(rows).repartition(1), vocabulary(), CAPACITY).collect()
    many = pack_documents(documents(rows).repartition(7), vocabulary(), CAPACITY).collect()
    assert sorted(one) == sorted(many)


def test_sequences_hold_the_ids_of_their_pieces(documents, tokenizer):
    from shelfcast.llm.packing import pack_documents, packed_sequences

    rows = [(i, f"document {i} " + "more words " * (i % 50)) for i in range(120)]
    found = {r.sequence_id: r.ids for r in packed_sequences(documents(rows), vocabulary(), CAPACITY).collect()}
    for r in pack_documents(documents(rows), vocabulary(), CAPACITY).collect():
        ids = [*tokenizer.encode(rows[r.doc_id][1], add_special_tokens=False).ids, 0]
        assert found[r.sequence_id][r.offset : r.offset + r.length] == ids[r.start : r.start + r.length]


def test_long_texts_and_a_full_word_table(tokenizer, monkeypatch):
    import pyarrow as pa

    from shelfcast.llm import packing, word_arrays

    monkeypatch.setattr(packing, "SLICE_BYTES", 50)
    monkeypatch.setattr(word_arrays, "SLICE_BYTES", 50)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 40)
    rng = random.Random(6)
    texts = [t for t in texts_of_every_kind(rng)] + ["x" * 400, "y " * 300, "z" * 120 + " " + "z" * 230, None]
    encoder, got = packing.WordIds(vocabulary()), {}
    for first, end, ids, offsets in encoder.of_texts(pa.array(texts, pa.string())):
        for i in range(first, end):
            got[i] = ids[offsets[i - first] : offsets[i - first + 1]].tolist()
    assert got == {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}


def test_an_empty_table_packs_to_nothing(documents):
    from shelfcast.llm.packing import pack_documents

    out = pack_documents(documents([]), vocabulary(), CAPACITY)
    assert out.collect() == []
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
