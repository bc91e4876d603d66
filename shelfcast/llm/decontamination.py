"""Benchmark decontamination with spaced seeds.

A mask picks some of the words in a window and ignores the others. The words that a fixed set of masks
picks are hashed at every position of the benchmark texts and of the documents; equal hashes are hits. Around a
hit both texts are compared word by word, so that a passage is found although some words were replaced.

The benchmark is the small side: its hashes go to every task, in blocks of bounded size if it is large (each
block is one more pass over the documents). The documents are read in place: no shuffle, no text moves.

Words are runs of letters and digits after lower-casing, so case, punctuation and spacing don't matter. In scripts that
are written without blanks every character is a word. Benchmark texts of fewer than ``MATCHED`` words are found where all
their words follow each other, by the hash of the whole sequence.

Defined results: NULL and empty texts hold nothing; a benchmark text of fewer than ``SHORTEST`` words can't be
found, since it can't be told from chance; a NULL doc_id or item_id is reported as NULL; of several places of one item in a document the best is
reported, of equal ones the first; repeated rows are reported each; an empty table on either side finds nothing;
other columns are ignored, or kept where documents are filtered, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.word_arrays import WordHasher, mix, text_slices

#: Word positions that a seed compares: five words in windows of 5 to 11. Every stretch with ``MATCHED`` equal words
#: and a share of ``IDENTITY`` has a hit; the tests prove it by a search over all patterns.
MASKS = ("111011", "1100001011", "11010011", "101000111", "11000100101", "11111", "110111")
#: Equal words that an overlap needs, and their share in it, in whole tenths.
MATCHED, IDENTITY = 10, 0.7
_TENTHS = round(10 * IDENTITY)
#: Words of the shortest benchmark texts that are searched for; below ``MATCHED`` only whole.
SHORTEST = 5
#: Characters of scripts without blanks between words.
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
#: Benchmark text that is searched for in one pass, in bytes.
BLOCK_BYTES = 8 << 20

_FILTER_BITS = 22
_PAIRS = 1 << 20  # pairs of equal seeds that are looked at together


def folded(texts: pa.Array) -> pa.Array:
    """The texts in lower case, with blanks around the characters of ``UNSPACED``."""
    lowered = pc.utf8_lower(texts.cast(pa.large_string()))
    data = lowered.buffers()[2]
    if data is not None and (np.frombuffer(data, np.uint8) >= 0xE0).any():  # the first byte of any such character
        lowered = pc.replace_substring_regex(lowered, UNSPACED, r" \1 ")
    return lowered


class SeedIndex:
    """The hashes of a block of benchmark texts: sorted seeds with their places, and a small filter over them."""

    def __init__(self, texts: list[str | None]):
        hasher = WordHasher(letters_only=True)
        column = folded(pa.array(texts, pa.large_string()))
        words, items, first = [], [], 0
        for first, end, data, offsets in text_slices(column):
            _, _, document, hashes = hasher.words(data, offsets)
            words.append(hashes)
            items.append(document + first)
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        item = np.concatenate(items) if items else np.zeros(0, np.int64)
        counts = np.bincount(item, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
        self.first = np.append(0, np.cumsum(counts))
        keys, places = [], []
        for key, place in seeds(self.words, item):
            long = counts[item[place]] >= MATCHED
            keys.append(key[long])
            places.append(place[long])
        key, place = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(key, kind="stable")
        self.keys, self.places, self.items = key[order], place[order], item
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - _FILTER_BITS)] = True
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by length: sorted hashes and items
        for length in np.unique(counts[(counts >= SHORTEST) & (counts < MATCHED)]).tolist():
            key, place = windows(self.words, item, "1" * length, length)
            whole = counts[item[place]] == length
            order = np.argsort(key[whole], kind="stable")
            self.short[length] = key[whole][order], item[place][whole][order]

    def hits(self, words: np.ndarray, document: np.ndarray) -> np.ndarray:
        """Distinct (document, item, shift): a document's words lie ``shift`` after the item's, as rows."""
        items, span = max(len(self.first) - 1, 1), len(words) + len(self.words) + 1
        found = [np.zeros(0, np.int64)]  # one number for the three: below 2^60 for slices and blocks of bounded bytes
        for key, place in seeds(words, document):
            likely = self.filter[key >> np.uint64(64 - _FILTER_BITS)]
            key, place = key[likely], place[likely]
            low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
            ends = np.append(0, np.cumsum(high - low))
            first = 0
            while first < len(key):  # pairs of places a bounded number at a time: repeated words have many
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + _PAIRS, "right")) - 1)
                n = (high - low)[first:last]
                each = np.repeat(np.arange(first, last), n)
                at = self.places[low[each] + np.arange(len(each)) - np.repeat(ends[first:last] - ends[first], n)]
                pair = document[place[each]] * items + self.items[at]
                found.append(np.unique(pair * span + place[each] - at + len(self.words)))
                first = last
        pair, shift = np.divmod(np.unique(np.concatenate(found)), span)
        return np.stack([pair // items, pair % items, shift - len(self.words)], 1)


    def short_overlaps(self, words: np.ndarray, document: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        """(document, item, first word there, words, equal words) of short items: the first place in each document."""
        for length, (keys, items) in self.short.items():
            key, place = windows(words, document, "1" * length, length)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            found = np.flatnonzero(high > low)
            within = document[place[found]]
            order = np.lexsort((place[found], low[found], within))
            found, within = found[order], within[order]
            new = np.ones(len(found), bool)
            new[1:] = (low[found[1:]] != low[found[:-1]]) | (within[1:] != within[:-1])
            for i, d in zip(found[new].tolist(), within[new].tolist(), strict=True):
                yield from ((d, item, int(place[i] - first[d]), length, length) for item in items[low[i] : high[i]].tolist())


def windows(words: np.ndarray, owner: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the words that the mask keeps, first position) of every window that lies in one text."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, number, np.uint64)
    for at, kept in enumerate(mask):
        if kept == "1":
            total = total * np.uint64(0x9FB21C651E98DF25) + words[at : at + n]
    place = np.flatnonzero(owner[:n] == owner[len(mask) - 1 :])
    return mix(total[place]), place


def seeds(words: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, first position) of the windows, mask by mask."""
    for number, mask in enumerate(MASKS):
        yield windows(words, owner, mask, number + 1)


def best_overlap(equal: np.ndarray) -> tuple[int, int, int]:
    """(start, end, equal words) of the stretch with most equal words among those whose share of them is ``IDENTITY``.

    Such stretches have a sum of at least 0 when an equal word counts 3 and another one -7.
    The farthest end for a start is the last place whose running sum is not below the start's. Of stretches with as
    many equal words the shortest counts, of equally short ones the first.
    """
    run = np.append(0, np.cumsum(np.where(equal, 10 - _TENTHS, -_TENTHS)))
    same = np.append(0, np.cumsum(equal))
    reach = np.maximum.accumulate(run[::-1])[::-1]  # the largest sum from here on: falls with the place
    last = len(run) - 1 - np.searchsorted(reach[::-1], run, "left")
    most = same[last] - same
    count = int(most.max())
    starts = np.flatnonzero(most == count)
    ends = np.searchsorted(same, same[starts] + count, "left")  # without other words at the end
    at = int(np.argmin(ends - starts))
    return int(starts[at]), int(ends[at]), count


def overlaps(index: SeedIndex, words: np.ndarray, document: np.ndarray, n_documents: int) -> list[tuple]:
    """(document, item, first word there, words, equal words), the best of every pair that has enough."""
    first = np.append(0, np.cumsum(np.bincount(document, minlength=n_documents)))
    best: dict[tuple[int, int], tuple] = {}
    for d, item, shift in index.hits(words, document).tolist():
        low = max(index.first[item], first[d] - shift)
        high = min(index.first[item + 1], first[d + 1] - shift)
        equal = index.words[low:high] == words[low + shift : high + shift]
        start, end, same = best_overlap(equal)
        if same >= MATCHED:
            row = (d, item, int(low + start + shift - first[d]), end - start, same)
            if (d, item) not in best or (same, -row[2]) > (best[d, item][4], -best[d, item][2]):
                best[d, item] = row
    return sorted([*best.values(), *index.short_overlaps(words, document, first)])


def benchmark_blocks(benchmark: DataFrame) -> Iterator[tuple[pa.Array, list]]:
    """(item ids, texts) of blocks of the benchmark: one block up to ``BLOCK_BYTES``, measured, else by hash."""
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for i in range(blocks):
        rows = benchmark.filter(part == i).select("item_id", "text").toArrow()
        yield pa.concat_arrays(rows["item_id"].chunks or [pa.array([], rows["item_id"].type)]), rows["text"].to_pylist()


def _found(batches, index: SeedIndex):
    """(batch, first row, rows, overlaps) of slices."""
    hasher = WordHasher(letters_only=True)
    for batch in batches:
        for first, end, data, offsets in text_slices(folded(batch.column("text"))):
            _, _, document, words = hasher.words(data, offsets)
            yield batch, first, end - first, overlaps(index, words, document, end - first)


def contaminated_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first_word, n_words, n_equal and identity: the best overlap of each contaminated pair."""
    fields = [("doc_id", docs.schema["doc_id"].dataType), ("item_id", benchmark.schema["item_id"].dataType)]
    fields += [(c, T.LongType()) for c in ("first_word", "n_words", "n_equal")]
    schema = T.StructType([T.StructField(*f) for f in fields])
    result = None
    for ids, texts in benchmark_blocks(benchmark):

        def run(batches, index=SeedIndex(texts), ids=ids):
            for batch, first, _, rows in _found(batches, index):
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array([first + d for d in columns[0]])),
                            ids.take(pa.array(columns[1])),
                            *(pa.array(c, pa.int64()) for c in columns[2:]),
                        ],
                        [f[0] for f in fields],
                    )

        found = docs.select("doc_id", "text").mapInArrow(run, schema)
        result = found if result is None else result.unionByName(found)
    return result.withColumn("identity", F.col("n_equal") / F.col("n_words"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns; no shuffle."""
    for _, texts in benchmark_blocks(benchmark):

        def run(batches, index=SeedIndex(texts)):
            for batch, first, n, rows in _found(batches, index):
                clean = np.ones(n, bool)
                clean[[r[0] for r in rows]] = False
                yield batch.slice(first, n).filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
