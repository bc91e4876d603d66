"""Words of whole Arrow batches as numpy arrays: spans, 64-bit hashes, shingles.

A word's hash is a polynomial over its bytes, taken from one running sum over the batch: no Python
object is made per word. Batches are cut into slices of bounded size, documents stay whole.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; a longer document is a slice of its own.
SLICE_BYTES = 1 << 21
#: ASCII white space: U+0020 and U+0009 to U+000D.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same task, which returns freed memory to the machine at its end: Spark keeps Python workers, and what they hold."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        getattr(ctypes.CDLL(None), "malloc_trim", int)(0)  # not every C library has it

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all (multiply and shift, twice)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def byte_values(fold_case: bool = True) -> np.ndarray:
    """A random odd number per byte value; with ``fold_case`` A-Z have those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
    if fold_case:
        values[65:91] = values[97:123]
    return values


def word_bytes(letters_only: bool = False) -> np.ndarray:
    """Which byte values belong to words: all but ASCII white space, or only letters, digits and non-ASCII."""
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    if letters_only:
        table[:128] = [chr(i).isalnum() for i in range(128)]
    return table


def text_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of slices; NULL is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


class WordHasher:
    """Spans and hashes of the words of a slice."""

    def __init__(self, letters_only: bool = False, fold_case: bool = True):
        self.is_word = word_bytes(letters_only)
        self.values = byte_values(fold_case)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers))
            for name, base in (("powers", _P), ("inverses", _P_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, document, hash) of every word; no word crosses documents."""
        n = len(data)
        inside = self.is_word[data]
        edge = np.zeros(n + 1, bool)
        edge[1:n] = inside[1:] != inside[:-1]
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


def shingles(documents: np.ndarray, words: np.ndarray, n_documents: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct runs of ``width`` words, sorted by both; the whole sequence where there are fewer."""
    counts = np.bincount(documents, minlength=n_documents)
    m = len(words)
    base = np.uint64(0xD6E8FEB86659FD93)
    owner, value = [], []
    if m >= width:
        run = np.zeros(m - width + 1, np.uint64)
        for j in range(width):
            run = run * base + words[j : m - width + 1 + j]
        whole = documents[: m - width + 1] == documents[width - 1 :]
        owner.append(documents[: m - width + 1][whole])
        value.append(mix(run[whole]))
    first = np.cumsum(counts) - counts
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        run = np.zeros(len(short), np.uint64)
        for j in range(n):
            run = run * base + words[first[short] + j]
        owner.append(short)
        value.append(mix(run + np.uint64(n)))
    owner, value = np.concatenate(owner), np.concatenate(value)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]
