"""Secret scan: known formats, and a battery of randomness tests for strings of no known format.

*Known formats* are assignments to password-like names, access keys and long hexadecimal runs.
*The battery* takes runs of 16 or more characters that look encoded (mixed letters and digits, or both cases, but not
plain words with a leading capital), infers the encoding from the characters, and asks three questions of each, every
time with "this is ordinary text, not random" as the hypothesis to reject: Is the chi-squared distance from a uniform
alphabet as large as that of text? Are there as few runs of one character class? Do neighbouring characters alternate
between vowels and others as in words? The three p-values are
combined by Fisher's method. Benjamini and Hochberg's procedure over all strings of the corpus then limits the share
of false discoveries; it is length-aware in that a string's weight is its length, since long strings can be told apart.

One pass reads the texts and writes spans and p-values; the corpus-wide step is a histogram of bounded size.

Defined results: NULL and empty texts have no span; a span found by the battery that overlaps one of a known format
is left out; repeated rows are reported (and counted as strings) each; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.workspace import scratch_path, write_and_reopen

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")
#: Share of false discoveries among the strings that the battery reports.
DISCOVERY_RATE = 0.05
#: Characters of the strings the battery tests, at least.
LEAST = 16
#: Ordinary text: the chance that two of its characters are equal, the correlation of neighbours' places in the
#: alphabet (in sequences) and, negative, of their being vowels (in words), and the chance that neighbours are of
#: different classes (letters of a case, digits) in strings of one case and of both; a capital and the small letter
#: after it are no change.
COINCIDENCE, CORRELATION, ALTERNATION, CHANGES = 0.065, 0.35, 0.35, (0.1, 0.2)

_ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # of a run of such characters, the whole run
_STRING = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST)

#: Words as in sentences, also joined by signs: small letters, the first one a capital or not.
_WORDS = re.compile(r"[A-Z]?[a-z]*(?:[+/_-]+[A-Z]?[a-z]*)*")

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings by rank: the first one whose alphabet has all characters of a string is inferred.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("lower", _LOWER + _DIGITS),
    ("upper", _UPPER + _DIGITS),
    ("alnum", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
)
_ALPHABETS = [(name, {c: i for i, c in enumerate(alphabet)}) for name, alphabet in ENCODINGS]

#: A string that one test finds so typical of text has that test's p-value: an alphabet in order is uniform, too.
TYPICAL = 0.9

#: Bins of the histogram of p-values: powers of ten, and bins of each.
_POWERS, _FINE = 40, 20


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known formats, leftmost and not overlapping per kind, in code points."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def inferred_encoding(string: str) -> dict[str, int] | None:
    """Values of the characters in the inferred encoding; None for plain words, letters of one case and numbers."""
    used = set(string)
    kinds = (not used.isdisjoint(_LOWER), not used.isdisjoint(_UPPER), not used.isdisjoint(_DIGITS))
    if sum(kinds) < 2 or _WORDS.fullmatch(string):
        return None
    return next((values for _, values in _ALPHABETS if used <= values.keys()), None)


def _below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2


def uniformity(counts: Counter, n: int, k: int) -> float:
    """P-value of a chi-squared distance from uniform as small as this, for text (non-central chi-squared, as a normal)."""
    distance = k / n * sum(c * c for c in counts.values()) - n
    excess = n * (max(COINCIDENCE * k, 2.0) - 1)
    return _below((distance - (k - 1 + excess)) / math.sqrt(2 * (k - 1) + 4 * excess))


def class_runs(string: str) -> float:
    """P-value of as many changes of character class, for text: the tail of a binomial distribution.

    Signs between words are no class of their own: they are left out.
    """
    kinds = [_class(c) for c in string if c.isalnum()]
    n = len(kinds) - 1
    usual = CHANGES[{0, 1} <= set(kinds)]
    changes = sum(a != b and (a, b) != (1, 0) for a, b in zip(kinds, kinds[1:]))  # noqa: B905
    if changes <= n * usual:
        return 1.0
    if n > 400:  # a bound of the tail, exact enough where it is this small
        a = changes / n
        rate = a * math.log(a / usual) + ((1 - a) * math.log((1 - a) / (1 - usual)) if a < 1 else 0)
        return math.exp(-n * rate)
    term = math.comb(n, changes) * usual**changes * (1 - usual) ** (n - changes)
    total, i = 0.0, changes
    while term > total * 1e-12 and i <= n:
        total += term
        term *= (n - i) / (i + 1) * usual / (1 - usual)
        i += 1
    return min(1.0, total)


def _neighbours(values: list[int]) -> float:
    """Correlation of neighbours; 0 where all values but the first or the last are equal."""
    n = len(values) - 1
    a, b = values[:-1], values[1:]
    ma, mb = sum(a) / n, sum(b) / n
    sa = sum((x - ma) ** 2 for x in a)
    sb = sum((x - mb) ** 2 for x in b)
    if sa <= 0 or sb <= 0:
        return 0.0
    return sum((x - ma) * (y - mb) for x, y in zip(a, b, strict=True)) / math.sqrt(sa * sb)


def _typical(r: float, usual: float, n: int) -> float:
    """P-value of a correlation as small as this, for text (Fisher's transformation)."""
    r = max(min(r, 0.999999), -0.999999)
    return _below((math.atanh(r) - math.atanh(usual)) * math.sqrt(n - 3))


def serial_correlation(string: str, values: list[int]) -> tuple[float, float]:
    """P-values of neighbours that alternate between vowels and others as little, and of as little order, for text."""
    n = len(values) - 1
    vowels = [int(c in "aeiouyAEIOUY") for c in string]
    return _typical(-_neighbours(vowels), ALTERNATION, n), _typical(abs(_neighbours(values)), CORRELATION, n)


def battery(string: str) -> float | None:
    """Combined p-value of "ordinary text" for a string, or None where no encoding can be inferred."""
    body = string.rstrip("=")
    values = inferred_encoding(body)
    if values is None:
        return None
    alternation, order = serial_correlation(body, [values[c] for c in body])
    tests = (uniformity(Counter(body), len(body), len(values)), class_runs(body), alternation)
    half = -sum(math.log(max(p, 1e-300)) for p in tests)
    combined = math.exp(-half) * (1 + half + half * half / 2)
    return max([combined, *(p for p in (*tests, order) if p > TYPICAL)])


def tested_strings(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, float]]:
    """(start, end, p-value) of the strings that are tested and overlap no known span."""
    out = []
    for m in _STRING.finditer(text):
        p = battery(m[0])
        if p is not None and not any(s < m.end() and m.start() < e for s, _, e in known):
            out.append((m.start(), m.end(), p))
    return out


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType())])
_TESTED = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_TESTED_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, known spans and tested strings of every document: the one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                known, tested = [], []
                for text in part.column("text").to_pylist():
                    spans = known_spans(text or "")
                    known.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                    strings = tested_strings(text or "", spans)
                    tested.append([{"start": s, "end": e, "p": p} for s, e, p in strings])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(known, _SPAN_ARROW), pa.array(tested, _TESTED_ARROW)],
                    ["doc_id", "known", "tested"],
                )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("known", T.ArrayType(_SPAN)),
            T.StructField("tested", T.ArrayType(_TESTED)),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def discovery_threshold(found: DataFrame, rate: float = DISCOVERY_RATE) -> tuple[float, float]:
    """(largest weighted p-value that is a discovery, mean length): Benjamini and Hochberg over a histogram.

    A string's p-value is divided by its weight, its length over the mean length. The histogram rounds p-values
    up to its edges, which keeps the rate.
    """
    strings = found.select(F.explode("tested").alias("t")).select((F.expr("t.end - t.start")).alias("n"), "t.p")
    tests, mean = strings.agg(F.count("*"), F.coalesce(F.avg("n"), F.lit(1.0))).first()
    weighted = F.col("p") * F.lit(mean) / F.col("n")
    bin_ = F.floor(-F.log10(F.greatest(weighted, F.lit(10.0**-_POWERS))) * _FINE).cast("int")
    counts = strings.select(bin_.alias("bin")).filter("bin >= 0").groupBy("bin").count().collect()
    discoveries, threshold = 0, 0.0
    for row in sorted(counts, key=lambda r: -r["bin"]):
        discoveries += row["count"]
        edge = 10.0 ** (-row["bin"] / _FINE)
        if edge * tests <= rate * discoveries:
            threshold = edge
    return threshold, mean


def scan_secrets(docs: DataFrame, rate: float = DISCOVERY_RATE) -> DataFrame:
    """doc_id, known spans and all spans of every document, as arrays of (start, kind, end)."""
    found = write_and_reopen(scanned(docs), scratch_path(docs.sparkSession, "secrets"))
    threshold, mean = discovery_threshold(found, rate)
    chosen = F.filter("tested", lambda t: t["p"] * mean / (t["end"] - t["start"]) <= threshold)
    random = F.transform(
        chosen, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end"))
    )
    return found.select("doc_id", "known", F.array_sort(F.concat("known", random)).alias("spans"))


def listed(spans: str):
    """A column of spans as text: kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
    )
