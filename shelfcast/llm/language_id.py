"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in both directions, labels every position with a distribution over
the languages, and pools them: a document's probabilities are the normalised mean of the positions' logarithms,
weighted by ``POOL`` so that long texts don't saturate. It is trained in numpy by backpropagation through time
on windows cut from a bounded sample of labelled documents, at any place of their texts.

Texts are cut into windows of ``WINDOW`` bytes, and the state starts anew at each; every byte of every text is
read. Equal windows of a batch of texts are read once.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; repeated rows get equal results;
without any labelled row every document is ``und``; an empty table gives an empty result; only doc_id and text of
the scored documents are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.holdout import bounded_sample, held_out
from shelfcast.llm.word_arrays import text_slices

#: Labelled documents that are learned from, for each language at most, and windows cut from each.
SAMPLE_ROWS, SAMPLE_WINDOWS = 700, 4
#: Bytes of a window, and units of the state in each direction.
WINDOW, UNITS = 96, 8
#: Training: passes over the windows, windows of a step, step size.
PASSES, STEP_WINDOWS, RATE = 5, 64, 0.02
#: The pooled logarithm is this many positions' worth at most; what a text without evidence gets.
POOL = 8.0
UNDETERMINED = "und"

_AT_A_TIME = 2048
_PAD = 0  # NUL reads as the absence of a byte


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1.0
    x *= 0.5
    return x


class ByteGru:
    """Weights of both directions, stacked: input rows per byte value, state matrices, output."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        h, k = UNITS, len(languages)
        self.languages = languages
        self.weights = {
            "input": rng.normal(0, 0.3, (2, 256, 3 * h)).astype(np.float32),
            "state": rng.normal(0, 0.3, (2, h, 3 * h)).astype(np.float32),
            "out": rng.normal(0, 0.3, (2, h, k)).astype(np.float32),
            "bias": np.zeros(k, np.float32),
        }

    def states(self, windows: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (direction, position, window, unit) of windows given as bytes (position, window)."""
        h, w = UNITS, self.weights
        steps, n = windows.shape
        out = np.empty((2, steps, n, h), np.float32)
        for d in (0, 1):
            state = np.zeros((n, h), np.float32)
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x = w["input"][d][windows[t]]
                u = state @ w["state"][d]
                gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
                new = np.tanh(x[:, 2 * h :] + gates[:, h:] * u[:, 2 * h :])
                if trace is not None:
                    trace.append((d, t, state, gates, new, u[:, 2 * h :]))
                state = state + gates[:, :h] * (new - state)
                state *= (windows[t] != _PAD)[:, None]  # padding keeps no state
                out[d, t] = state
        return out

    def log_probabilities(self, states: np.ndarray) -> np.ndarray:
        """(position, window, language)."""
        logits = states[0] @ self.weights["out"][0] + states[1] @ self.weights["out"][1] + self.weights["bias"]
        logits -= logits.max(-1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(-1, keepdims=True))
        return logits

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the positions, and its gradients by backpropagation through time."""
        h, w = UNITS, self.weights
        trace: list = []
        states = self.states(windows, trace)
        logs = self.log_probabilities(states)
        real = windows != _PAD
        count = max(1, int(real.sum()))
        loss = -float((np.take_along_axis(logs, labels[None, :, None], 2)[..., 0] * real).sum()) / count
        error = np.exp(logs)
        error[:, np.arange(windows.shape[1]), labels] -= 1
        error *= real[..., None] / count
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        grads["bias"] = error.sum((0, 1))
        back = np.zeros((2, windows.shape[1], h), np.float32)
        for d in (0, 1):
            grads["out"][d] = np.tensordot(states[d], error, ((0, 1), (0, 1)))
        for d, t, before, gates, new, u in reversed(trace):
            kept = real[t][:, None]
            g = (back[d] + error[t] @ w["out"][d].T) * kept
            z, r = gates[:, :h], gates[:, h:]
            new_error = g * z * (1 - new * new)
            z_error = g * (new - before) * z * (1 - z)
            r_error = new_error * u * r * (1 - r)
            inputs = np.concatenate([z_error, r_error, new_error], 1)
            inner = np.concatenate([z_error, r_error, new_error * r], 1)
            np.add.at(grads["input"][d], windows[t], inputs)
            grads["state"][d] += before.T @ inner
            back[d] = g * (1 - z) + inner @ w["state"][d].T
        return loss, grads


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> ByteGru:
    """Fits by Adam on windows (window, position); languages weigh alike by how the sample was drawn."""
    model = ByteGru(languages, seed)
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}
    steps_in_all = max(1, PASSES * -(-len(windows) // STEP_WINDOWS))
    step = 0
    for _ in range(PASSES):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), STEP_WINDOWS):
            chosen = order[at : at + STEP_WINDOWS]
            _, grads = model.gradients(windows[chosen].T.copy(), labels[chosen])
            step += 1
            rate = RATE * (1 - step / (steps_in_all + 1))
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model.weights[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows as rows of bytes, text of each) of texts laid end to end; the last one of a text is padded."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = offsets[owner] + nth * WINDOW
    place = at[:, None] + np.arange(WINDOW)
    inside = place < offsets[owner + 1][:, None]
    padded = np.append(data, np.uint8(_PAD))
    return padded[np.where(inside, place, len(data))], owner


def pooled(model: ByteGru, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probabilities (text, language) from all positions of all windows."""
    n, k = len(offsets) - 1, len(model.languages)
    sums, positions = np.zeros((n, k)), np.zeros(n)
    windows, owner = cut_windows(data, offsets)
    for at in range(0, len(windows), _AT_A_TIME):
        part = windows[at : at + _AT_A_TIME]
        block = np.ascontiguousarray(part.T)
        logs = model.log_probabilities(model.states(block))
        real = block != _PAD
        np.add.at(sums, owner[at : at + _AT_A_TIME], (logs * real[..., None]).sum(0))
        np.add.at(positions, owner[at : at + _AT_A_TIME], real.sum(0))
    mean = sums / np.maximum(positions, 1)[:, None] * np.minimum(positions, POOL)[:, None]
    mean = np.exp(mean - mean.max(1, keepdims=True))
    return mean / mean.sum(1, keepdims=True)


def training_windows(rows: pa.Table, seed: int = 7) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows cut at random places of the sample's texts, their labels, and the languages in order."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(rows["lang"].to_pylist()))
    number = {name: i for i, name in enumerate(languages)}
    windows, labels = [], []
    for text, lang in sorted(zip(rows["text"].to_pylist(), rows["lang"].to_pylist(), strict=True)):
        data = np.frombuffer(text.encode(), np.uint8)
        for _ in range(SAMPLE_WINDOWS):
            size = int(rng.choice([WINDOW, WINDOW, WINDOW // 4]))  # short texts are met as well
            start = int(rng.integers(0, max(1, len(data) - size + 1)))
            part = data[start : start + size]
            windows.append(np.pad(part, (0, WINDOW - len(part)), constant_values=_PAD))
            labels.append(number[lang])
    return np.array(windows, np.uint8).reshape(-1, WINDOW), np.array(labels, np.int64), languages


def fit_language_model(docs: DataFrame) -> ByteGru | None:
    """Learns from a bounded sample of documents with a language and a text, outside the held-out fold."""
    usable = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id"))
    )
    rows = bounded_sample(usable, "lang", SAMPLE_ROWS).select("text", "lang")
    return train_rows(rows)


def train_rows(rows: DataFrame) -> ByteGru | None:
    """Trains on whole sample windows; the sample's windows are cut where the rows are."""

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = pa.Table.from_batches([batch.slice(at, 256)])
                windows, labels, languages = training_windows(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w.tobytes() for w in windows], pa.binary()),
                        pa.array([languages[i] for i in labels], pa.string()),
                    ],
                    ["bytes", "lang"],
                )

    found = rows.mapInArrow(cut, "bytes binary, lang string").toArrow()
    if found.num_rows == 0:
        return None
    pairs = sorted(zip(found["bytes"].to_pylist(), found["lang"].to_pylist(), strict=True))
    languages = sorted({lang for _, lang in pairs})
    windows = np.frombuffer(b"".join(b for b, _ in pairs), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([languages.index(lang) for _, lang in pairs]), languages)


def predict_languages(docs: DataFrame, model: ByteGru | None) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                texts = batch.column("text").slice(first, end - first).fill_null("")
                letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                if model is None:
                    names, score = [UNDETERMINED] * (end - first), np.zeros(end - first)
                else:
                    p = pooled(model, data, offsets)
                    score = np.where(letters, p.max(1), 0.0)
                    names = [model.languages[i] if ok else UNDETERMINED for i, ok in zip(p.argmax(1), letters)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first), pa.array(names, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"],
                )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)
