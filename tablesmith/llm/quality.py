"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]):
every pair of features interacts through ``RANK`` factors, in time linear in
the features. The features of a text are its words (hashed to ``BUCKETS``, each
with its share of the text as value, scaled), statistics of its make-up
(repetition of words and lines, shares of character classes, word lengths) and
its metadata (the stored number of characters, on a log scale).

Defined results: a null or empty text has all-zero features and scores the
bias; a null character count is taken from the text; without training rows of
both labels every score is 0.5; a null id stays null; repeated rows repeat;
other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablesmith.functions.expressions import col
from tablesmith.llm.common import ByValue, as_bytes, slices, word_hashes

BUCKETS = 1 << 16
RANK = 8
EPOCHS, RATE, L2 = 15, 0.1, 1e-4
THRESHOLD = 0.5
#: Length that the word features of a text have together: words and statistics then weigh alike.
WORD_SCALE = 3.0
#: Bytes of text whose words are held at once.
HELD_BYTES = 2 << 20

_CLASSES = np.zeros((256, 6))
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b] = (65 <= _b <= 90, 97 <= _b <= 122, 48 <= _b <= 57, _b in (9, 10, 11, 12, 13, 32),
                    _b >= 128, 33 <= _b <= 126 and not _c.isalnum())
STATISTICS = 16


def statistics(text: bytes, words: list[bytes], hashes: np.ndarray, n_chars: int) -> list[float]:
    """Structure statistics of one text, each about 0 to 1, and its length on a log scale."""
    n = len(words)
    if not n:
        return [0.0] * STATISTICS
    histogram = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    shares = histogram @ _CLASSES / len(text)
    _, counts = np.unique(hashes, return_counts=True)
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    symbols = histogram[[33, 35, 36, 37, 38, 42, 124]] * (10.0 / n)      # ! # $ % & * |
    return [*shares.tolist(), len(counts) / n, counts.max() / n, float((hashes[1:] == hashes[:-1]).mean()) if n > 1 else 0.0,
            len(set(lines)) / len(lines), float(lengths.mean()) / 10, float(lengths.std()) / 5,
            min(1.0, float(symbols.sum())), min(1.0, float(symbols[0])), min(1.0, 20.0 * len(lines) / n),
            np.log1p(n_chars) / 12]


@dataclass
class Features:
    """Hashed words in CSR form (row starts, buckets, values) and a matrix of statistics."""

    starts: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    dense: np.ndarray


def features(texts: list[bytes | None], n_chars: list[int | None]) -> Features:
    starts, buckets, values, dense = [0], [], [], []
    for text, chars in zip(texts, n_chars):
        text = text or b""
        words = text.split()
        hashes = word_hashes(words)
        dense.append(statistics(text, words, hashes, len(text.decode("utf-8", "replace")) if chars is None else max(0, chars)))
        bucket, counts = np.unique((hashes % np.uint64(BUCKETS)).astype(np.int32), return_counts=True)
        buckets.append(bucket)
        values.append((counts * (WORD_SCALE / max(1.0, float(np.sqrt((counts.astype(np.float64) ** 2).sum()))))).astype(np.float32))
        starts.append(starts[-1] + len(bucket))
    return Features(np.array(starts), np.concatenate(buckets), np.concatenate(values), np.array(dense))


def _row_sums(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums over the CSR rows (empty rows: 0)."""
    total = np.concatenate((np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0, dtype=np.float64)))
    return total[starts[1:]] - total[starts[:-1]]


@dataclass
class Model(ByValue):
    bias: float
    linear: np.ndarray          # buckets, then statistics
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def scaled(self, dense: np.ndarray) -> np.ndarray:
        return np.where(dense.any(axis=1, keepdims=True), np.clip((dense - self.mean) / self.spread, -4, 4), 0.0)

    def parts(self, f: Features) -> tuple[np.ndarray, np.ndarray]:
        """(margin, sum of v_i x_i) per row: the pair terms by the sum-of-squares identity."""
        dense, v = self.scaled(f.dense), self.factors[f.bucket] * f.value[:, None]
        sums = _row_sums(v, f.starts) + dense @ self.factors[BUCKETS:]
        squares = _row_sums(v * v, f.starts) + (dense ** 2) @ (self.factors[BUCKETS:] ** 2)
        linear = _row_sums(self.linear[f.bucket] * f.value, f.starts) + dense @ self.linear[BUCKETS:]
        return self.bias + linear + 0.5 * (sums ** 2 - squares).sum(axis=1), sums

    def scores(self, texts: list[bytes | None], n_chars: list[int | None]) -> np.ndarray:
        out, begin = [], 0
        while begin < len(texts):
            end, held = begin, 0
            while end < len(texts) and (end == begin or held + len(texts[end] or b"") <= HELD_BYTES):
                held += len(texts[end] or b"")
                end += 1
            margin, _ = self.parts(features(texts[begin:end], n_chars[begin:end]))
            out.append(1 / (1 + np.exp(-np.clip(margin, -700, 700))))
            begin = end
        return np.concatenate(out) if out else np.empty(0)


def empty_model() -> Model:
    return Model(0.0, np.zeros(BUCKETS + STATISTICS), np.zeros((BUCKETS + STATISTICS, RANK)), np.zeros(STATISTICS),
                 np.ones(STATISTICS))


def train(rows: list[tuple], *, epochs: int = EPOCHS, rate: float = RATE, seed: int = 11, batch: int = 32) -> Model:
    """Adagrad on the log loss; both labels weigh alike in all. Rows: (text, label), or (text, label, stored character count)."""
    model, y = empty_model(), np.array([r[1] for r in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return model
    rng = np.random.default_rng(seed)
    f = features([r[0] for r in rows], [r[2] if len(r) > 2 else None for r in rows])
    model.mean, model.spread = f.dense.mean(axis=0), f.dense.std(axis=0) + 1e-3
    model.factors = rng.normal(0, 0.02, model.factors.shape)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    seen_w, seen_v, seen_b = np.full(len(model.linear), 1e-2), np.full(len(model.factors), 1e-2), 1e-2
    own = BUCKETS + np.arange(STATISTICS)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), batch):
            ids = order[a:a + batch]
            counts = f.starts[ids + 1] - f.starts[ids]
            at = np.repeat(f.starts[ids] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            part = Features(np.concatenate(([0], np.cumsum(counts))), f.bucket[at], f.value[at], f.dense[ids])
            margin, sums = model.parts(part)
            wrong = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y[ids]) * weight[ids] / len(ids)
            row = np.repeat(np.arange(len(ids)), counts)
            dense = model.scaled(part.dense)
            g_lin = wrong[row] * part.value
            g_fac = g_lin[:, None] * (sums[row] - model.factors[part.bucket] * part.value[:, None])
            unique, back = np.unique(part.bucket, return_inverse=True)
            g_lin = np.concatenate((np.bincount(back, weights=g_lin, minlength=len(unique)), wrong @ dense))
            fac_dense = dense.T @ (wrong[:, None] * sums) - (wrong @ dense ** 2)[:, None] * model.factors[own]
            g_fac = np.concatenate((np.stack([np.bincount(back, weights=g_fac[:, d], minlength=len(unique))
                                              for d in range(RANK)], axis=1), fac_dense))
            moved = np.concatenate((unique, own))
            g_lin += L2 * model.linear[moved]
            g_fac += L2 * model.factors[moved]
            seen_w[moved] += g_lin ** 2
            seen_v[moved] += (g_fac ** 2).mean(axis=1)
            seen_b += wrong.sum() ** 2
            model.linear[moved] -= rate * g_lin / np.sqrt(seen_w[moved])
            model.factors[moved] -= rate * 0.2 * g_fac / np.sqrt(seen_v[moved])[:, None]
            model.bias -= rate * wrong.sum() / np.sqrt(seen_b)
    return model


def score(docs: DataFrame, model: Model, *, length_col: str | None = "n_chars") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    has_length = length_col in docs.columns
    own = docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").cast("string").alias("text"),
                      *([col(length_col).cast("long").alias("n_chars")] if has_length else []))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chars = batch.column("n_chars").to_pylist() if has_length else [None] * batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.scores(as_bytes(batch), chars))],
                                             names=["doc_id", "score"])

    return own.mapInArrow(run, "doc_id long, score double")
