"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 5 bytes, word ends marked), so
misspelt and inflected forms that were never seen share most of their vectors
with the forms that were. The n-gram vectors of a passage of ``PASSAGE`` words
are averaged (per word, then over the passage, in which a repeated word counts
once and a short one is filled up with zeros) and a linear softmax over the
average gives the passage's probability. A document goes by its two most toxic
passages: insults in a long text are not averaged away, and one unlucky word is
not enough. Embeddings and softmax are trained together, on the two passages of
each training document that score highest at the time (whatever its label) and
on random passages of documents with label 0.

At scoring the softmax is folded into one number per n-gram bucket, so a text
costs a few array operations per byte; texts are scored whole.

Defined results: null and empty texts, and texts without a word, score the
bias alone, which no passage evidence supports: 0; without training rows of
both labels every score is 0; a null id stays null; repeated rows repeat;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablesmith.llm.common import ALNUM_TABLE, ByValue, as_bytes, id_text, mix, slices

SIZES = (3, 4, 5)
BUCKETS = 1 << 18
DIM = 8
PASSAGE = 4
RATE = 14.0
#: Rounds: enough to pass TRAIN_BYTES in all, between the two bounds; in the first quarter no passage is singled out.
TRAIN_BYTES, LEAST_ROUNDS, MOST_ROUNDS = 120 << 20, 12, 60
THRESHOLD = 0.7
#: Bytes of text whose n-grams are held at once.
HELD_BYTES = 1 << 19


@dataclass(frozen=True)
class Grams:
    """The n-grams of some texts: bucket and word of each; per word its text, passage, and whether it counts there."""

    bucket: np.ndarray
    word: np.ndarray
    text: np.ndarray
    passage: np.ndarray
    counts: np.ndarray


def grams(texts: list[bytes | None]) -> Grams:
    """All n-grams of the words of ``texts``; a space before and after a word marks its ends."""
    parts = [b" " + (t or b"").translate(ALNUM_TABLE) + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    letter = data != 32
    first = letter & ~np.concatenate(([False], letter[:-1]))
    number = np.cumsum(first, dtype=np.int32) - 1
    text = np.searchsorted(ends, np.flatnonzero(first), side="right")
    wide = data.astype(np.uint32)
    code, inner = wide, None
    buckets, words = [], []
    for n in range(2, max(SIZES) + 1):
        code = code[:-1] * np.uint32(0x01000193) ^ wide[n - 1:]
        inner = letter[1:len(code) + 1] if n == 3 else None if n == 2 else inner[:len(code)] & letter[n - 2:n - 2 + len(code)]
        if n in SIZES:
            at = np.flatnonzero(inner)
            h = (code[at] + np.uint32(n)) * np.uint32(0x85EBCA6B)
            buckets.append((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1))
            words.append(number[at + 1])
        if n == 3:
            key = np.add.reduceat(mix(code[at].astype(np.uint64)), np.flatnonzero(np.diff(words[0], prepend=-1))) if len(at) \
                else np.empty(0, np.uint64)
    passage = _passages(text)
    counts = np.zeros(len(text), dtype=bool)    # a word counts once in a passage
    counts[np.unique(key ^ mix(passage.astype(np.uint64) + np.uint64(1)), return_index=True)[1]] = True
    return Grams(np.concatenate(buckets), np.concatenate(words), text, passage, counts)


def _passages(text_of_word: np.ndarray) -> np.ndarray:
    """A passage number per word: runs of PASSAGE words, begun anew in each text."""
    if not len(text_of_word):
        return np.empty(0, np.int64)
    new = np.flatnonzero(np.diff(text_of_word, prepend=-1))
    in_text = np.arange(len(text_of_word)) - np.repeat(new, np.diff(np.append(new, len(text_of_word))))
    return np.cumsum(in_text % PASSAGE == 0) - 1


def passage_margins(g: Grams, folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, margin) of every passage: the mean n-gram value of each distinct word, summed, over PASSAGE words."""
    n = len(g.text)
    if not n:
        return np.empty(0, np.int64), np.empty(0)
    per_word = np.bincount(g.word, weights=folded[g.bucket], minlength=n) / np.bincount(g.word, minlength=n)
    starts = np.flatnonzero(np.diff(g.passage, prepend=-1))
    return g.text[starts], np.bincount(g.passage, weights=per_word * g.counts) / PASSAGE


@dataclass(frozen=True)
class Model(ByValue):
    folded: np.ndarray     # the softmax's margin for label 1, per n-gram bucket
    bias: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        best = np.full((len(texts), 2), -np.inf)
        begin = 0
        while begin < len(texts):
            end, held = begin, 0
            while end < len(texts) and (end == begin or held + len(texts[end] or b"") <= HELD_BYTES):
                held += len(texts[end] or b"")
                end += 1
            for part in _cut(texts[begin]) if end == begin + 1 else (texts[begin:end],):
                own = two_best(*passage_margins(grams(part), self.folded), end - begin)
                best[begin:end] = np.sort(np.concatenate((best[begin:end], own), axis=1), axis=1)[:, -2:]
            begin = end
        return np.where(np.isneginf(best[:, 1]), 0.0, 1 / (1 + np.exp(-np.clip(document_margin(best) + self.bias, -700, 700))))


def two_best(text: np.ndarray, margin: np.ndarray, n: int) -> np.ndarray:
    """Per text its second best and best passage margin (-inf where there is none)."""
    out = np.full((n, 2), -np.inf)
    order = np.lexsort((margin, text))
    text, margin = text[order], margin[order]
    last = np.flatnonzero(np.diff(text, append=-1))
    out[text[last], 1] = margin[last]
    second = last[(last > 0)]
    second = second[text[second - 1] == text[second]]
    out[text[second], 0] = margin[second - 1]
    return out


def document_margin(best: np.ndarray) -> np.ndarray:
    """Mean of the two best passages; a text of one passage goes by that one."""
    return np.where(np.isneginf(best[:, 0]), best[:, 1], best.mean(axis=1))


def _cut(text: bytes | None) -> Iterator[list[bytes | None]]:
    """A very long text in pieces of about HELD_BYTES, cut where a passage begins: all of it is scored, in the passages of the whole."""
    text = text or b""
    if len(text) <= HELD_BYTES:
        yield [text]
        return
    letter = np.frombuffer(text.translate(ALNUM_TABLE), dtype=np.uint8) != 32
    begins = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    begins = (np.concatenate(([0], begins)) if letter[0] else begins)[::PASSAGE]
    at, k = 0, 0
    while k < len(begins):
        k = max(k + 1, int(np.searchsorted(begins, at + HELD_BYTES, side="right")) - 1)     # one passage at least
        end = int(begins[k]) if k < len(begins) else len(text)
        if k == len(begins) - 1 and len(text) - at <= HELD_BYTES:
            end, k = len(text), len(begins)
        yield [text[at:end]]
        at = end


NOTHING = Model(np.zeros(BUCKETS, np.float32), -np.inf)


def train(rows: list[tuple[bytes, int]], *, rate: float = RATE, seed: int = 7) -> Model:
    """Fit embeddings and softmax jointly on labelled texts (at most what the sample's bounds let through).

    Plain gradient steps: an n-gram that many toxic passages share moves far,
    one that a single passage holds hardly moves, so passages are not learnt by heart.
    """
    label = np.array([y for _, y in rows], dtype=np.int64)
    if not len(label) or label.min() == label.max():
        return NOTHING
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1e-3, 1e-3, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = rng.normal(0, 1 / np.sqrt(DIM), (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    blocks, held = [[]], 0
    for i, (text, _) in enumerate(rows):
        if held > HELD_BYTES:
            blocks, held = [*blocks, []], 0
        blocks[-1].append(i)
        held += len(text)
    rounds = int(np.clip(TRAIN_BYTES // max(1, sum(len(t) for t, _ in rows)), LEAST_ROUNDS, MOST_ROUNDS))
    for k in range(rounds):
        folded = vectors @ (weights[:, 1] - weights[:, 0])
        for block in [blocks[i] for i in rng.permutation(len(blocks))]:
            g = grams([rows[i][0] for i in block])
            if not len(g.text):
                continue
            text, margin = passage_margins(g, folded)
            y = label[np.array(block)[text]]
            by = np.lexsort((margin, text))
            last = np.flatnonzero(np.diff(text[by], append=-1))
            before = last[last > 0]
            top = by[np.concatenate((last, before[text[by[before - 1]] == text[by[before]]] - 1))]
            if 4 * k < rounds:         # no passage is known to be the toxic one yet
                top = np.flatnonzero(y == 1)
            free = np.flatnonzero(y == 0)
            some = rng.choice(free, min(len(free), max(len(top), 32)), replace=False)
            chosen = np.unique(np.concatenate((top, some)))
            _learn(g, chosen, y[chosen], vectors, weights, bias, rate * (1 - k / rounds), rng)
    return Model((vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _learn(g: Grams, chosen, y, vectors, weights, bias, rate: float, rng, batch: int = 32) -> None:
    """Gradient steps over the chosen passages, both labels with the same weight in all."""
    passage = g.passage
    slot = np.full(int(passage[-1]) + 1, -1)
    slot[chosen] = rng.permutation(len(chosen))
    label = np.empty(len(chosen), np.int64)
    label[slot[chosen]] = y
    balance = np.array([0.5 / max(1, (y == c).sum()) for c in (0, 1)]) * len(y)
    own = slot[passage[g.word]]
    keep = np.flatnonzero(own >= 0)
    keep = keep[np.argsort(own[keep], kind="stable")]
    in_word = np.bincount(g.word, minlength=len(g.text))
    share = (g.counts[g.word[keep]] / (in_word[g.word[keep]] * PASSAGE)).astype(np.float32)
    own, bucket = own[keep], g.bucket[keep]
    cuts = np.searchsorted(own, np.arange(0, len(chosen) + batch, batch))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a == b:
            continue
        row = own[a:b] - own[a] // batch * batch
        x, w = bucket[a:b], share[a:b, None]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        mine = label[own[a:b][starts]]
        mean = np.add.reduceat(vectors[x] * w, starts)
        logits = mean @ weights + bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        wrong = ((e / e.sum(axis=1, keepdims=True) - np.eye(2)[mine]) * balance[mine][:, None]).astype(np.float32)
        step = np.repeat(wrong @ weights.T, np.diff(np.append(starts, len(x))), axis=0) * w
        weights -= 0.02 * mean.T @ wrong / len(mine)
        bias -= 0.2 * wrong.mean(axis=0)
        at = (x.astype(np.int64)[:, None] * DIM + np.arange(DIM)).ravel()
        np.subtract.at(vectors.reshape(-1), at, (rate * step).ravel())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.scores(as_bytes(batch)))],
                                             names=["doc_id", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores under ``threshold``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array(shared.value.scores(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)
