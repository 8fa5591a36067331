"""Language identification by rank-order profiles (out-of-place distance).

A profile lists a language's ``TOP`` most frequent character n-grams (1 to 3
characters of lower-cased words, ``_`` at word ends) in order. The n-grams are
counted over all training rows: each task counts its own rows, the counts are
summed by key, and two levels of top-k (salted, then per language) leave
``TOP`` rows per language, which is all that reaches the driver. A document's
own most frequent n-grams are then ranked the same way and compared to each
profile: every n-gram costs the difference of its two ranks, or ``TOP`` when
the profile lacks it. The nearest profile wins.

Defined results: null texts and texts without a letter are ``und`` with score
0; rows with a null language teach nothing; ties go to the language that sorts
first; without training rows everything is ``und``; repeated rows count as
often as they occur; extra columns are ignored. Whole texts are counted, long
ones in pieces.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablesmith.functions.expressions import col
from tablesmith.llm.common import id_text, slices

TOP = 400
SIZES = (1, 2, 3)
UNDETERMINED = "und"
#: Characters of a text counted at once, and distinct n-grams a task holds before it passes its counts on.
PIECE, HELD = 1 << 19, 1 << 20
#: Runs of letters, in texts without SIGNS: these (superscripts, fractions, Roman numerals) are word characters of a pattern,
#: but no letters (``str.isalpha``).
LETTERS = re.compile(r"[^\W\d_]+")
SIGNS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isdecimal() and not c.isalpha())
_BLANK = {ord(c): " " for c in SIGNS}
#: A quick look: the signs of Latin-1, and all characters from the first sign beyond it.
_MAYBE = re.compile(f"[{''.join(c for c in SIGNS if c < chr(256))}{min(c for c in SIGNS if c > chr(255))}-{chr(sys.maxunicode)}]")


def without_signs(text: str) -> str:
    return text.translate(_BLANK) if _MAYBE.search(text) and not SIGNS.isdisjoint(text) else text


def _codes(text: str) -> np.ndarray:
    """Every n-gram of the text's words as a number: its code points, 21 bits each."""
    padded = "_" + "_".join(LETTERS.findall(text.lower())) + "_"
    points = np.frombuffer(padded.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    gap = points == 95
    out = [points[~gap]]
    code = points
    for n in SIZES[1:]:
        code = (code[:-1] << np.uint64(21)) | points[n - 1:]
        # An n-gram may begin or end with a gap, not hold one inside.
        inner = np.zeros(len(code), dtype=bool)
        for j in range(1, n - 1):
            inner |= gap[j:j + len(code)]
        out.append(code[~inner])
    return np.concatenate(out)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts."""
    text, found, at = without_signs(text), [], 0
    while at < len(text) or not found:
        end = at + PIECE
        inside = LETTERS.match(text, end) if end < len(text) else None      # a word is not cut
        end = inside.end() if inside else end
        found.append(np.unique(_codes(text[at:end]), return_counts=True))
        at = end
    return found[0] if len(found) == 1 else summed(*map(np.concatenate, zip(*found)))


def summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, back = np.unique(grams, return_inverse=True)
    return unique, np.bincount(back, weights=counts, minlength=len(unique)).astype(np.int64)


def most_frequent(grams: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The ``top`` most frequent n-grams in order (ties: the smaller code first)."""
    if len(grams) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        keep = counts >= least
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))[:top]]


def profiles(training: DataFrame, *, lang_col: str = "lang", text_col: str = "text", top: int = TOP) -> dict[str, np.ndarray]:
    """Language -> its most frequent n-grams in order, counted over all rows of ``training``."""
    rows = training.select(col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text")).na.drop()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out():
            for lang, (grams, counts) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)),
                                                  pa.array(counts, pa.int64())], names=["lang", "gram", "n"])
            held.clear()

        for batch in slices(batches):
            texts: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                texts.setdefault(lang, []).append(ngram_counts(text))
            for lang, found in texts.items():
                own = [*found, *([held[lang]] if lang in held else [])]
                held[lang] = summed(np.concatenate([x for x, _ in own]), np.concatenate([x for _, x in own]))
            if sum(len(g) for g, _ in held.values()) > HELD:
                yield from out()
        yield from out()

    counted = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = [F.col("n").desc(), F.col("gram")]
    counted = counted.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(64)))
    for keys in (["lang", "salt"], ["lang"]):
        counted = counted.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(*best))) \
            .filter(F.col("place") <= top)
    found: dict[str, list] = {}
    for r in counted.select("lang", "place", "gram").collect():
        found.setdefault(r["lang"], []).append((r["place"], r["gram"]))
    return {lang: np.array([g for _, g in sorted(v)], dtype=np.int64).astype(np.uint64) for lang, v in sorted(found.items())}


def predict(docs: DataFrame, known: dict[str, np.ndarray], *, top: int = TOP) -> DataFrame:
    """doc_id, lang_pred, score: one minus the mean out-of-place distance to the nearest profile."""
    langs = list(known)
    grams = np.unique(np.concatenate(list(known.values()))) if known else np.empty(0, np.uint64)
    places = np.full((len(langs), len(grams)), -1, dtype=np.int64)
    for i, lang in enumerate(langs):
        places[i, np.searchsorted(grams, known[lang])] = np.arange(len(known[lang]))
    shared = docs.sparkSession.sparkContext.broadcast((grams, places))

    def nearest(text: str | None) -> tuple[str, float]:
        grams, places = shared.value
        if not text or not len(grams) or not LETTERS.search(without_signs(text)):
            return UNDETERMINED, 0.0
        own = most_frequent(*ngram_counts(text), top)
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        there = places[:, at]
        missing = (grams[at] != own) | (there < 0)
        distance = np.where(missing, top, np.abs(there - np.arange(len(own)))).sum(axis=1)
        best = int(distance.argmin())
        return langs[best], 1.0 - float(distance[best]) / (top * len(own))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, score = zip(*map(nearest, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
