"""Hard-negative mining: segment summaries bound scores, segments are refined, the rest is scored exactly.

A vector is cut into segments. Of a segment of n components a row stores
sqrt(n) times its mean, and its deviation (the length of what is left when the
mean is taken off). By the Cauchy-Schwarz inequality the inner product of two
segments is the product of their means plus or minus the product of their
deviations. Summed over segments this bounds a score from both sides; few long
segments are tried first, more and shorter ones only for the rows left, and the
exact product only for those left after that.

An anchor's positives are its highest rows of the same label; its negatives are,
for each positive, the highest rows of another label whose score lies in a
window below the positive's.

Distribution: blocks of at most ``ROWS`` rows with their summaries are written
once; blocks of anchors meet every block of rows, each pair of blocks being one
unit of bounded size, dealt over groups of row blocks and shares of anchors. A
task goes from block to block with what its anchors have found, so that limits
rise, and the first k of each group are merged. Nothing grows with the table
but the number of units.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part. A vector of another length than the
anchor's is neither positive nor negative of it. Of different rows under one
anchor id the first by label and vector is the anchor; rows that agree in id and
score count once, and never a row under the anchor's own id. Equal scores go to
the smaller id. Scores and components beyond a long's range: see ``vectors``.
Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import give_back, runs, saved, saved_measured
from tablesmith.llm.vectors import LONG, chunks, exact_in, gathered, grid, highest, packed, paired, products, small, unpacked, vector_rows

ROWS, ANCHORS = 4096, 2048
#: Segments at the levels of refinement.
LEVELS = (4, 16)
POSITIVES, NEGATIVES = 5, 10
#: A negative's score as percents of its positive's.
LOW, HIGH = 30, 90


def summaries(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Per row the scaled means, then the deviations, of ``segments`` runs of components."""
    runs = [r for r in np.array_split(np.arange(matrix.shape[1]), segments) if len(r)]
    means = [matrix[:, r].mean(axis=1) for r in runs]
    return np.stack([m * np.sqrt(len(r)) for m, r in zip(means, runs)]
                    + [np.linalg.norm(matrix[:, r] - m[:, None], axis=1) for m, r in zip(means, runs)], axis=1) \
        if runs else np.zeros((len(matrix), 0))


def bounds(own: np.ndarray, others: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest scores that the summaries of some rows allow with each of ``others``."""
    n = own.shape[1] // 2
    middle, spread = own[:, :n] @ others[:, :n].T, own[:, n:] @ others[:, n:].T
    spread += slack
    high = middle + spread
    return np.subtract(middle, spread, out=middle), high


def _levels(matrix: np.ndarray) -> dict[str, np.ndarray]:
    norm = np.linalg.norm(matrix, axis=1)
    kind = np.float32 if norm.max(initial=0) < SINGLE else np.float64
    return {f"level{i}": summaries(matrix, n).astype(kind) for i, n in enumerate(LEVELS)} | {"norm": norm}


def _kth(values: np.ndarray, k: int, least) -> np.ndarray:
    """Each row's k-th highest value (``least`` where there are fewer)."""
    n = values.shape[1]
    return np.partition(values, n - k, axis=1)[:, n - k] if n >= k else np.full(len(values), least)


def windows(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and largest negative score: low * positive <= 100 * negative <= high * positive."""
    return -((-low * positive) // 100), high * positive // 100


#: Lengths below which summaries are kept in single precision; rounding of the bounds, as a share of the product of two
#: lengths, in single and in double precision. Anchors that are taken through the levels together.
SINGLE, SLACK, TOGETHER = 2.0 ** 40, {np.dtype(np.float32): 1e-5, np.dtype(np.float64): 1e-9}, 64


def _limits(values: np.ndarray) -> np.ndarray:
    """As float64; the ends of a long's range, where scores are cut off, stand for all beyond."""
    return np.where(values == LONG[0], -np.inf, np.where(values == LONG[1], np.inf, values.astype(np.float64)))


class Best(NamedTuple):
    """What windows of scores have found, a row of k for each window: by score, then smaller id; how many there are."""

    scores: np.ndarray
    ids: np.ndarray
    n: np.ndarray

    @classmethod
    def none(cls, windows: int, k: int) -> Best:
        return cls(np.full((windows, k), LONG[0]), np.full((windows, k), LONG[1]), np.zeros(windows, dtype=np.int64))

    def of(self, cut: slice) -> Best:
        return Best(*(x[cut] for x in self))

    def add(self, window: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Puts found rows into their windows; rows that agree in id and score count once."""
        k = self.scores.shape[1]
        old = np.unique(window)
        held = runs(self.n[old])
        own = np.repeat(old, self.n[old])
        window, scores, ids = (np.concatenate(x) for x in ((window, own), (scores, self.scores[own, held]), (ids, self.ids[own, held])))
        order = np.lexsort((ids, ~scores, window))                      # ~ turns the order round for every long
        window, scores, ids = window[order], scores[order], ids[order]
        new = np.concatenate(([True], (np.diff(window) != 0) | (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])))
        window, scores, ids = window[new], scores[new], ids[new]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        first = place < k
        window, place = window[first], place[first]
        self.scores[window, place], self.ids[window, place] = scores[first], ids[first]
        self.n[old] = np.bincount(window, minlength=len(self.n))[old]


def best_within(block: dict[str, np.ndarray], anchors: dict[str, np.ndarray], allowed: np.ndarray, of: np.ndarray, least: np.ndarray,
                largest: np.ndarray, best: Best) -> None:
    """Puts into ``best`` what the block has for some windows: the highest of the rows ``allowed`` for anchor ``of[w]`` with a
    score from ``least[w]`` to ``largest[w]``.

    At each level a row stays while its bounds reach into a window of the anchor,
    above what k rows have for certain: those found before or, while a window has
    fewer, rows of this block by their bounds. Rows that stay for any anchor go to
    the next level, and at last into one exact product.
    """
    at, k, n = np.arange(len(block["vec_id"])), best.scores.shape[1], len(anchors["vec_id"])
    one = np.zeros(len(at), dtype=bool)                 # rows that agree in id and score count once: of an id one row sets limits
    one[np.unique(block["vec_id"], return_index=True)[1]] = True
    few = np.flatnonzero((best.n < k) & (least <= largest))
    limit, top = _limits(np.where(best.n < k, least, np.maximum(least, best.scores[:, -1]))), _limits(largest)
    limit[least > largest] = np.inf

    def reached(least_score: np.ndarray, largest_score: np.ndarray) -> np.ndarray:
        """Where scores between these may lie from the lowest limit of an anchor's windows to their highest end."""
        low, high, open_ = np.full(n, np.inf), np.full(n, -np.inf), limit <= top
        np.minimum.at(low, of[open_], limit[open_])
        np.maximum.at(high, of[open_], top[open_])
        kind = np.result_type(least_score, np.float32)          # rounding keeps the order: too many at most
        return allowed & (largest_score >= low.astype(kind)[:, None]) & (least_score <= high.astype(kind)[:, None])

    def raised(least_score: np.ndarray, largest_score: np.ndarray) -> None:
        """Limits of windows that have fewer than k rows: the k-th highest least score of the rows that are surely within."""
        for a in range(0, len(few), TOGETHER):
            w = few[a:a + TOGETHER]
            sure = allowed[of[w]] & one[at] & (largest_score[of[w]] <= top[w, None]) & (least_score[of[w]] >= _limits(least[w])[:, None])
            limit[w] = np.maximum(limit[w], _kth(np.where(sure, least_score[of[w]], -np.inf), k, -np.inf))

    def fewer() -> None:
        nonlocal at, allowed
        some = allowed.any(axis=0)
        if not some.all():
            at, allowed = at[some], allowed[:, some]

    for i in range(len(LEVELS)):
        fewer()
        own, others = anchors[f"level{i}"], block[f"level{i}"][at]
        share = max(SLACK[own.dtype], SLACK[others.dtype])
        slack = (share * anchors["norm"] * block["norm"][at].max(initial=0) + 1e-6)[:, None]
        low, high = bounds(own, others, slack.astype(np.result_type(own, others)))
        raised(low, high)
        allowed = reached(low, high)
    fewer()
    kind = exact_in(float(anchors["norm"].max(initial=0) * block["norm"][at].max(initial=0)))
    rows = block["v"][at]
    scores = products(rows, anchors["v"]) if kind is None else anchors["v"].astype(kind) @ rows.astype(kind).T
    raised(scores, scores)
    which, row = np.divmod(np.flatnonzero(reached(scores, scores)), max(1, len(at)))
    if not len(which):
        return
    # Each row that an anchor's windows may take, for each of these windows: exactly now.
    begin, stop = np.searchsorted(of, which), np.searchsorted(of, which, "right")
    window = np.repeat(begin, stop - begin) + runs(stop - begin)
    found, ids = (np.repeat(x, stop - begin) for x in (scores[which, row].astype(np.int64), block["vec_id"][at[row]]))
    within = (found >= least[window]) & (found <= largest[window]) & (found >= limit[window])
    if within.any():
        best.add(window[within], found[within], ids[within])


def row_blocks(rows: DataFrame, scale: float) -> DataFrame:
    """dim, n, block: at most ROWS rows (n of them) with their labels and summaries."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, ROWS, scale, ["label"]):
            blob = packed(vec_id=c["vec_id"], label=c["label"], v=small(c["v"]), **_levels(c["v"]))
            yield pa.RecordBatch.from_arrays([pa.array([c["v"].shape[1]], pa.int32()), pa.array([len(c["v"])], pa.int32()),
                                              pa.array([blob], pa.binary())], names=["dim", "n", "block"])

    return rows.mapInArrow(run, "dim int, n int, block binary")


def anchor_blocks(anchors: DataFrame, scale: float, others: list[str]) -> DataFrame:
    """dim, anchors: at most ANCHORS windows (rows of ``anchors``) in order of their anchors, with ``others`` (longs); ``of``
    is a window's place among the anchors, which are there once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, ANCHORS, scale, ["label", *others]):
            order = np.argsort(c["vec_id"], kind="stable")
            ids, first, of = np.unique(c["vec_id"][order], return_index=True, return_inverse=True)
            blob = packed(vec_id=ids, of=of, label=c["label"][order][first], v=small(c["v"][order][first]), **{x: c[x][order] for x in others})
            yield pa.RecordBatch.from_arrays([pa.array([c["v"].shape[1]], pa.int32()), pa.array([blob], pa.binary())],
                                             names=["dim", "anchors"])

    return gathered(anchors, ANCHORS).sortWithinPartitions("vec_id").mapInArrow(run, "dim int, anchors binary")


def _units(pairs: DataFrame, k: int, of, keys: dict[str, str], found: tuple[str, str]) -> DataFrame:
    """The k best rows of each window over the units of a task: ``keys`` (name: array of a block of anchors), then id and
    score as ``found`` names them. ``of(block, anchors, windows)``: the rows allowed for each anchor, and the windows' ends."""
    names = [*keys, *found]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[dict[str, np.ndarray], Best]] = {}      # by a block's first window: its keys, and what was found
        for batch in batches:
            for raw, own in zip(batch.column("block"), batch.column("anchors")):
                block, a = unpacked(raw.as_py()), unpacked(own.as_py())
                a["v"], block["v"] = a["v"].astype(np.float64), block["v"] if block["v"].dtype != np.int16 else block["v"].astype(np.float32)
                a["anchor_id"] = a["vec_id"][a["of"]]
                columns = {n: a[c] for n, c in keys.items()}
                _, best = held.setdefault(tuple(int(x[0]) for x in columns.values()), (columns, Best.none(len(a["of"]), k)))
                level = _levels(a["v"])
                for i in range(0, len(a["v"]), TOGETHER):
                    cut = slice(i, i + TOGETHER)
                    w = slice(*np.searchsorted(a["of"], (i, i + TOGETHER)))
                    anchors = {n: x[cut] for n, x in (a | level).items() if n in ("vec_id", "label", "v") or n in level}
                    allowed, least, largest = of(block, anchors, {n: x[w] for n, x in columns.items()})
                    best_within(block, anchors, allowed, a["of"][w] - i, least, largest, best.of(w))
            give_back()
        for columns, best in held.values():
            place = runs(best.n)
            own = np.repeat(np.arange(len(best.n)), best.n)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (*(c[own] for c in columns.values()), best.ids[own, place],
                                                                                best.scores[own, place])], names=names)

    return pairs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def mine(table: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None,
         scale: float = 256, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``is_anchor``: a condition on ``vec_id``."""
    own = (F.col("label") if label is None else label).cast("long")
    rows = vector_rows(table, id_col, vec_col, label=own).filter(F.col("label").isNotNull())
    blocks, n_blocks, n_rows = saved_measured(row_blocks(rows, scale), "segment-blocks", F.col("n"))
    anchors = saved(rows.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a"))
                    .select("vec_id", "a.label", "a.v"), "anchors")

    def met(windows: DataFrame, others: list[str]) -> DataFrame:
        """All blocks of rows with blocks of the stated windows."""
        windows_, n, size = saved_measured(anchor_blocks(windows, scale, others), "anchor-blocks", F.length("anchors"))
        return paired(blocks, n_blocks, windows_, *grid(table.sparkSession, n_rows, windows.count(), n, size))

    def alike(block, a, w):
        n = len(w["anchor_id"])
        return (block["label"] == a["label"][:, None]) & (block["vec_id"] != a["vec_id"][:, None]), np.full(n, LONG[0]), np.full(n, LONG[1])

    found = _units(met(anchors, []), positives, alike, {"anchor_id": "anchor_id"}, ("positive_id", "positive_score")).distinct()
    best = saved(highest(found, ["anchor_id"], "positive_score", "positive_id", positives), "positives")

    # One row per anchor and positive; a positive's window of scores depends on its score alone.
    wanted = saved(anchors.hint("merge").join(best.withColumnRenamed("anchor_id", "vec_id").hint("merge"), "vec_id"), "windows")

    def unlike(block, a, w):
        least, largest = (np.array(x, dtype=np.int64) for x in zip(*[windows(p, low, high) for p in w["positive_score"].tolist()]))
        return (block["label"] != a["label"][:, None]) & (block["vec_id"] != a["vec_id"][:, None]), least, largest

    found = _units(met(wanted, ["positive_id", "positive_score"]), negatives, unlike,
                   {n: n for n in ("anchor_id", "positive_id", "positive_score")}, ("negative_id", "negative_score")).distinct()
    return highest(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives) \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
