"""Exact top-k by inner product: M-tree best-first search.

Integer vectors become points of a metric space by one more coordinate: with
M the largest norm, v -> (v, sqrt(M^2 - |v|^2)) and q -> (q, 0) give
|q' - v'|^2 = |q|^2 + M^2 - 2 <q, v>, so the nearest points are the largest
products. The points are indexed in M-trees of paged nodes: a routing entry has
its object, covering radius and distance to its parent's object. A search
keeps a heap of nodes by the least distance that they can hold, opens the best
one, and skips an entry without computing its distance when the stored
distances show by the triangle inequality that it is out of reach.

The queries of a block search a tree together: a node is opened for those of
them that it can still hold something for, and a page is scored for all of these
in one matrix product.

Distribution: the rows are cut into trees of at most ``TREE`` points, built
where the rows are read, and the queries into blocks; each (tree, block) pair is
one unit of bounded size, dealt over groups of trees and shares of queries. A
task goes from tree to tree with what its queries have found, and the k best of
each group are merged per query. Nothing grows with the table but the number of
units.

Defined results: rows with a null vector, or with a null or non-finite
component, take no part, nor do rows with a null id; a vector of another length
than a query's is no candidate of it; equal scores go to the smaller id;
repeated rows count as often as they occur (a query never finds rows under its
own id), and of different rows under one query's id the first by vector is the
query; scores and components beyond a long's range: see ``vectors``; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import give_back, saved, saved_measured
from tablesmith.llm.vectors import LONG, chunks, exact_in, gathered, grid, highest, packed, paired, products, small, unpacked, vector_rows

TOP = 5
PAGE = 64
TREE = 4096
#: Queries that search together, and how many times as many a stored block has.
BLOCK, TOGETHER = 1024, 4


def build(points: np.ndarray) -> dict[str, np.ndarray]:
    """An M-tree in pages, the root first. Entry arrays: distance to the page's own object, covering radius (0 in leaves)
    and child (page number; in leaves, by distance, the place in ``order``, the rows leaf by leaf). Page arrays: first
    entry, first routing object (leaves have none), and whether it is a leaf."""
    pages: list[tuple] = []

    def page(rows: np.ndarray, own: np.ndarray | None, seed: int) -> tuple[int, float]:
        number, far = len(pages), points[rows]
        pages.append(())
        reach = np.linalg.norm(far - own, axis=1) if own is not None else np.zeros(len(rows))
        if len(rows) <= PAGE:
            by_reach = np.argsort(reach, kind="stable")
            pages[number] = (far[:0], reach[by_reach], np.zeros(len(rows)), rows[by_reach], True)
            return number, float(reach.max(initial=0.0))
        groups = [rows[g] for g in _divide(far, seed)]
        objects = np.stack([points[g].mean(axis=0) for g in groups])
        made = [page(g, o, seed + 1) for g, o in zip(groups, objects)]
        to_own = np.linalg.norm(objects - own, axis=1) if own is not None else np.zeros(len(groups))
        pages[number] = (objects, to_own, np.array([r for _, r in made]), np.array([n for n, _ in made]), False)
        return number, float(reach.max())

    page(np.arange(len(points)), None, 5)
    order = np.concatenate([p[3] for p in pages if p[4]])
    place = np.empty(len(points), dtype=np.int32)
    place[order] = np.arange(len(points))
    return {"object": np.concatenate([p[0] for p in pages]), "to_own": np.concatenate([p[1] for p in pages]),
            "radius": np.concatenate([p[2] for p in pages]), "child": np.concatenate([place[p[3]] if p[4] else p[3] for p in pages]).astype(np.int32),
            "first": np.cumsum([0, *[len(p[3]) for p in pages]]), "first_object": np.cumsum([0, *[len(p[0]) for p in pages]]),
            "leaf": np.array([p[4] for p in pages]), "order": order}


def _divide(points: np.ndarray, seed: int) -> list[np.ndarray]:
    """At most PAGE groups: spread-out points are picked, each takes the points nearest to it."""
    fan = min(PAGE, -(-len(points) // (PAGE // 2)))
    picked = 1
    start = int(np.random.default_rng(seed).integers(len(points)))
    nearest, owner = np.linalg.norm(points - points[start], axis=1), np.zeros(len(points), dtype=np.int64)
    while picked < fan and nearest.max() > 0:
        d = np.linalg.norm(points - points[int(nearest.argmax())], axis=1)
        owner[d < nearest] = picked
        nearest, picked = np.minimum(nearest, d), picked + 1
    groups = [g for g in (np.flatnonzero(owner == i) for i in range(picked)) if len(g)]
    return groups if len(groups) > 1 else np.array_split(np.arange(len(points)), fan)


#: Slack of distances against rounding, as a share of the largest distance of the space.
SLACK = 1e-6


def _distances(points: np.ndarray, objects: np.ndarray) -> np.ndarray:
    squares = (points ** 2).sum(axis=1)[:, None] + (objects ** 2).sum(axis=1) - 2.0 * (points @ objects.T)
    return np.sqrt(np.maximum(squares, 0.0))


def best_first(tree: dict[str, np.ndarray], queries: np.ndarray, own_ids: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
    """Puts what the tree has for each query into its row of ``scores`` and ``ids``: the best so far, by score, then
    smaller id; unused places hold the least and the largest long.

    A heap holds nodes by the least distance at which any query may find something in them.
    """
    n, k, most = len(queries), scores.shape[1], float(tree["most"])
    points = np.column_stack((queries, np.zeros(n)))
    squares = (queries ** 2).sum(axis=1)
    reach2 = squares + most
    kind = exact_in(float(np.sqrt(squares.max(initial=0) * most)))
    vectors, asked = tree["vectors"].astype(kind or np.float64), queries.astype(kind or np.float64)
    slack = SLACK * (np.sqrt(reach2) + np.sqrt(most)) + 1e-6
    limit = np.empty(n)                           # distance beyond which nothing can enter

    def narrow(who: np.ndarray) -> None:
        far = np.sqrt(np.maximum(reach2[who] - 2.0 * scores[who, -1].astype(np.float64), 0.0)) + slack[who]
        limit[who] = np.where(ids[who, -1] != LONG[1], far, np.inf)

    narrow(np.arange(n))
    heap: list[tuple[float, int, np.ndarray, np.ndarray | None]] = [(0.0, 0, np.zeros(n), None)]
    while heap:
        least, number, low, to_object = heapq.heappop(heap)
        if least > limit.max(initial=-np.inf):
            break
        first, end = tree["first"][number:number + 2]
        who = np.flatnonzero(low <= limit)
        if not tree["leaf"][number]:
            at = np.arange(first, end)
            if to_object is not None and len(who):    # triangle inequality: no distance is computed for what it leaves out
                apart = np.abs(to_object[who] - tree["to_own"][at][:, None]) - tree["radius"][at][:, None]
                within = apart <= (limit + slack)[who]
                at, who = at[within.any(axis=1)], who[within.any(axis=0)]
            if not len(at) or not len(who):
                continue
            d = np.full((len(at), n), np.inf)
            d[:, who] = _distances(tree["object"][at - first + tree["first_object"][number]], points[who])
            bound = np.maximum(d - tree["radius"][at][:, None] - slack, 0.0)
            for page, own_bound, own_d, near in zip(tree["child"][at].tolist(), bound, d, (bound <= limit).any(axis=1)):
                if near:
                    heapq.heappush(heap, (float(own_bound.min()), page, own_bound, own_d))
            continue
        if to_object is not None and len(who):        # the same, of distances in order
            to_own, far = tree["to_own"][first:end], (limit + slack)[who]
            begin, stop = np.searchsorted(to_own, to_object[who] - far), np.searchsorted(to_own, to_object[who] + far, "right")
            some = begin < stop
            who, first, end = who[some], first + begin[some].min(initial=end - first), first + stop[some].max(initial=0)
        if not len(who):
            continue
        child = slice(tree["child"][first], tree["child"][end - 1] + 1)
        own = asked if len(who) == n else asked[who]
        found = products(vectors[child], own) if kind is None else own @ vectors[child].T
        good = found >= scores[who, -1].astype(found.dtype)[:, None]      # rounding keeps the order: too many at most
        better = np.flatnonzero(good.any(axis=1))
        if not len(better):
            continue
        some = np.flatnonzero(good[better].any(axis=0))
        who, found, their = who[better], found[np.ix_(better, some)].astype(np.int64), tree["ids"][child][some]
        own = their[None, :] == own_ids[who][:, None]
        # A query's own rows go last, behind unused places.
        s = np.concatenate((scores[who], np.where(own, LONG[0], found)), axis=1)
        i = np.concatenate((ids[who], np.where(own, LONG[1], their[None, :])), axis=1)
        order = np.lexsort((i, ~s), axis=1)[:, :k]
        scores[who], ids[who] = np.take_along_axis(s, order, axis=1), np.take_along_axis(i, order, axis=1)
        narrow(who)


def trees(vectors: DataFrame, scale: float) -> DataFrame:
    """One row per M-tree of at most TREE points: dim, its points' number n, and the tree with its vectors as bytes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, TREE, scale):
            squares = (c["v"] ** 2).sum(axis=1)
            tree = build(np.column_stack((c["v"], np.sqrt(squares.max() - squares))))
            order = tree.pop("order")
            blob = packed(ids=c["vec_id"][order], vectors=small(c["v"][order]), most=squares.max(), **tree)
            yield pa.RecordBatch.from_arrays([pa.array([c["v"].shape[1]], pa.int32()), pa.array([len(order)], pa.int32()),
                                              pa.array([blob], pa.binary())], names=["dim", "n", "block"])

    return vectors.mapInArrow(run, "dim int, n int, block binary")


def query_blocks(queries: DataFrame, scale: float) -> DataFrame:
    """One row per block of queries: dim, ids and vectors as bytes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, TOGETHER * BLOCK, scale):
            yield pa.RecordBatch.from_arrays([pa.array([c["v"].shape[1]], pa.int32()), pa.array([packed(**c | {"v": small(c["v"])})], pa.binary())],
                                             names=["dim", "queries"])

    return gathered(queries, TOGETHER * BLOCK).mapInArrow(run, "dim int, queries binary")


def top_k(table: DataFrame, is_query, *, k: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest products of every row for which ``is_query`` (a condition on vec_id) holds."""
    vectors = vector_rows(table, id_col, vec_col)
    forest, n_trees, n_rows = saved_measured(trees(vectors, scale), "trees", F.col("n"))
    queries, n_queries, _ = saved_measured(vectors.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    blocks, n_blocks, n_bytes = saved_measured(query_blocks(queries, scale), "query-blocks", F.length("queries"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, ...]] = {}      # by a block's first query: its queries, the scores and ids that they have found
        for batch in batches:
            for raw, own in zip(batch.column("block"), batch.column("queries")):
                tree, block = unpacked(raw.as_py()), unpacked(own.as_py())
                n, vectors = len(block["vec_id"]), block["v"].astype(np.float64)
                best = held.setdefault(int(block["vec_id"][0]), (block["vec_id"], np.full((n, k), LONG[0]), np.full((n, k), LONG[1])))
                for a in range(0, n, BLOCK):
                    own_ids, scores, ids = (x[a:a + BLOCK] for x in best)
                    best_first(tree, vectors[a:a + BLOCK], own_ids, scores, ids)
            give_back()
        for own_ids, scores, ids in held.values():
            used = ids != LONG[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own_ids, used.sum(axis=1))), pa.array(scores[used]), pa.array(ids[used])],
                                             names=["query_id", "score", "vec_id"])

    # Blocks of queries against trees, unit by unit: the stated query set against all rows.
    groups, shares = grid(table.sparkSession, n_rows, n_queries, n_blocks, n_bytes)
    found = paired(forest, n_trees, blocks, groups, shares).mapInArrow(run, "query_id long, score long, vec_id long")
    return highest(found, ["query_id"], "score", "vec_id", k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
