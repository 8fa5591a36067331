"""Shared pieces of the vector operators: integer components, blocks of rows, exact products, block pairs.

A component x stands for floor(scale * x), taken to at most 2^62 either way; a
score is the integer inner product, exact, taken to the range of a long. Rows
with a null vector, a null or non-finite component or a null id take no part.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesmith.functions.expressions import col
from tablesmith.llm.common import shuffle_partitions

#: Components are taken to this range; below EXACT a sum of float64 products of integers has no rounding.
MOST, EXACT = 2.0 ** 62, 2.0 ** 53
LONG = (-(1 << 63), (1 << 63) - 1)


def vector_rows(table: DataFrame, id_col: str, vec_col: str, **others: Column) -> DataFrame:
    """vec_id, v (array of doubles) and ``others``, of the rows that take part."""
    x = col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return table.filter(col(id_col).isNotNull() & x.isNotNull() & finite) \
        .select(col(id_col).cast("long").alias("vec_id"), x.alias("v"), *[c.alias(n) for n, c in others.items()])


def integers(x: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -MOST, MOST)


def chunks(batches: Iterable[pa.RecordBatch], most: int, scale: float, others: Sequence[str] = ()) -> Iterator[dict[str, np.ndarray]]:
    """Blocks of at most ``most`` rows with vectors of one length, filled across batches: vec_id, v, ``others`` (longs)."""
    held: dict[int, list[dict[str, np.ndarray]]] = {}
    count: dict[int, int] = {}
    for batch in batches:
        v = batch.column("v")
        lengths = np.asarray(pa.compute.list_value_length(v), dtype=np.int64)
        flat = np.asarray(v.flatten(), dtype=np.float64)
        at = np.cumsum(lengths) - lengths
        longs = {n: np.asarray(batch.column(n), dtype=np.int64) for n in ("vec_id", *others)}
        for dim in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == dim)
            block = integers(flat[at[rows][:, None] + np.arange(dim)], scale)
            for a in range(0, len(rows), most):
                cut = slice(a, a + most)
                own = held.setdefault(dim, [])
                own.append({"v": block[cut], **{n: x[rows[cut]] for n, x in longs.items()}})
                count[dim] = count.get(dim, 0) + len(rows[cut])
                if count[dim] >= most:
                    whole = {n: np.concatenate([o[n] for o in own]) for n in own[0]}
                    yield {n: x[:most] for n, x in whole.items()}
                    held[dim], count[dim] = [{n: x[most:] for n, x in whole.items()}], count[dim] - most
    for dim, own in held.items():
        if count[dim]:
            yield {n: np.concatenate([o[n] for o in own]) for n in own[0]}


def packed(**arrays: np.ndarray) -> bytes:
    blob = io.BytesIO()
    np.savez(blob, **arrays)
    return blob.getvalue()


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(blob)))


def small(matrix: np.ndarray) -> np.ndarray:
    """In as few bytes as keep every integer."""
    most = np.abs(matrix).max(initial=0)
    return matrix.astype(np.int16 if most < 1 << 15 else np.float32 if most < 1 << 24 else np.float64)


def exact_in(reach: float) -> type | None:
    """The type in which products of integers are exact where the lengths' product is at most ``reach`` (None: in neither).

    By the Cauchy-Schwarz inequality no partial sum is beyond it either.
    """
    return np.float32 if reach < 0.999 * (1 << 24) else np.float64 if reach < 0.999 * EXACT else None


def products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact scores (longs) of each query with each row: a matrix product, and integers of any size where that would round."""
    reach = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)
    kind = exact_in(reach.max(initial=0))
    if kind is not None:
        return (queries.astype(kind) @ rows.astype(kind).T).astype(np.int64)
    far = reach >= 0.999 * EXACT
    out = np.where(far, 0, queries @ rows.T).astype(np.int64)
    for i, j in zip(*np.nonzero(far)):
        exact = sum(int(a) * int(b) for a, b in zip(queries[i].tolist(), rows[j].tolist()))
        out[i, j] = min(max(exact, LONG[0]), LONG[1])
    return out


#: Scores that make a task worthwhile, scores that a task has at most (about), and bytes of query blocks that meet a group of rows.
FEW, MANY, HELD = 1 << 24, 1 << 34, 16 << 20


def grid(spark: SparkSession, rows: int, queries: int, query_blocks: int, query_bytes: int) -> tuple[int, int]:
    """(groups of row blocks, shares of query blocks) for ``paired``.

    Each group gets a copy of every query and gives it back its best, each share
    a copy of every row: their number is balanced so that few bytes are copied
    in all, whatever the tables' sizes.
    """
    scores = rows * queries
    tasks = max(1, min(shuffle_partitions(spark), scores // FEW), scores // MANY)
    groups = max(1, min(tasks, round((tasks * rows / (3 * max(1, queries))) ** 0.5)))
    return groups, max(1, min(query_blocks, max(-(-tasks // groups), -(-query_bytes // HELD))))


def paired(blocks: DataFrame, n_blocks: int, queries: DataFrame, groups: int | None = None, shares: int = 1) -> DataFrame:
    """Every block of rows with every block of queries of its ``dim``: the stated query set against all rows.

    Blocks of rows are dealt into groups, and the (far fewer) query blocks go to
    each group, so that no key has more than a few blocks of rows; query blocks
    are dealt into ``shares``, and row blocks go to each share. Both sides are
    shuffled: the copies are not in Spark's estimate of a side's size, so that
    it would broadcast what no driver holds.
    """
    groups, keys = max(1, min(n_blocks, groups or 4 * shuffle_partitions(blocks.sparkSession))), ["dim", "g", "share"]

    def dealt(df: DataFrame, name: str, n: int, other: str, copies: int) -> DataFrame:
        blob = next(c for c, kind in df.dtypes if kind == "binary")
        return df.withColumn(name, F.pmod(F.xxhash64(blob), F.lit(n)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).repartition(2 * groups * shares, *keys).hint("merge")

    return dealt(blocks, "g", groups, "share", shares).join(dealt(queries, "share", shares, "g", groups), keys)


def gathered(rows: DataFrame, most: int) -> DataFrame:
    """Rows brought together in as many tasks as full blocks of ``most`` rows take (one job counts them)."""
    return rows.repartition(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-rows.count() // most)))))


def highest(found: DataFrame, by: Sequence[str], score: str, vec_id: str, k: int) -> DataFrame:
    """The first ``k`` rows of each key by score, then smaller id, with their ``rank`` (each task keeps k before the shuffle)."""
    first = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(vec_id))
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
