"""Shared pieces: table access, Arrow batches, ASCII word splitting, word hashes, worker caches."""

from __future__ import annotations

import itertools
import operator
import pickle
import re
import sys
import types
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.functions.expressions import col
from tablesmith.session import work_path

U64 = np.uint64
#: Bytes of text handled at once inside a task.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just ``doc_id`` (long) and ``text`` (string): other columns, whatever their names, are not read."""
    return docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))


def crc_mod(id_column: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null ids: null)."""
    return F.crc32(id_column.cast("string").cast("binary")) % F.lit(n)


#: Rows of a stored table's file, where a bound of its rows is known beforehand.
ROWS_A_FILE = 250_000


def saved(df: DataFrame, what: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back (cuts lineage, survives lost executors).

    ``rows``: a measured bound of its rows; the last stage then has as many
    tasks as that is worth, however many partitions shuffles are set to.
    """
    path = work_path(df.sparkSession, "llm", what)
    (df if rows is None else df.coalesce(max(1, -(-rows // ROWS_A_FILE)))).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_measured(df: DataFrame, what: str, measure: Column | None = None, rows: int | None = None) -> tuple[DataFrame, int, int]:
    """``saved``, with the number of rows and the sum of ``measure``, taken from what was written."""
    out = saved(df, what, rows)
    if measure is None:
        return out, out.count(), 0          # footers only
    found = out.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(measure), F.lit(0)).alias("sum")).first()
    return out, found["rows"], found["sum"]


def saved_for_join(df: DataFrame, what: str, size: Column | int, most_bytes: int, rows: int | None = None) -> DataFrame:
    """``saved``, hinted for broadcast if it has at most MAX_IDS rows and ``most_bytes``; ``size``: a row's bytes."""
    out, found, total = saved_measured(df, what, None if isinstance(size, int) else size, rows)
    total = found * size if isinstance(size, int) else total
    return F.broadcast(out) if found <= MAX_IDS and total <= most_bytes else out


#: Ids that a join may broadcast, measured before it does; with more of them it shuffles.
MAX_IDS, MAX_ID_BYTES = 2_000_000, 64 << 20


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``gone`` (one column); null ids stay."""
    ids = saved_for_join(gone.toDF(id_col).na.drop().distinct(), "dropped-ids", 8, MAX_ID_BYTES)
    return docs.join(ids, id_col, "left_anti").select(*map(col, docs.columns))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` holds about ``most`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pa.compute.fill_null(pa.compute.binary_length(batch.column(column).cast(pa.binary())), 0)
        run = np.cumsum(np.asarray(size, dtype=np.int64)) // most
        cuts = np.flatnonzero(np.diff(run)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)
            give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker shares its executor's memory with the JVM, and lives through many tasks."""
    pa.default_memory_pool().release_unused()
    cache = worker_cache()
    if "malloc_trim" not in cache:
        import ctypes
        cache["malloc_trim"] = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if cache["malloc_trim"] is not None:
        cache["malloc_trim"](0)


def as_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


class _Pickled:
    """Bytes that unpickle to what they hold."""

    def __init__(self, data: bytes) -> None:
        self.data = data

    def __reduce__(self):
        return pickle.loads, (self.data,)


class ByValue:
    """Objects that a broadcast or a task may carry to workers without this package: their class travels with them."""

    def __reduce__(self):
        kind, state = type(self), self.__dict__

        def build():
            out = kind.__new__(kind)
            out.__dict__.update(state)
            return out

        return operator.call, (_Pickled(cloudpickle.dumps(build)),)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker (functions are pickled by value, so module globals do not)."""
    return sys.modules.setdefault("_tablesmith_worker_cache", types.ModuleType("_tablesmith_worker_cache")).__dict__


#: A-Z to a-z; every ASCII byte that is neither letter nor digit to a space; bytes of other characters kept.
ALNUM_TABLE = bytes((b + 32) if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                    for b in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words of letters and digits (any non-ASCII character counts as a letter), A-Z lower-cased."""
    return text.translate(ALNUM_TABLE).split() if text else []


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (murmur3's): spreads a weak hash over all bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def window_hashes(words: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words, by start position."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    out = words[:n].copy()
    for j in range(1, width):
        out = out * U64(base) + words[j:j + n]
    return mix(out)


def runs(counts: np.ndarray) -> np.ndarray:
    """0,1,..,c-1 for each count c, concatenated."""
    total = int(counts.sum())
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    return np.arange(total, dtype=np.int64) - starts


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array)
                                       else columns[f.name].cast(f.type) for f in schema], schema=schema)




def slice_words(texts: Sequence[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the whitespace-separated words of some texts one after another, and where each text starts (and ends).

    ``bytes.lower`` and ``bytes.split`` know ASCII only: A-Z, and the space and 9 to 13.
    """
    words = [(t.lower() if lower else t).split() if t else [] for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64))).astype(np.int64)
    return word_hashes(list(itertools.chain.from_iterable(words))), starts


def in_parts(part: np.ndarray, parts: int, **arrays: np.ndarray) -> dict[int, dict[str, bytes]]:
    """The arrays as bytes, split by ``part`` (order kept inside a part); parts without rows are left out."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    arrays = {k: v[order] for k, v in arrays.items()}
    return {p: {k: v[a:b].tobytes() for k, v in arrays.items()} for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b}


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def merged(rows: DataFrame, part: str, blobs: dict[str, str], combine, schema: str, partitions: int) -> DataFrame:
    """Bring the rows of a part together and call ``combine(part, {blob: array})``, which yields record batches.

    ``blobs`` maps binary columns to numpy types. A task holds the arrays of its
    own parts only; part ``p`` goes to task ``p`` modulo ``partitions``.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[str, list[bytes]]] = {}
        for batch in batches:
            columns = {k: batch.column(k).to_pylist() for k in blobs}
            for i, p in enumerate(batch.column(part).to_pylist()):
                for k, own in held.setdefault(p, {k: [] for k in blobs}).items():
                    own.append(columns[k][i])
        while held:
            p, own = held.popitem()
            give_back()
            yield from combine(p, {k: [np.frombuffer(x, dtype=t) for x in own[k]] for k, t in blobs.items()})

    return rows.repartitionById(partitions, F.col(part)).mapInArrow(run, schema)
