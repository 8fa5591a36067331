"""Benchmark decontamination with a document-partitioned positional inverted index.

``build_index`` stores, for each block of documents, the postings of every
benchmark term: term -> positions in the block, ascending (documents are laid
out one after another with gaps, so no match runs from one into the next).
Blocks are rows: the index is distributed, needs no shuffle, and a block's
memory is bounded by the block's text. ``search`` takes each window of a
benchmark item, starts from the term of the window that is rarest in the block,
and keeps the starts whose other terms have a posting at the matching offset
(exact phrase), or one within ``slop`` positions of it (proximity).

The benchmark goes to the executors in blocks of ``BENCHMARK_BYTES`` of text at
most, measured before each broadcast; a larger benchmark takes more passes, and
the hits of the passes are merged per document.

Defined results: null texts (documents or items) have no words; items without
words and items with a null id match nothing; an item of fewer than ``window``
words is one window; repeated rows are handled row by row; extra columns are
ignored; without benchmark rows nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.expressions import col
from tablesmith.llm.common import ByValue, alnum_words, as_bytes, id_text, runs, slices, without_ids

WINDOW = 13
BENCHMARK_BYTES = 16 << 20
INDEX = ("doc_ids array<long>, starts array<int>, n_words array<int>, "
         "terms array<int>, term_starts array<int>, positions array<int>")


class Windows(ByValue):
    """The distinct windows of a block of benchmark items, as term numbers."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int) -> None:
        self.terms: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            ids = [self.terms.setdefault(w, len(self.terms)) for w in alnum_words(text)]
            for s in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[s:s + window]), set()).add(item_id)
        self.items = [sorted(v) for v in found.values()]
        self.lengths = np.array([len(k) for k in found], dtype=np.int64)
        self.grid = np.zeros((len(found), window), dtype=np.int64)
        for i, k in enumerate(found):
            self.grid[i, :len(k)] = k


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                     most: int = BENCHMARK_BYTES) -> Iterator[list[tuple[str, bytes | None]]]:
    """The items in blocks of about ``most`` bytes of text: one when the whole benchmark fits."""
    items = benchmark.select(col(id_col).cast("string").alias("item_id"),
                             col(text_col).cast("string").cast("binary").alias("text")).na.drop()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-int(size) // most)
    for k in range(n):
        own = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], bytes(r[1])) for r in own.collect()]


def build_index(docs: DataFrame, terms: dict[bytes, int], gap: int) -> DataFrame:
    """One row per block of documents: its ids, word counts and the postings of ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in slices(batches):
            n_words, ids, missing = [], [], repeat(-1)
            for text in as_bytes(batch):
                words = alnum_words(text)
                n_words.append(len(words))
                ids.append(np.fromiter(map(number, words, missing), dtype=np.int32, count=len(words)))
            counts = np.array(n_words, dtype=np.int64)
            starts = np.cumsum(counts + gap) - counts - gap
            flat = np.concatenate(ids)
            at = np.repeat(starts, counts) + runs(counts)
            known = flat >= 0
            flat, at = flat[known], at[known].astype(np.int32)
            order = np.argsort(flat, kind="stable")
            flat, at = flat[order], at[order]
            first = np.flatnonzero(np.diff(flat, prepend=-1))
            lists = [batch.column("doc_id"), starts.astype(np.int32), counts.astype(np.int32), flat[first],
                     first.astype(np.int32), at]
            yield pa.RecordBatch.from_arrays([_one(x) for x in lists], names=[f.split()[0] for f in INDEX.split(", ")])

    return id_text(docs).mapInArrow(run, INDEX)


def _one(values) -> pa.ListArray:
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], type=pa.int32()), values)


def _matches(windows: Windows, terms, term_starts, positions, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window number, first position, last position) of every match in a block."""
    none = (np.empty(0, np.int64),) * 3
    if not len(positions) or not len(windows.lengths):
        return none
    n_terms = int(windows.grid.max()) + 1
    size = np.zeros(n_terms, np.int64)
    begin = np.zeros(n_terms, np.int64)
    size[terms], begin[terms] = np.diff(np.append(term_starts, len(positions))), term_starts
    width = windows.grid.shape[1]
    inside = np.arange(width) < windows.lengths[:, None]
    counts = np.where(inside, size[windows.grid], np.iinfo(np.int64).max)
    rarest = counts.argmin(axis=1)
    least = counts[np.arange(len(counts)), rarest]
    which = np.repeat(np.arange(len(counts)), least)
    if not len(which):
        return none
    offset = rarest[which]
    anchor = windows.grid[which, offset]
    start = positions[begin[anchor] + runs(least)].astype(np.int64) - offset
    keys = (np.repeat(terms.astype(np.int64), size[terms]) << 32) | positions
    low, high = start.copy(), start + windows.lengths[which] - 1
    order = np.argsort(counts, axis=1, kind="stable")          # the next rarest term next
    for step in range(1, width):
        if not len(which):
            break
        j = order[which, step]
        open_ = step < windows.lengths[which]
        want = (windows.grid[which, j] << 32) | np.maximum(start + j - slop, 0)
        at = np.searchsorted(keys, want)
        got = keys[np.minimum(at, len(keys) - 1)]
        ok = ~open_ | ((at < len(keys)) & (got >= want) & (got - want <= 2 * slop) & (start + j + slop >= 0))
        seen = np.where(open_ & ok, got & 0xFFFFFFFF, start + offset)
        low, high = np.minimum(low, seen), np.maximum(high, seen)
        which, start, offset, low, high = which[ok], start[ok], offset[ok], low[ok], high[ok]
    return which, low, high


def search(index: DataFrame, windows: Windows, *, slop: int = 0) -> DataFrame:
    """Per document: doc_id, n_words, ``hits`` (ascending, disjoint word ranges) and ``items`` (sorted ids)."""
    shared = index.sparkSession.sparkContext.broadcast(windows)
    pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("doc_ids")[k].values
                starts, counts, terms, begins, at = (batch.column(n)[k].values.to_numpy() for n in
                                                     ("starts", "n_words", "terms", "term_starts", "positions"))
                which, low, high = _matches(w, terms, begins, at, slop)
                doc = np.searchsorted(starts, low, side="right") - 1
                hits: list[list[dict]] = [[] for _ in counts]
                items: list[set[str]] = [set() for _ in counts]
                for d, a, b, i in sorted(zip(doc.tolist(), (low - starts[doc]).tolist(), (high - starts[doc] + 1).tolist(),
                                             which.tolist())):
                    items[d].update(w.items[i])
                    if hits[d] and a <= hits[d][-1]["end"]:
                        hits[d][-1]["end"] = max(b, hits[d][-1]["end"])
                    else:
                        hits[d].append({"start": a, "end": b})
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pair)),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    names=["doc_id", "n_words", "hits", "items"])

    return index.mapInArrow(run, "doc_id long, n_words long, hits array<struct<start:int,end:int>>, items array<string>")


def _joined(passes: list[DataFrame]) -> DataFrame:
    """The passes of a benchmark in several blocks as one row per document (rows told apart by their number)."""
    every = reduce(DataFrame.unionAll, passes)
    merged = every.groupBy("row", "doc_id", "n_words").agg(F.flatten(F.collect_list("hits")).alias("all_hits"),
                                                           F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    sorted_hits = F.array_sort("all_hits")
    start = F.array().cast("array<struct<start:int,end:int>>")

    def fold(acc, h):
        last = F.try_element_at(acc, F.lit(-1))
        overlaps = (F.size(acc) > 0) & (h["start"] <= last["end"])
        joined = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                          F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], h["end"]).alias("end"))))
        return F.when(overlaps, joined).otherwise(F.concat(acc, F.array(h)))

    return merged.select("doc_id", "n_words", F.aggregate(sorted_hits, start, fold).alias("hits"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, slop: int = 0,
                  benchmark_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, ``hits`` (word ranges covered by windows) and ``items``."""
    blocks = list(benchmark_blocks(benchmark, most=benchmark_bytes)) or [[]]
    passes = []
    for block in blocks:
        windows = Windows(block, window)
        passes.append(search(build_index(docs, windows.terms, window + slop), windows, slop=slop))
    found = passes[0] if len(passes) == 1 else _joined(
        [p.withColumn("row", F.monotonically_increasing_id()) for p in passes])
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "hits", "items")


def contaminated(n_hit, n_words):
    """The contamination rule: some word hit, and at least a twentieth of all words."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose id the contamination rule finds; rows with a null id stay."""
    found = contamination(docs, benchmark, **options)
    return without_ids(docs, found.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select("doc_id"))
