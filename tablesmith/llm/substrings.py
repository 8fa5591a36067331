"""Exact removal of repeated word windows, behind a count-min prefilter.

Pass 1 sketches the corpus. Each task hashes the windows of its documents. A
window is represented in the sketch by its smallest run of ``GRAM`` words (by
hash), which neighbouring windows mostly share, so the sketch counts a few
values for every dozen words; equal windows have equal representatives, so
the count of a representative is never below the number of documents that hold
the window. The partition sketches (cells hit once, and more than once) are
merged cell range by cell range, and only one bit per cell, "more than once",
is kept: ``ROWS`` x ``CELLS`` bits, a fixed size, which is broadcast.

Pass 2 hashes the windows again and keeps those whose representative may occur
in two documents: every repeated window among them. A batch settles on its own
what it can: of a window that several of its documents hold, all but the
smallest id lose it, and only that one is sent on. What is sent is grouped
exactly, by 96 bits of two hashes, and all documents but the smallest lose the
window. So a passage that a third of all documents share reaches its task once
per batch. The positions found are joined back to the texts, and the covered
words are removed.

Defined results: null and empty texts have no words; a row with a null id
keeps all its words and takes no word from another; rows that share an id never
take words from one another; texts under ``WIDTH`` words have no window; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import (U64, as_bytes, id_text, in_parts, merged, mix, shuffle_partitions, slice_words, slices,
                                   window_hashes)

WIDTH = 13
GRAM = 8
#: The sketch: rows, cells of each (a power of two), and ranges in which cells are merged.
ROWS, CELLS, RANGES = 2, 1 << 27, 64


def _window_starts(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, position in all words) of every window that lies in one text."""
    counts = np.maximum(np.diff(starts) - width + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    return text, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[text]


def _representatives(words: np.ndarray, width: int, gram: int) -> np.ndarray:
    """Smallest hash of the runs of ``gram`` words inside each window, by window start."""
    runs = window_hashes(words, gram)
    n = max(0, len(words) - width + 1)
    out = runs[:n].copy()
    for j in range(1, width - gram + 1):
        np.minimum(out, runs[j:j + n], out=out)
    return out


def _cells(values: np.ndarray, row: int) -> np.ndarray:
    return (mix(values + U64(0x9E3779B97F4A7C15 * (row + 1) & (2 ** 64 - 1))) % U64(CELLS)).astype(np.uint32)


def sketch(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The merged sketch: part (row x range) and the packed bits of its cells that more than one document may hit."""
    per_range = CELLS // RANGES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, starts = slice_words(as_bytes(batch))
            text, at = _window_starts(starts, width)
            if not len(at):
                continue
            values = _representatives(words, width, gram)[at]
            new = np.ones(len(at), dtype=bool)
            new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
            values, text = values[new], text[new]
            order = np.lexsort((text, values))
            values, text = values[order], text[order]
            first = np.ones(len(values), dtype=bool)
            first[1:] = values[1:] != values[:-1]
            more = np.zeros(len(values), dtype=bool)
            more[1:] = ~first[1:] & (text[1:] != text[:-1])
            shared = np.logical_or.reduceat(more, np.flatnonzero(first))
            values = values[first]
            rows = {"part": [], "once": [], "more": []}
            for row in range(ROWS):
                cells = _cells(values, row)
                both = np.unique(cells[shared])
                cells, counts = np.unique(cells, return_counts=True)
                many = (counts > 1) | np.isin(cells, both)
                for p, found in in_parts(cells // per_range, RANGES, cell=cells % per_range, many=many).items():
                    rows["part"].append(row * RANGES + p)
                    cell, many_here = np.frombuffer(found["cell"], np.uint32), np.frombuffer(found["many"], bool)
                    # Differences of sorted numbers, byte plane by byte plane: the shuffle compresses them well.
                    rows["once"].append(_planes(cell))
                    rows["more"].append(cell[many_here].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows["part"], pa.int32()), pa.array(rows["once"], pa.binary()),
                                              pa.array(rows["more"], pa.binary())], names=list(rows))

    def combine(part: int, found: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        seen, twice = np.zeros(per_range, dtype=bool), np.zeros(per_range, dtype=bool)
        for once, more in zip(found["once"], found["more"]):
            cell = _unplanes(once)
            twice[cell] |= seen[cell]
            seen[cell] = True
            twice[more] = True
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())],
                                         names=["part", "bits"])

    own = id_text(docs).filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return merged(own.mapInArrow(run, "part int, once binary, more binary"), "part", {"once": "u1", "more": "<u4"}, combine,
                  "part int, bits binary", min(ROWS * RANGES, shuffle_partitions(docs.sparkSession)))


def _planes(cells: np.ndarray) -> bytes:
    return np.diff(cells, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint32)


def _may_repeat(bits: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    ok = np.ones(len(values), dtype=bool)
    for row in range(ROWS):
        cells = _cells(values, row)
        ok &= (bits[row][cells >> np.uint32(3)] >> (np.uint8(7) - (cells & np.uint32(7)).astype(np.uint8)) & 1).astype(bool)
    return ok


def repeated(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, digest (of the text), at: positions of windows that start in a document with a smaller id too."""
    spark = docs.sparkSession
    bits = [np.zeros(CELLS // 8, dtype=np.uint8) for _ in range(ROWS)]
    size = CELLS // RANGES // 8
    for r in sketch(docs, width=width, gram=gram).collect():       # ROWS x CELLS bits in all, whatever the input
        row, k = divmod(r["part"], RANGES)
        bits[row][k * size:(k + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(bits)
    parts = shuffle_partitions(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_numpy()
            digest = batch.column("digest").to_numpy()
            words, starts = slice_words(as_bytes(batch))
            text, at = _window_starts(starts, width)
            if not len(at):
                continue
            may = _may_repeat(shared.value, _representatives(words, width, gram)[at])
            text, at = text[may], at[may]
            first = window_hashes(words, width)[at]
            second = (window_hashes(words, width, 0xD6E8FEB86659FD93)[at] >> U64(32)).astype(np.uint32)
            place = (at - starts[text]).astype(np.int32)
            # Of a window held by several documents of this batch, only the smallest id asks the others.
            order = np.lexsort((ids[text], second, first))
            first, second, text, place = first[order], second[order], text[order], place[order]
            new = np.ones(len(first), dtype=bool)
            new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            smallest = ids[text[np.flatnonzero(new)]][np.cumsum(new) - 1] if len(first) else ids[:0]
            ask = ids[text] == smallest
            rows = {k: [] for k in ("part", "first", "second", "doc", "place", "ids", "digests")}
            lost = np.flatnonzero(~ask)
            if len(lost):           # settled here: sent straight to the documents' rows
                lost = lost[np.lexsort((place[lost], text[lost]))]
                rows["part"].append(-1)
                for k, v in (("first", first[:0]), ("second", second[:0]), ("doc", text[lost].astype(np.uint32)),
                             ("place", place[lost])):
                    rows[k].append(v.tobytes())
            keep = np.flatnonzero(ask)
            keep = keep[np.lexsort((place[keep], text[keep]))]
            part = (mix(first[keep] ^ U64(0xA0761D6478BD642F)) % U64(parts)).astype(np.int64)
            for p, found in in_parts(part, parts, first=first[keep], second=second[keep], doc=text[keep].astype(np.uint32),
                                     place=place[keep]).items():
                rows["part"].append(p)
                for k, v in found.items():
                    rows[k].append(v)
            for i in range(len(rows["part"])):
                doc = np.frombuffer(rows["doc"][i], np.uint32)
                own, back = np.unique(doc, return_inverse=True)
                rows["doc"][i] = back.astype(np.uint32).tobytes()
                rows["ids"].append(ids[own].tobytes())
                rows["digests"].append(digest[own].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows["part"], pa.int32()), *[pa.array(rows[k], pa.binary()) for k in
                                                                                  list(rows)[1:]]], names=list(rows))

    def combine(part: int, found: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        counts = np.array([len(x) for x in found["ids"]])
        shift = np.repeat(np.cumsum(counts) - counts, [len(x) for x in found["doc"]])
        row = np.concatenate(found["doc"]).astype(np.int64) + shift
        ids, digests = np.concatenate(found["ids"]), np.concatenate(found["digests"])
        first, second, place = (np.concatenate(found[k]) for k in ("first", "second", "place"))
        if len(first):
            order = np.lexsort((ids[row], second, first))
            f, s = first[order], second[order]
            new = np.ones(len(f), dtype=bool)
            new[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
            smallest = ids[row[order[np.flatnonzero(new)]]][np.cumsum(new) - 1]
            lost = order[ids[row[order]] > smallest]
        else:
            lost = np.arange(len(place))
        doc, digest = ids[row[lost]], digests[row[lost]]
        order = np.lexsort((place[lost], digest, doc))
        doc, digest, at = doc[order], digest[order], place[lost][order]
        to = (mix(doc.view(U64) ^ mix(digest.view(U64))) % U64(parts)).astype(np.int64)
        found = in_parts(to, parts, ids=doc, digests=digest, at=at)
        rows = []
        for p, x in found.items():      # a document once, with the number of its positions
            begin = _change(x["ids"], x["digests"])
            rows.append((p, *(np.frombuffer(x[k], "<i8")[begin].tobytes() for k in ("ids", "digests")), x["at"],
                         np.diff(np.append(begin, len(x["at"]) // 4)).astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary() if i else pa.int32()) for i in range(5)],
                                         names=["part", "ids", "digests", "at", "counts"])

    def gather(part: int, found: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """Positions by document: everything about a document meets in one part."""
        counts = np.concatenate(found["counts"]).astype(np.int64)
        doc, digest = (np.repeat(np.concatenate(found[k]), counts) for k in ("ids", "digests"))
        order = np.lexsort((digest, doc))
        doc, digest, at = doc[order], digest[order], np.concatenate(found["at"])[order].astype("<i4")
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])
        begin = np.append(np.flatnonzero(new), len(doc))
        for a in range(0, len(begin) - 1, 1000):
            cut = begin[a:a + 1001]
            own = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(((cut - cut[0]) * 4).astype(np.int32).tobytes()),
                                                                   pa.py_buffer(at[cut[0]:cut[-1]].tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(doc[cut[:-1]]), pa.array(digest[cut[:-1]]), own], names=["doc_id", "digest", "at"])

    blobs = {"first": "<u8", "second": "<u4", "doc": "<u4", "place": "<i4", "ids": "<i8", "digests": "<i8"}
    own = id_text(docs).filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()) \
        .withColumn("digest", F.xxhash64("text"))
    rows = own.mapInArrow(run, "part int, " + ", ".join(f"{k} binary" for k in blobs))
    # Settled rows (part -1) are dealt out by their content.
    rows = rows.withColumn("part", F.when(F.col("part") < 0, F.pmod(F.xxhash64("digests"), F.lit(parts)).cast("int") + parts)
                           .otherwise(F.col("part")))
    lost = merged(rows, "part", blobs, combine, "part int, ids binary, digests binary, at binary, counts binary", parts)
    return merged(lost, "part", {"ids": "<i8", "digests": "<i8", "at": "<i4", "counts": "<u4"}, gather,
                  "doc_id long, digest long, at binary", parts)


def _change(*columns: bytes) -> np.ndarray:
    """Where a run of equal (id, digest) begins."""
    new = np.zeros(len(columns[0]) // 8, dtype=bool)
    for c in columns:
        x = np.frombuffer(c, "<i8")
        new[1:] |= x[1:] != x[:-1]
    new[:1] = True
    return np.flatnonzero(new)


def remove_repeated(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (the words left, joined by one space) of every row."""
    found = repeated(docs, width=width, gram=gram)
    rows = id_text(docs).withColumn("digest", F.xxhash64("text")).join(found.hint("shuffle_hash"), ["doc_id", "digest"], "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n_words, n_removed, kept = [], [], []
            for text, blobs in zip(as_bytes(batch), batch.column("at").to_pylist()):
                words = text.split() if text else []
                n_words.append(len(words))
                if blobs:
                    at = np.frombuffer(blobs, "<i4")
                    edge = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + width, minlength=len(words) + 1)
                    left = np.cumsum(edge)[:len(words)] <= 0
                    words = [w for w, k in zip(words, left.tolist()) if k]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()),
                                              pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept"])

    return rows.select("doc_id", "text", "at").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")

