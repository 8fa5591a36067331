"""Document fingerprints: every shingle hash below a fixed threshold, and likeness of documents by containment.

A shingle is a run of ``WIDTH`` bytes of the UTF-8 text. A fingerprint keeps all
distinct shingle hashes below ``THRESHOLD`` (a fixed fraction of all hashes, the
same for every document), so a sketch grows with its document, the sketch of a
union is the union of sketches, and the share of a small document's hashes found
in a large one estimates how much of it the large one holds. A text too short to
have ``LEAST`` of them keeps its ``LEAST`` smallest. Each fingerprint says up to
where it is complete; two of them are compared up to where both are, so the
estimate is unbiased for any two lengths.

A fingerprint as text: 16 hex digits of that bound, a colon, and the hashes in
rising order as base64 of little-endian 64-bit numbers.

Defined results: a null text is empty; an empty text has no hash and is like an
empty text (1.0) and nothing else (0.0); a text shorter than a shingle is one
shingle. Documents follow each other by descending id, rows that share an id by
text, null ids last; after the last comes the first, so a single document
follows itself. Repeated rows each stay. Extra columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import U64, give_back, id_text, mix, shuffle_partitions, slices

WIDTH = 8
#: One hash in FRACTION is kept.
FRACTION = 16
THRESHOLD = (1 << 64) // FRACTION
LEAST = 128
ALL = (1 << 64) - 1


def shingle_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the shingle that begins at each byte (its eight bytes as one number, mixed); past the end come zeros."""
    padded = np.concatenate((data, np.zeros(WIDTH, dtype=np.uint8)))
    return mix(np.ndarray((len(data),), dtype="<u8", buffer=padded, strides=(1,)).astype(U64) + U64(1))


def sketches(texts: Sequence[bytes]) -> list[tuple[int, np.ndarray]]:
    """(complete up to, rising hashes) of each text."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    hashes = shingle_hashes(np.frombuffer(b"".join(texts), dtype=np.uint8))
    ends = np.cumsum(sizes)
    low = np.flatnonzero(hashes < U64(THRESHOLD))
    kept = hashes[low]
    first, last = np.searchsorted(low, ends - sizes), np.searchsorted(low, ends - np.minimum(sizes, WIDTH - 1))
    out = []
    for k, (size, end) in enumerate(zip(sizes.tolist(), ends.tolist())):
        if not size:
            out.append((ALL, np.empty(0, dtype=U64)))
        elif size < WIDTH:
            out.append((ALL, shingle_hashes(np.frombuffer(texts[k], dtype=np.uint8))[:1]))
        else:
            found = np.unique(kept[first[k]:last[k]])
            if len(found) >= LEAST:
                out.append((THRESHOLD - 1, found))
                continue
            own = np.unique(hashes[end - size:end - WIDTH + 1])
            out.append((ALL, own) if len(own) <= LEAST else (max(int(own[LEAST - 1]), THRESHOLD - 1), own[:LEAST]))
    return out


def merge(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
    """The sketch of both documents' shingles together, complete as far as both are."""
    bound = min(a[0], b[0])
    both = np.union1d(a[1], b[1])
    return bound, both[both <= U64(bound)]


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of the smaller sketch's hashes that the other has, up to where both are complete."""
    bound = U64(min(a[0], b[0]))
    x, y = a[1][:np.searchsorted(a[1], bound, "right")], b[1][:np.searchsorted(b[1], bound, "right")]
    if not len(x) or not len(y):
        return float(not len(a[1]) and not len(b[1]))
    return len(np.intersect1d(x, y, assume_unique=True)) / min(len(x), len(y))


def as_text(sketch: tuple[int, np.ndarray]) -> str:
    return f"{sketch[0]:016x}:" + base64.b64encode(sketch[1].astype("<u8").tobytes()).decode()


def from_text(fingerprint: str) -> tuple[int, np.ndarray]:
    bound, hashes = fingerprint.split(":")
    return int(bound, 16), np.frombuffer(base64.b64decode(hashes), dtype="<u8").astype(U64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint of every document, where it is read."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(as_text, sketches(texts)), pa.string())],
                                             names=["doc_id", "fingerprint"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


# -- documents beside the next one ------------------------------------------------------
#: Documents whose ids are looked at to cut the order into ranges.
SAMPLE = 20_000
#: Bytes of text that a range should hold.
RANGE_BYTES = 32 << 20

_KEY = "k bigint"


def _range_of(key: Column, cuts: list[int]) -> Column:
    """Number of ``cuts`` (falling) above the key: coarse ones are counted first, then those of one stretch."""
    step = max(1, int(len(cuts) ** 0.5))
    stretches = [cuts[i:i + step] for i in range(0, len(cuts), step)] or [[]]
    longs = lambda xs: F.array(*map(F.lit, xs)).cast("array<bigint>")
    above = lambda xs: F.size(F.filter(xs, lambda c: c > key))
    whole = above(longs([s[-1] for s in stretches if len(s) == step])) if cuts else F.lit(0)
    rest = F.get(F.array(*map(longs, [*stretches, []])), whole)
    return (whole * step + above(rest)).cast("int")


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k, range, guest): rows by falling id in ranges; each range's guests are the rows it continues with.

    The cuts between ranges come from a bounded sample of ids, by hash; each
    range's first id is then found over all rows, and the documents under it are
    sent to the range before as well (of the first range: to the last).
    """
    rows = docs.withColumn("k", F.coalesce("doc_id", F.lit(-(1 << 63))))
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    n = max(shuffle_partitions(docs.sparkSession), -(-total // RANGE_BYTES))
    sample = sorted({r["k"] for r in rows.select("k").orderBy(F.xxhash64("k"), "k").limit(SAMPLE).collect()}, reverse=True)
    cuts = sorted({sample[len(sample) * i // n] for i in range(1, n)}, reverse=True) if sample else []
    rows = rows.withColumn("range", _range_of(F.col("k"), cuts))
    firsts = sorted((r["range"], r["first"]) for r in rows.groupBy("range").agg(F.max("k").alias("first")).collect())
    hosts = [(firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))]                      # at most one a range
    guests = F.broadcast(docs.sparkSession.createDataFrame(hosts, f"{_KEY}, host int"))
    both = rows.join(guests, "k", "left").withColumn("place", F.explode(F.array_compact(F.array(
        F.struct(F.col("range"), F.lit(0).alias("guest")), F.when(F.col("host").isNotNull(), F.struct(F.col("host").alias("range"), F.lit(1).alias("guest")))))))
    return both.select("doc_id", "text", "k", "place.range", "place.guest") \
        .repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions("range", "guest", F.col("k").desc(), "text")


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as many characters from the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every document and the next one."""
    rows = id_text(docs, id_col, text_col)
    rows = in_order(rows.withColumn("text", F.coalesce("text", F.lit(""))))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                     # the last row read: (range, guest, doc_id, text, sketch)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            own = sketches([t.encode() for t in texts])
            rows = ([] if held is None else [held]) + list(zip(batch.column("range").to_pylist(), batch.column("guest").to_pylist(),
                                                               batch.column("doc_id").to_pylist(), texts, own))
            held = rows[-1]
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[1] and a[0] == b[0]]
            changed = [edited(a[3], b[3]) for a, b in pairs]
            data = [t.encode() for t in changed]
            theirs = sketches(data)
            yield pa.RecordBatch.from_arrays([
                pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in data], pa.string()), pa.array([as_text(a[4]) for a, _ in pairs], pa.string()),
                pa.array(map(as_text, theirs), pa.string()), pa.array([likeness(a[4], e) for (a, _), e in zip(pairs, theirs)], pa.float64()),
                pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64())], names=names)
            give_back()

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                "near_edited double, near_next double")
