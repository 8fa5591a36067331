"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

The set of a document is its distinct five-word shingles, as sorted 64-bit
hashes. Documents with one set are one node (a class), so copies are never
compared. Sets that are similar enough must share ``k`` of the first
``n - ceil(0.75 n) + k`` shingles of any common order of all shingles; with
``k`` growing with the set, one that meets others too seldom is no candidate.
The order used puts frequent shingles last (a fixed-size count sketch over all
documents tells how frequent), so a line or passage that a third of the corpus
holds is not a meeting point. A tile is what meets at one shingle: its members,
sorted by size, are compared only within the size band that the threshold allows.

Links are wanted up to connectivity (every class's component), so a tile first
pairs each member with the first member of its band: as many pairs as members.
A pair is checked by its signatures first: the bits that one has and the other
lacks bound the overlap from above. What passes is intersected exactly. Large
tiles that still hold several components are searched in a few turns, each
member against the next few of an order, which joins what is densely linked.
Tiles that are mixed even then are gone through pair by pair, in blocks of
bounded size, leaving out pairs whose members are connected and those that the
signatures exclude. So no link between different components is lost, whatever
the size of a tile, and a group of near copies is not expanded into all its pairs.

Defined results: texts without words and null texts have an empty set, link
with nothing, and are their own component; a null id is no node: such a row
gets the component of the rows with the same set, if any; rows that share an id
are one node each per set, joined under that id; extra columns are ignored.
Set digests have 64 bits.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import (MAX_ID_BYTES, U64, as_bytes, id_text, in_parts, merged, mix, saved, saved_for_join,
                                   saved_measured, shuffle_partitions, slice_words, slices, window_hashes, without_ids)
from tablesmith.llm.components import connected

WIDTH = 5
#: The similarity as a fraction, so that the test is exact in integers.
NUMERATOR, DENOMINATOR = 3, 4
CELLS, RANGES = 1 << 22, 64
SIGNATURE_SHARE = 4
#: Members of a block when a tile is gone through pair by pair.
BLOCK = 512
#: Turns in which large tiles of several components are searched for links along an order, and neighbours tried in each.
TURNS, NEXT = 2, 8
#: Bytes of sets or signatures that a join with pairs may broadcast, measured before it does.
SMALL_SETS = 16 << 20
#: Members of a tile whose pairs are all tried at once.
SMALL = 64
#: One meeting more is asked for per so many shingles of a set; prefixes are longer by as much.
MEETING_SHARE = 16


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> list[np.ndarray]:
    """Per text, its sorted distinct shingle hashes."""
    words, starts = slice_words(texts, lower=True)
    hashes = window_hashes(words, width)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        n = b - a
        own = hashes[a:b - width + 1] if n >= width else window_hashes(words[a:b], n) if n else hashes[:0]
        own = np.sort(own)
        out.append(own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) else own)
    return out


def set_key(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) & U64(CELLS - 1)).astype(np.int64)


def _classes_and_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, key) of every row, and the partitions' shingle counts by cell range; one pass over the texts."""
    per_range = CELLS // RANGES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(CELLS, dtype=np.uint32), set()
        for batch in slices(batches):
            sets = shingle_sets(as_bytes(batch))
            keys = [set_key(s) if len(s) else None for s in sets]
            fresh = [s for s, k in zip(sets, keys) if k is not None and k not in seen]
            if len(seen) < 1 << 16:
                seen.update(k for k in keys if k is not None)
            if fresh:
                np.add.at(counts, _cell(np.concatenate(fresh)), 1)
            n = len(sets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array(keys, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                                             names=["doc_id", "n", "key", "part", "counts"])
        # A byte per cell: a task's count beyond 255 says no more than that the shingle is frequent.
        own = [(p, np.minimum(c, 255).astype(np.uint8)) for p, c in enumerate(counts.reshape(RANGES, per_range)) if c.any()]
        if own:
            n = len(own)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                                              pa.array([p for p, _ in own], pa.int32()),
                                              pa.array([c.tobytes() for _, c in own], pa.binary())],
                                             names=["doc_id", "n", "key", "part", "counts"])

    both = saved(id_text(docs).mapInArrow(run, "doc_id long, n long, key long, part int, counts binary"), "sets")
    return (both.filter(F.col("part").isNull()).select("doc_id", "n", "key"),
            both.filter(F.col("part").isNotNull()).select("part", "counts"))


def _frequency(counts: DataFrame) -> np.ndarray:
    """How frequent the shingles of each cell are, as the number of binary digits of the cell's count (CELLS bytes)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, blob in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                total[p] = total.get(p, 0) + np.frombuffer(blob, np.uint8).astype(np.int64)
        if total:
            digits = [np.ceil(np.log2(c + 1.0)).astype(np.uint8).tobytes() for c in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(digits, pa.binary())],
                                             names=["part", "digits"])

    out, size = np.zeros(CELLS, dtype=np.uint8), CELLS // RANGES
    for r in counts.repartitionById(RANGES, F.col("part")).mapInArrow(run, "part int, digits binary").collect():
        out[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["digits"], np.uint8)
    return out


def _tiles(docs: DataFrame, frequency: np.ndarray) -> tuple[DataFrame, int]:
    """What meets at a shingle, and how many rows that is: rows of kind 0 are pairs (a, b) to check, rows of kind 1 members (tile, key, n) of a tile."""
    spark = docs.sparkSession
    shared, parts = spark.sparkContext.broadcast(frequency), shuffle_partitions(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = {set_key(s): s for s in shingle_sets(as_bytes(batch)) if len(s)}
            if not sets:
                continue
            firsts = []
            for own in sets.values():
                most = len(own) - overlap_with_any(len(own)) + meetings(len(own))
                firsts.append(own[np.argsort(shared.value[_cell(own)], kind="stable")[:most]])
            keys, sizes = np.array(list(sets), dtype=np.int64), np.array([len(s) for s in sets.values()], dtype=np.uint32)
            meet = np.concatenate(firsts)
            owner = np.repeat(np.arange(len(keys), dtype=np.uint32), [len(f) for f in firsts])
            part = (mix(meet ^ U64(0x2545F4914F6CDD1D)) % U64(parts)).astype(np.int64)
            rows = {"part": [], "meet": [], "owner": [], "keys": [], "sizes": []}
            for p, found in in_parts(part, parts, meet=meet, owner=owner).items():
                used, back = np.unique(np.frombuffer(found["owner"], np.uint32), return_inverse=True)
                for k, v in (("part", p), ("meet", found["meet"]), ("owner", back.astype(np.uint32).tobytes()),
                             ("keys", keys[used].tobytes()), ("sizes", sizes[used].tobytes())):
                    rows[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows["part"], pa.int32()),
                                              *[pa.array(rows[k], pa.binary()) for k in list(rows)[1:]]], names=list(rows))

    def combine(part: int, found: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        shift = np.cumsum([0] + [len(k) for k in found["keys"]])[:-1]
        row = np.concatenate([o + s for o, s in zip(found["owner"], shift)]).astype(np.int64)
        meet, keys = np.concatenate(found["meet"]), np.concatenate(found["keys"])
        sizes = np.concatenate(found["sizes"]).astype(np.int64)
        # Only shingles that are met more than once.
        order = np.argsort(meet, kind="stable")
        again = np.zeros(len(meet), dtype=bool)
        again[1:] = meet[order[1:]] == meet[order[:-1]]
        again[:-1] |= again[1:]
        order = order[again]
        meet, key, size = meet[order], keys[row[order]], sizes[row[order]]
        order = np.lexsort((key, size, meet))
        meet, key, size = meet[order], key[order], size[order]
        new = np.ones(len(meet), dtype=bool)
        new[1:] = (meet[1:] != meet[:-1]) | (key[1:] != key[:-1])
        meet, key, size = meet[new], key[new], size[new]
        begin = np.flatnonzero(np.diff(meet, prepend=meet[:1] ^ U64(1)) != 0) if len(meet) else np.empty(0, np.int64)
        members = np.diff(np.append(begin, len(meet)))
        tile = np.repeat(np.arange(len(begin)), members)
        # The first member of each one's band: the smallest whose size the threshold allows.
        place = np.arange(len(meet))
        bound = -(-size * NUMERATOR // DENOMINATOR)
        at = np.searchsorted(tile * (1 << 32) + size, tile * (1 << 32) + bound) if len(meet) else place
        pairs = np.unique(np.stack((key[at], key[place]), axis=1)[at < place], axis=0) if len(meet) else np.empty((0, 2), np.int64)
        pairs.sort(axis=1)
        yield from _rows(0, pairs[:, 0], pairs[:, 1], np.zeros(len(pairs), np.int64))
        # How often each set meets one of its band, sent on by key.
        if len(meet):
            follows = np.zeros(len(meet), dtype=bool)
            follows[1:] = (tile[1:] == tile[:-1]) & (size[:-1] * DENOMINATOR >= size[1:] * NUMERATOR)
            follows[:-1] |= follows[1:]
            met, at_first, times = np.unique(key[follows], return_index=True, return_counts=True)
            to = (mix(met.view(U64)) % U64(parts)).astype(np.int64)
            yield from _rows(2, *_columns(in_parts(to, parts, keys=met, sizes=size[follows][at_first].astype(np.uint32),
                                                   times=times.astype(np.uint32))))
        # Tiles of three and more, each distinct list of members once.
        if len(begin):
            mixed = mix(key.view(U64))
            name = mix(np.add.reduceat(mixed, begin) + members.astype(U64))
            _, first = np.unique(name, return_index=True)
            chosen = np.zeros(len(begin), dtype=bool)
            chosen[first[members[first] > 2]] = True
            keep = np.repeat(chosen, members)
            yield from _rows(1, np.repeat(name, members)[keep].view(np.int64), key[keep], size[keep])

    def _columns(found: dict[int, dict[str, bytes]]) -> list:
        none = np.zeros(len(found), np.int64)
        return [np.array(list(found), np.int64), none, none, *[[x[k] for x in found.values()] for k in ("keys", "sizes", "times")]]

    def _rows(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, *blobs: list) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(a), 1 << 16):
            cut = slice(i, i + (1 << 16))
            own = [pa.array(x[cut], pa.binary()) for x in blobs] or [pa.nulls(len(a[cut]), pa.binary())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a[cut]), kind, np.int32)), pa.array(a[cut]), pa.array(b[cut]),
                                              pa.array(n[cut]), *own], names=["kind", "a", "b", "n", "keys", "sizes", "times"])

    blobs = {"meet": "<u8", "owner": "<u4", "keys": "<i8", "sizes": "<u4"}
    texts = id_text(docs).filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = texts.mapInArrow(run, "part int, " + ", ".join(f"{k} binary" for k in blobs))
    return saved_measured(merged(rows, "part", blobs, combine,
                                 "kind int, a long, b long, n long, keys binary, sizes binary, times binary", parts),
                          "tiles")[:2]


def overlap_with_any(n: int):
    """The least overlap of a set of ``n`` with any set that it is similar enough to."""
    return -(-n * NUMERATOR // DENOMINATOR)


def meetings(n):
    """How many of their first shingles two similar sets, the smaller one of size ``n``, meet at when the prefixes allow for it."""
    return 1 + n // MEETING_SHARE


def _meet_enough(met: DataFrame) -> DataFrame:
    """(key) of the sets that meet sets of their band often enough to be similar to one of them."""
    parts = shuffle_partitions(met.sparkSession)

    def gather(part: int, found: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, first, back = np.unique(np.concatenate(found["keys"]), return_index=True, return_inverse=True)
        times = np.bincount(back, weights=np.concatenate(found["times"]))
        size = np.concatenate(found["sizes"]).astype(np.int64)[first]
        yield pa.RecordBatch.from_arrays([pa.array(keys[times >= meetings(overlap_with_any(size))])], names=["key"])

    blobs = {"keys": "<i8", "sizes": "<u4", "times": "<u4"}
    rows = met.filter("kind = 2").select(F.col("a").cast("int").alias("part"), *blobs)
    return saved_for_join(merged(rows, "part", blobs, gather, "key long", parts), "candidates", 8, MAX_ID_BYTES)


def signature(own: np.ndarray) -> bytes:
    """One bit per shingle hash, in a width that grows with the set: a power of two, SIGNATURE_SHARE bits a shingle or more."""
    width = max(64, 1 << int(SIGNATURE_SHARE * len(own) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[own & U64(width - 1)] = True
    return np.packbits(bits).tobytes()


def most_overlap(bits_a: bytes, bits_b: bytes, n_a: int, n_b: int) -> int:
    """The overlap's upper bound: each bit that one set has and the other lacks is a shingle outside it."""
    a, b = sorted((np.frombuffer(bits_a, np.uint8), np.frombuffer(bits_b, np.uint8)), key=len)
    n_small, n_large = (n_a, n_b) if len(bits_a) <= len(bits_b) else (n_b, n_a)
    b = np.bitwise_or.reduce(b.reshape(-1, len(a)), axis=0)     # the wider one, folded to the narrower one's width
    return min(n_small - int(np.bitwise_count(a & ~b).sum()), n_large - int(np.bitwise_count(b & ~a).sum()))


def least_overlap(n_a, n_b):
    """The overlap that the similarity asks for: ceil(t (n_a + n_b) / (1 + t))."""
    return -(-(n_a + n_b) * NUMERATOR // (NUMERATOR + DENOMINATOR))


def _linked(pairs: DataFrame, n_pairs: int, signatures: DataFrame, docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, int]:
    """The pairs (a, b) whose sets are similar enough, and how many: signature bound first, exact intersection of what it passes."""
    def kept(batches: Iterable[pa.RecordBatch], ok) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = zip(*(batch.column(c).to_pylist() for c in ("set_a", "set_b", "n_a", "n_b")))
            yield batch.filter(pa.array([ok(*x) for x in own], pa.bool_())).select(["a", "b"])

    def bounded(batches):
        return kept(batches, lambda x, y, m, n: most_overlap(x, y, m, n) >= least_overlap(m, n))

    def exact(batches):
        return kept(slices(batches, "set_a"), lambda x, y, m, n: len(np.intersect1d(
            np.frombuffer(x, U64), np.frombuffer(y, U64), assume_unique=True)) >= least_overlap(m, n))

    def with_sets(both: DataFrame, most: int, sets: DataFrame, check) -> tuple[DataFrame, int]:
        for c in "ab":
            both = both.join(sets.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.col("set").alias(f"set_{c}")), c)
        found = both.select("a", "b", "n_a", "n_b", "set_a", "set_b").mapInArrow(check, "a long, b long").distinct()
        return saved_measured(found, "checked-pairs", rows=most)[:2]

    passed, n_passed = with_sets(pairs, n_pairs, signatures, bounded)
    return with_sets(passed, n_passed, _sets_of(docs, classes, _keys(passed), 2 * n_passed, np.ndarray.tobytes), exact)


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()


def _sets_of(docs: DataFrame, classes: DataFrame, keys: DataFrame, n_keys: int, form) -> DataFrame:
    """(key, n, set) of the classes ``keys``, each from its document with the smallest id; ``form`` makes the bytes."""
    reps = saved_for_join(classes.join(keys, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id")),
                          "representatives", 16, MAX_ID_BYTES, n_keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [(k, s) for k, s in zip(batch.column("key").to_pylist(), shingle_sets(as_bytes(batch)))
                    if len(s) and set_key(s) == k]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sets], pa.int64()), pa.array([len(s) for _, s in sets], pa.int64()),
                                              pa.array([form(s) for _, s in sets], pa.binary())], names=["key", "n", "set"])

    return saved_for_join(id_text(docs).join(reps, "doc_id").select("key", "text").mapInArrow(run, "key long, n long, set binary"),
                          "candidate-sets", F.length("set"), SMALL_SETS)


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(tile, key, n, label, m) of the tiles that hold several components, of m members."""
    labelled = members.join(labels.withColumnRenamed("node", "key"), "key", "left") \
        .select("tile", "key", "n", F.coalesce("label", "key").alias("label"))
    mixed = labelled.groupBy("tile").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m")) \
        .filter("lo <> hi").select("tile", "m")
    return labelled.join(mixed, "tile")


def _in_runs(rows: DataFrame, by: list[str], names: list[str], work) -> DataFrame:
    """``work(arrays)`` -> pairs (2, k), of each run of rows with equal ``by``; runs of bounded size, held one at a time."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            if batch is None and held is None:
                return
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in [*by, *names]] if batch is not None else held
            if batch is not None and held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            new = np.ones(len(rows[0]), dtype=bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in rows[:len(by)]], axis=0)
            begin = np.append(np.flatnonzero(new), len(new))
            last = len(begin) - (1 if batch is None else 2)     # the last run may go on in the next batch
            found = [work(*(x[a:b] for x in rows)) for a, b in zip(begin[:last].tolist(), begin[1:last + 1].tolist())]
            held = [x[begin[last]:] for x in rows]
            pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((2, 0), np.int64)
            to = (mix(pairs[0].view(U64) ^ mix(pairs[1].view(U64))) % U64(parts)).astype(np.int64)
            packed = in_parts(to, parts, a=pairs[0], b=pairs[1])
            yield pa.RecordBatch.from_arrays([pa.array(list(packed), pa.int32()), *[pa.array([x[c] for x in packed.values()], pa.binary())
                                                                                  for c in "ab"]], names=["part", "a", "b"])

    def once(part: int, found: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        pairs = np.unique(np.stack([np.concatenate(found[c]) for c in "ab"]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    # A pair may come up in many tiles: pairs travel packed, and each becomes a row once.
    parts = shuffle_partitions(rows.sparkSession)
    ordered = rows.repartition(*[F.col(c) for c in by]).sortWithinPartitions(*by).select(*by, *names)
    return merged(ordered.mapInArrow(run, "part int, a binary, b binary"), "part", {"a": "<i8", "b": "<i8"}, once, "a long, b long", parts)


def _ordered(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.stack((np.minimum(x, y), np.maximum(x, y)))


def _in_band(n_x, n_y):
    return (n_x * DENOMINATOR >= n_y * NUMERATOR) & (n_y * DENOMINATOR >= n_x * NUMERATOR)


def _near_pairs(mixed: DataFrame, turn: int) -> DataFrame:
    """Each member, in one of its tiles, with its next NEXT ones there in an order that changes with ``turn``, if components differ.

    A member goes to that of its tiles which a hash puts first: members with
    nearly the same tiles mostly choose the same one. The order is cut into
    blocks, so that a tile of any size is dealt out.
    """
    one = mixed.groupBy("key").agg(F.min(F.struct(F.xxhash64("tile", F.lit(turn)).alias("h"), "tile", "n", "label", "m")).alias("s")) \
        .select("key", "s.tile", "s.n", "s.label", "s.m")
    blocked = one.withColumn("place", F.xxhash64("key", F.lit(turn))) \
        .withColumn("block", F.shiftrightunsigned("place", 24) % F.ceil(F.col("m") / (8 * BLOCK)))

    def work(tile, block, key, n, label, at) -> np.ndarray:
        order = np.argsort(at, kind="stable")
        key, n, label = key[order], n[order], label[order]
        found = [np.empty((2, 0), np.int64)]
        for step in range(1, min(NEXT, len(key) - 1) + 1):
            ok = (label[step:] != label[:-step]) & (key[step:] != key[:-step]) & _in_band(n[step:], n[:-step])
            found.append(_ordered(key[step:][ok], key[:-step][ok]))
        return np.concatenate(found, axis=1)

    return _in_runs(blocked, ["tile", "block"], ["key", "n", "label", "place"], work)


def _all_pairs(mixed: DataFrame, signatures: DataFrame) -> DataFrame:
    """Every pair of members of a mixed tile in different components that size band and signatures let through.

    A tile goes through in pairs of blocks of about BLOCK members.
    """
    rows = mixed.join(signatures.select("key", F.col("set").alias("bits")), "key") \
        .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")) \
        .withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def work(tile, i, j, key, n, label, own, bits) -> np.ndarray:
        width = min(map(len, bits))         # all signatures folded to one width, to compare a member with a block at once
        folded = np.stack([np.bitwise_or.reduce(np.frombuffer(b, np.uint8).reshape(-1, width), axis=0) for b in bits])
        left, right = np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])
        found = [np.empty((2, 0), np.int64)]
        for x in left:
            y = right[right > x] if i[0] == j[0] else right
            y = y[(label[y] != label[x]) & (key[y] != key[x]) & _in_band(n[x], n[y])]
            if not len(y):
                continue
            least = least_overlap(n[x], n[y])
            y = y[(n[x] - np.bitwise_count(folded[x] & ~folded[y]).sum(axis=1, dtype=np.int64) >= least)
                  & (n[y] - np.bitwise_count(folded[y] & ~folded[x]).sum(axis=1, dtype=np.int64) >= least)]
            y = y[[most_overlap(bits[x], bits[k], int(n[x]), int(n[k])) >= least_overlap(int(n[x]), int(n[k])) for k in y]] if len(y) else y
            found.append(_ordered(np.full(len(y), key[x]), key[y]))
        return np.concatenate(found, axis=1)

    return _in_runs(rows, ["tile", "i", "j"], ["key", "n", "label", "own", "bits"], work)


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    classes, counts = _classes_and_counts(docs)
    met, n_met = _tiles(docs, _frequency(counts))
    enough = _meet_enough(met)

    def of_candidates(rows: DataFrame, c: str) -> DataFrame:
        return rows.join(enough.select(F.col("key").alias(c)), c, "left_semi")

    stars = of_candidates(of_candidates(met.filter("kind = 0").select("a", "b"), "a"), "b").select("a", "b").distinct()
    checked, n_checked, _ = saved_measured(stars, "stars", rows=n_met)
    members = of_candidates(met.filter("kind = 1").select(F.col("a").alias("tile"), F.col("b").alias("key"), "n"), "key")
    members, n_members, _ = saved_measured(members.select("tile", "key", "n").distinct(), "members", rows=n_met)
    keys = _keys(checked).union(members.select("key")).distinct()
    signatures = _sets_of(docs, classes, keys, 2 * n_checked + n_members, signature)
    links, n_links = _linked(checked, n_checked, signatures, docs, classes)
    labels = connected(links, n_links)
    for turn in range(TURNS + 1):
        mixed, _, n_large = saved_measured(_mixed(members, labels), "mixed-tiles", (F.col("m") > SMALL).cast("long"), n_members)
        last = turn == TURNS or not n_large         # small tiles need no search: all their pairs are few
        more = _all_pairs(mixed, signatures) if last else _near_pairs(mixed.filter(F.col("m") > SMALL), turn)
        more, n_more, _ = saved_measured(more.join(checked, ["a", "b"], "left_anti"), "further-pairs", rows=NEXT * n_members)
        if n_more:
            further, n_further = _linked(more, n_more, signatures, docs, classes)
            checked = checked.unionAll(more)
            if n_further:
                links, n_links = links.unionAll(further), n_links + n_further
                labels = connected(links, n_links)
        if last:
            break
    own = classes.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("least"))
    labelled = own.join(labels.withColumnRenamed("node", "key"), "key", "left") \
        .select("key", "least", F.coalesce("label", "key").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_key = labelled.join(smallest, "label").select("key", "component_id")
    return classes.join(by_key, "key", "left").select("doc_id", F.col("n").alias("n_shingles"),
                                                      F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that another row of their component, with a smaller id, stands for.

    Rows with a null id stay; rows that repeat the id and the set of the one that stays, stay too.
    """
    return without_ids(docs, components(docs).filter(F.col("doc_id") != F.col("component_id")).select("doc_id"))

