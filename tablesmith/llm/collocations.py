"""Phrase collocation mining: an FM-index per shard over word ids, n-grams by bidirectional interval extension, sums across shards.

Texts are cut into pieces and words, and their words gathered into shards of one
language and at most ``SHARD`` words. A shard is a sequence of word ids with
breaks (0) between pieces. Its FM-index sorts the places of the sequence by the
words that follow and keeps the word before each (the BWT); a second one does the
same for the sequence read backwards. A phrase is one interval of either;
extending all intervals by the words before (or after) them gives all phrases
that are one word longer, with their counts and their intervals in both. Phrases
have at most four words, so places are sorted by their first four words only:
intervals of phrases up to that length, and all that is done with them here, come
out as in a fully sorted index.

Only what is frequent over all shards is extended. Words are summed first; the
frequent ones get numbers, the others become breaks. Two-word phrases are summed
next, each shard is told which of its own are frequent, and extends those to
three and four words, where every two neighbours must be a frequent pair. Keys
are whole word numbers, so sums never mix two phrases.

Scale: shards bound the memory of a task, sums are dealt by a hash of the phrase
over parts whose number follows the words of the input, after each shard has
counted its own; a phrase meets at most once per shard. Nothing passes through
the driver but two numbers.

Defined results: a null text is empty, a null language ``und``; a null or repeated
id does not matter, every row counts; empty texts and tables give nothing; ties
go to the phrase that comes first in the order of its UTF-8 bytes; extra columns
are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.expressions import col
from tablesmith.llm.common import U64, give_back, in_parts, merged, mix, runs, saved, shuffle_partitions, slices

SHARD = 1 << 21
LEAST, LONGEST, TOP = 30, 4, 2000
#: A phrase goes where a longer one has this share (percent) of its occurrences.
COVERED = 80
#: Words of the input per part that a sum is dealt over.
PART_WORDS = 4 << 20
NO_LANG = "und"

#: Fixed bytes: A-Z lower-cased, ends of pieces to a full stop, tabs to spaces.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(46 if b in _ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: bytes) -> list[bytes]:
    """The words in order, a full stop (which no word has) at each end of a piece."""
    return text.translate(_BYTES).replace(b".", b" . ").split()


# -- the index of a shard ------------------------------------------------------------------
def _order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by the ``depth`` words that begin there (around the end); equal ones keep their order."""
    rank, have = seq, 1
    while True:
        key = rank.astype(np.int64)
        if depth > have:
            key *= int(rank.max()) + 1
            key += np.roll(rank, -have)
        order = np.argsort(key, kind="stable").astype(np.int32)
        have *= 2
        if have >= depth:
            return order
        key = key[order]
        rank = np.empty(len(seq), dtype=np.int32)
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))


class Index:
    """FM-index of a sequence of word ids (0: break) for phrases of up to ``depth`` words: the word before each place, in
    the order of what follows, where each word's places begin, and where a place's predecessor lies."""

    def __init__(self, seq: np.ndarray, depth: int) -> None:
        seq = seq.astype(np.int32)
        order = _order(seq, depth)
        self.before = seq[order - 1]
        self.first = np.searchsorted(seq[order], np.arange(int(seq.max(initial=0)) + 2)).astype(np.int32)
        self.to_before = np.empty(len(seq), dtype=np.int32)
        self.to_before[np.argsort(self.before, kind="stable")] = np.arange(len(seq), dtype=np.int32)

    def extend(self, low: np.ndarray, high: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """Each interval by each word before it: (which interval, the word, low, high, low in the other index)."""
        sizes = high - low
        which = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
        rows = (np.repeat(low, sizes) + runs(sizes)).astype(np.int32)
        key = which * np.int64(int(self.before.max(initial=0)) + 1) + self.before[rows]
        order = np.argsort(key, kind="stable").astype(np.int32)
        key = key[order]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[:len(order)]
        del key
        count = np.diff(np.append(start, len(order))).astype(np.int32)
        at = order[start]                                   # the first row of each, so the first of its new interval
        own, word, to = which[at], self.before[rows[at]], self.to_before[rows[at]]
        # In the other index the rows of an interval are sorted by this very word, breaks first.
        beside = (other[own] + start - (np.cumsum(sizes) - sizes)[own]).astype(np.int32)
        real = word > 0
        return own[real], word[real], to[real], (to + count)[real], beside[real]


def _inside(low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each of ``at`` lies in one of some separate intervals."""
    if not len(low):
        return np.zeros(len(at), dtype=bool)
    order = np.argsort(low)
    k = np.searchsorted(low[order], at, side="right") - 1
    return (k >= 0) & (at < high[order][np.maximum(k, 0)])


def pairs(seq: np.ndarray, index: Index) -> tuple[np.ndarray, ...]:
    """All two-word phrases, by first and second word: (first, second, low, high, low in the other index)."""
    low, high = index.first[1:-1], index.first[2:]
    second, first, lo, hi, beside = index.extend(low, high, low)
    second = second + 1
    order = np.lexsort((second, first))
    return tuple(x[order] for x in (first, second, lo, hi, beside))


def longer(seq: np.ndarray, keep) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases as rows of four words, counts) of three and of four words, in which every two neighbours are a kept pair.

    ``keep(first, second)``: which of the two-word phrases are kept.
    """
    onward, back = Index(seq, LONGEST), Index(seq[::-1], LONGEST)
    first, second, lo, hi, beside = pairs(seq, onward)
    kept = keep(first, second)
    first, second, lo, hi, beside = (x[kept] for x in (first, second, lo, hi, beside))
    ends = beside + hi - lo
    # To the right by the backward index: the last two words lie in one interval of it.
    own, third, blo, bhi, flo = back.extend(beside, ends, lo)
    good = _inside(beside, ends, blo)
    own, third, blo, bhi, flo = (x[good] for x in (own, third, blo, bhi, flo))
    rows = np.stack((first[own], second[own], third, np.zeros_like(third)), axis=1)
    yield rows, bhi - blo
    # To the left by the forward index: the first two words lie in one interval of it.
    own, zeroth, to, end, _ = onward.extend(flo, flo + bhi - blo, blo)
    good = _inside(lo, hi, to)
    own, zeroth, to, end = (x[good] for x in (own, zeroth, to, end))
    yield np.concatenate((zeroth[:, None], rows[own][:, :3]), axis=1), end - to


# -- shards -----------------------------------------------------------------------------------
SHARDS = "shard long, lang string, words array<string>, counts array<long>, n long, low binary, high binary"


def shards(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows of SHARDS: the distinct words with their counts, and the sequence of their numbers from 1 (0: break) in two planes of bytes."""
    def made(lang: str, lists: list[list[bytes]]) -> pa.RecordBatch:
        coded = pa.chunked_array([pa.array(x, pa.binary()) for x in lists]).dictionary_encode().combine_chunks()
        coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
        known, ids = coded.dictionary, np.asarray(coded.indices, dtype=np.int64)
        stop = known.index(pa.scalar(b".", pa.binary())).as_py()
        number = np.arange(1, len(known) + 1)
        number[stop:] -= 1
        number[stop] = 0
        seq = number[ids]
        seq = np.concatenate(([0], seq[np.concatenate(([True], (seq[1:] != 0) | (seq[:-1] != 0)))]))
        counts = np.bincount(seq, minlength=len(known))[1:]
        text = pa.concat_arrays([known[:stop], known[stop + 1:]]).cast(pa.string())
        return pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([lang], pa.string()),
            pa.ListArray.from_arrays(pa.array([0, len(text)], pa.int32()), text), pa.array([counts], pa.list_(pa.int64())),
            pa.array([int(counts.sum())], pa.int64()), pa.array([(seq & 0xFFFF).astype("<u2").tobytes()], pa.binary()),
            pa.array([(seq >> 16).astype("<u2").tobytes()], pa.binary())], names=["shard", "lang", "words", "counts", "n", "low", "high"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[list[bytes]]] = {}
        total = 0
        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                found = words(text)
                for a in range(0, len(found), SHARD):
                    if total >= SHARD:
                        yield from (made(k, v) for k, v in held.items())
                        held, total = {}, 0
                        give_back()
                    part = found[a:a + SHARD]
                    held.setdefault(lang, []).append([*part, b"."])
                    total += len(part)
        yield from (made(k, v) for k, v in held.items())

    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), text.alias("text")).mapInArrow(run, SHARDS)


def _sequence(low: bytes, high: bytes, idx: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence with frequent words only, by a numbering of their own (from 1); and their global numbers."""
    seq = np.frombuffer(low, "<u2").astype(np.int64) | (np.frombuffer(high, "<u2").astype(np.int64) << 16)
    order = np.argsort(idx)
    own = np.zeros(int(seq.max(initial=0)) + 1, dtype=np.int64)
    own[idx[order] + 1] = np.arange(1, len(idx) + 1)
    seq = own[seq]
    seq = seq[np.concatenate(([True], (seq[1:] != 0) | (seq[:-1] != 0)))]
    return np.append(seq, 0) if seq[-1] else seq, np.concatenate(([0], number[order]))


def _shard_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, list | None]]:
    """(shard, sequence, numbers, marks) of each shard with a frequent word."""
    for batch in batches:
        for i in range(batch.num_rows):
            idx, number = (np.asarray(batch.column(c)[i].values, dtype=np.int64) for c in ("idx", "number"))
            seq, numbers = _sequence(batch.column("low")[i].as_py(), batch.column("high")[i].as_py(), idx, number)
            yield batch.column("shard")[i].as_py(), seq, numbers, batch.column("marks")[i].as_py() if "marks" in batch.schema.names else None
            give_back()


def _pair_key(numbers: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (numbers[first].astype(U64) << U64(32)) | numbers[second].astype(U64)


def _part_of(key: np.ndarray, parts: int) -> np.ndarray:
    return (mix(key) % U64(parts)).astype(np.int64)


def _summed(keys: Sequence[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Rows of one or two key columns added up: (place of each row's key, the distinct keys, their sums)."""
    order = np.lexsort(keys[::-1])
    new = reduce(np.logical_or, [np.concatenate(([True], k[order][1:] != k[order][:-1]))[:len(order)] for k in keys])
    start = np.flatnonzero(new)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    sums = np.add.reduceat(counts[order], start) if len(start) else np.empty(0, dtype=np.int64)
    return place, [k[order][start] for k in keys], sums


def _batch(names: Sequence[str], rows: list[tuple], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names=list(names))


# -- counts of all phrases ----------------------------------------------------------------------
def phrase_counts(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, sizes): w1..w4 and f of every phrase of 1 to 4 words with f >= least, as numbers of words (0: none);
    number, lang, word, f of every such word; and lang, n of every language."""
    cut = saved(shards(docs, text_col, lang_col), "phrase-shards")
    sizes = cut.groupBy("lang").agg(F.sum("n").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(shuffle_partitions(docs.sparkSession), -(-total // PART_WORDS))

    # Each word's rows (one per shard that has it) meet once: they get its sum, and its number among the frequent ones.
    deals = 8 * parts
    own = cut.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("idx", "w")) \
        .select("shard", "lang", "idx", F.col("w.words").alias("word"), F.col("w.counts").alias("c")) \
        .withColumn("deal", F.pmod(F.xxhash64("lang", "word"), F.lit(deals))).repartition(F.col("deal"))
    same = Window.partitionBy("deal", "lang", "word")
    frequent = own.withColumn("f", F.sum("c").over(same)).filter(F.col("f") >= least)
    place = F.dense_rank().over(Window.partitionBy("deal").orderBy("lang", "word"))
    frequent = saved(frequent.withColumn("number", (place - 1) * deals + F.col("deal") + 1)
                     .withColumn("first", F.row_number().over(same.orderBy("shard", "idx")) == 1).drop("deal", "c"), "phrase-words")
    if (frequent.agg(F.max("number")).first()[0] or 0) >= 1 << 32:
        raise ValueError("more frequent words than 32 bits number")
    vocabulary = frequent.filter("first").select("number", "lang", "word", "f")
    named = saved(frequent.groupBy("shard").agg(F.collect_list(F.struct("idx", "number")).alias("w"))
                  .select("shard", F.col("w.idx").alias("idx"), F.col("w.number").alias("number")), "phrase-names")
    named = cut.select("shard", "low", "high").join(named, "shard")

    def count_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, seq, numbers, _ in _shard_rows(batches):
            first, second, lo, hi, _ = pairs(seq, Index(seq, 2))
            key = _pair_key(numbers, first, second)
            found = in_parts(_part_of(key, parts), parts, key=key, c=(hi - lo).astype(np.uint32))
            if found:
                yield _batch(["part", "shard", "key", "c"], [(p, np.int64(shard).tobytes(), a["key"], a["c"]) for p, a in found.items()],
                             [pa.int32(), pa.binary(), pa.binary(), pa.binary()])

    def add_pairs(part: int, a: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        place, [keys], sums = _summed([np.concatenate(a["key"])], np.concatenate(a["c"]).astype(np.int64))
        good = sums >= least
        rows, at = [(None, part, None, keys[good].tobytes(), sums[good].tobytes())], 0
        for shard, own in zip(a["shard"], a["key"]):
            rows.append((int(shard[0]), part, np.packbits(good[place[at:at + len(own)]]).tobytes(), None, None))
            at += len(own)
        yield _batch(["shard", "part", "mask", "keys", "sums"], rows, [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])

    counted = named.mapInArrow(count_pairs, "part int, shard binary, key binary, c binary")
    two = saved(merged(counted, "part", {"shard": "<i8", "key": "<u8", "c": "<u4"}, add_pairs,
                       "shard long, part int, mask binary, keys binary, sums binary", parts), "phrase-pairs")
    marks = two.filter(F.col("shard").isNotNull()).groupBy("shard").agg(F.collect_list(F.struct("part", "mask")).alias("marks"))

    def count_longer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, seq, numbers, own in _shard_rows(batches):
            bits = {m["part"]: m["mask"] for m in own}

            def keep(first: np.ndarray, second: np.ndarray) -> np.ndarray:
                part = _part_of(_pair_key(numbers, first, second), parts)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                kept = np.zeros(len(first), dtype=bool)
                for p, mask in bits.items():
                    at = order[cuts[p]:cuts[p + 1]]
                    kept[at] = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(at)).astype(bool)
                return kept

            for rows, count in longer(seq, keep):
                one, two = _pair_key(numbers, rows[:, 0], rows[:, 1]), _pair_key(numbers, rows[:, 2], rows[:, 3])
                found = in_parts(_part_of(one * U64(31) + two, parts), parts, one=one, two=two, c=count.astype(np.uint32))
                if found:
                    yield _batch(["part", "one", "two", "c"], [(p, a["one"], a["two"], a["c"]) for p, a in found.items()],
                                 [pa.int32(), pa.binary(), pa.binary(), pa.binary()])

    def add_longer(part: int, a: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        _, [one, two], sums = _summed([np.concatenate(a["one"]), np.concatenate(a["two"])], np.concatenate(a["c"]).astype(np.int64))
        good = sums >= least
        yield _phrases(one[good], two[good], sums[good])

    counted = named.join(marks, "shard").mapInArrow(count_longer, "part int, one binary, two binary, c binary")
    three = merged(counted, "part", {"one": "<u8", "two": "<u8", "c": "<u4"}, add_longer, PHRASES, parts)

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, sums in zip(batch.column("keys").to_pylist(), batch.column("sums").to_pylist()):
                keys = np.frombuffer(keys, "<u8")
                yield _phrases(keys, np.zeros_like(keys), np.frombuffer(sums, "<i8"))

    pair_rows = two.filter(F.col("shard").isNull()).select("keys", "sums").mapInArrow(unpack, PHRASES)
    none = F.lit(0).cast("long")
    one_word = vocabulary.select(F.col("number").alias("w1"), none.alias("w2"), none.alias("w3"), none.alias("w4"), "f")
    return saved(one_word.unionAll(pair_rows).unionAll(three), "phrases"), vocabulary, sizes


PHRASES = "w1 long, w2 long, w3 long, w4 long, f long"


def _phrases(one: np.ndarray, two: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    low = U64(0xFFFFFFFF)
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (one >> U64(32), one & low, two >> U64(32), two & low, sums)],
                                      names=["w1", "w2", "w3", "w4", "f"])


# -- collocations -----------------------------------------------------------------------------------
W = ["w1", "w2", "w3", "w4"]


def _run(a: int, b: int) -> list[Column]:
    """Words a to b - 1 of the phrase, filled up with 0."""
    return [F.col(W[a + i]) if a + i < b else F.lit(0).cast("long") for i in range(4)]


def _part(a: int, b: int, **more: Column) -> Column:
    return F.struct(*[c.alias(f"p{i + 1}") for i, c in enumerate(_run(a, b))], *[c.alias(n) for n, c in more.items()])


def _of_length(by_length: dict[int, list[Column]]) -> Column:
    """Those of the phrase's own number of words (3: w3 is there and w4 is not)."""
    four, three = F.col("w4") > 0, F.col("w3") > 0
    return F.when(four, F.array(*by_length[4])).when(three, F.array(*by_length[3])).otherwise(F.array(*by_length[2]))


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of 2 to 4 words."""
    phrases, vocabulary, sizes = phrase_counts(docs, least, text_col, lang_col)
    candidates = phrases.filter(F.col("w2") > 0)

    # Every way to cut a candidate in two; both parts are phrases of the table, for they are at least as frequent.
    cuts = _of_length({m: [_part(*ends, k=F.lit(k), left=F.lit(left)) for k in range(1, m) for left, ends in ((True, (0, k)), (False, (k, m)))]
                       for m in (2, 3, 4)})
    parts = candidates.select(*W, F.col("f").alias("a"), F.explode(cuts).alias("p")).select(*W, "a", "p.*")
    known = phrases.toDF("p1", "p2", "p3", "p4", "f")
    cut = parts.join(known, ["p1", "p2", "p3", "p4"]).groupBy(*W, "a", "k") \
        .agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    cut = cut.withColumn("exact", _exact(F.col("a")) * 2_000_000).withColumn("both", _exact(F.col("l")) + _exact(F.col("r")))
    scored = cut.groupBy(*W, "a").agg(F.min(F.struct(F.expr("exact div both").alias("score"), "k", "l", "r")).alias("s")) \
        .select(*W, "a", "s.score", "s.l", "s.r")

    # The most frequent longer candidate around each phrase.
    inner = _of_length({2: [_part(0, 2)], 3: [_part(0, 2), _part(1, 3)],
                        4: [_part(a, a + n) for n in (2, 3) for a in range(4 - n + 1)]})
    around = candidates.filter(F.col("w3") > 0).select("f", F.explode(inner).alias("p")).groupBy("p").agg(F.max("f").alias("longest")) \
        .select(*[F.col(f"p.p{i + 1}").alias(w) for i, w in enumerate(W)], "longest")
    free = scored.join(around, W, "left").filter(
        F.col("longest").isNull() | (_exact(F.col("longest")) * 100 < _exact(F.col("a")) * covered)).drop("longest")

    # First by score and count with all ties, in salted groups and then by language; words are fetched for what is left.
    free = free.join(vocabulary.select(F.col("number").alias("w1"), "lang"), "w1")
    for group in (["lang", F.pmod(F.xxhash64(*W), F.lit(64))], ["lang"]):
        by = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("a").desc())
        free = free.withColumn("rank", F.rank().over(by)).filter(F.col("rank") <= top).drop("rank")
    free = saved(free, "collocations")
    word = free.select(*W, F.posexplode(F.array(*W)).alias("place", "number")).filter(F.col("number") > 0) \
        .join(vocabulary.select("number", "word"), "number").groupBy(*W).agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
    named = free.join(word, W).withColumn("phrase", F.array_join(F.col("words.word"), " "))
    by = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return named.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top).join(sizes, "lang") \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
