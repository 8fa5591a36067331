"""Fingerprints, collocations, exact top-k and hard negatives against brute force, with their edge cases."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablesmith.llm import collocations, fingerprints, negatives, queries, topk, vectors
from tests.llm import brute

SF01 = "/root/testdata/sf0.01"
ROWS = "vec_id long, embedding array<double>, label long"


# -- fingerprints ---------------------------------------------------------------------------
def check_pairs(got, order):
    """``order``: (doc_id, text) as the documents follow each other."""
    got = sorted(map(repr, got))
    want = []
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        changed = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        own, theirs, after = fingerprints.sketches([t.encode() for t in (text, changed, following)])
        want.append(repr((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprints.as_text(own), fingerprints.as_text(theirs),
                          fingerprints.likeness(own, theirs), fingerprints.likeness(own, after))))
    assert got == sorted(want)


def test_fingerprints_of_the_whole_table(spark):
    t = pd.read_parquet(f"{SF01}/documents.parquet").sort_values("doc_id", ascending=False)
    got = queries.op11_fingerprints(spark, SF01).collect()
    check_pairs([tuple(r) for r in got], list(zip(t.doc_id.tolist(), t.text.tolist())))
    texts = dict(zip(t.doc_id.tolist(), t.text.tolist()))
    off = []
    for r in got:
        a = brute.byte_shingles(texts[r.doc_id])
        below = [i for i in texts if i < r.doc_id]
        b = brute.byte_shingles(texts[max(below or texts)])
        off.append(abs(len(a & b) / max(1, min(len(a), len(b))) - r.near_next))
        assert r.near_edited > 0.2 or r.n_chars < 40      # half of each text is left
    assert np.mean(off) < 0.02 and max(off) < 0.35


def test_a_sketch_keeps_every_low_hash():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdé ") for _ in range(n)).encode() for n in (0, 1, 7, 8, 9, 70, 76, 400, 5000, 90_000)]
    together = fingerprints.sketches(texts)
    for text, (bound, hashes) in zip(texts, together):
        alone = fingerprints.sketches([text])[0]
        assert bound == alone[0] and np.array_equal(hashes, alone[1])            # a neighbour in the batch changes nothing
        every = np.unique(fingerprints.shingle_hashes(np.frombuffer(text, np.uint8))[:max(1, len(text) - 7)]) if text else np.empty(0, np.uint64)
        assert np.array_equal(hashes, every[every <= np.uint64(bound)])
        assert len(hashes) >= min(len(every), fingerprints.LEAST)
        assert bound >= fingerprints.THRESHOLD - 1
        again = fingerprints.from_text(fingerprints.as_text((bound, hashes)))
        assert again[0] == bound and np.array_equal(again[1], hashes)
    long, half = together[-1], fingerprints.sketches([texts[-1][:45_000]])[0]
    assert fingerprints.likeness(long, half) == 1.0                              # containment, whatever the lengths
    a, b = fingerprints.sketches([texts[-1][:50_000], texts[-1][40_000:]])
    bound, hashes = fingerprints.merge(a, b)
    assert bound == long[0] and np.array_equal(hashes, long[1])


def test_fingerprint_edges(spark):
    long = "".join(random.Random(3).choices("abcdefgh \n", k=700_000))
    rows = [(9, "some text that is long enough for shingles"), (8, None), (7, ""), (6, "ab"), (5, "é" * 50), (4, long), (3, long),
            (2, "same id, first"), (2, "same id, second"), (2, "same id, second"), (None, "no id"), (-5, "below zero")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k", F.lit(1)).withColumn("range", F.lit("x")) \
        .withColumn("guest", F.lit(2)).withColumn("host", F.lit(3)).repartition(5)
    got = fingerprints.edited_pairs(docs).collect()
    order = [(9, rows[0][1]), (8, ""), (7, ""), (6, "ab"), (5, "é" * 50), (4, long), (3, long), *rows[7:10], (-5, "below zero"), (None, "no id")]
    check_pairs([tuple(r) for r in got], order)
    by = {r.doc_id: r for r in got}
    assert by[8].near_edited == by[8].near_next == 1.0 and by[6].near_next == 0.0 and by[4].near_next == 1.0
    assert by[4].fingerprint == by[3].fingerprint
    one = docs.filter("doc_id = 9")
    check_pairs([tuple(r) for r in fingerprints.edited_pairs(one).collect()], [(9, rows[0][1])])
    assert fingerprints.edited_pairs(docs.filter("doc_id = 77")).count() == 0
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs.filter("doc_id > 2")).collect()}
    assert plain == {i: by[i].fingerprint for i in plain} and len(plain) == 7


# -- collocations -------------------------------------------------------------------------------
def found_phrases(df):
    return {(r.lang, r.phrase): (r["rank"], r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def test_collocations_over_many_shards(spark, monkeypatch):
    """Tiny shards and parts, overlapping repeats, ties, odd bytes, several languages."""
    monkeypatch.setattr(collocations, "SHARD", 300)
    monkeypatch.setattr(collocations, "PART_WORDS", 500)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(25)] + ["A", "a", "é", "\x01low", "x\x1cy", "...", "a b"]
    rows = []
    for k in range(220):
        own = [words[min(int(rng.expovariate(0.15)), len(words) - 1)] for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            own[:0] = rng.choice([["w1"] * 7, ["big", "red", "fox", "runs"], ["a", "b"]])
        rows.append((k, "".join(w + rng.choice([" ", "  ", "\t", ", ", " ", " ", ".\n", "\r\n"]) for w in own), rng.choice(["en", "en", "de", None])))
    rows += [(500, None, "en"), (501, "", "xx"), (502, " .,; \t", "xx"), (None, "lone words here", "yy"), (500, "repeated row " * 40, "en"), (500, "repeated row " * 40, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("w1", F.lit(1)).withColumn("shard", F.lit("s")) \
        .withColumn("n", F.lit(0)).repartition(6)
    for least, top in ((4, 2000), (2, 15)):
        got = found_phrases(collocations.collocations(docs, least=least, top=top))
        assert got == brute.collocations([(lang, text) for _, text, lang in rows], least, top) and len(got) > 30
    assert collocations.collocations(docs.filter("doc_id = 501")).count() == 0
    assert collocations.collocations(docs.filter("false")).count() == 0


def test_one_very_long_text(spark):
    rng = random.Random(2)
    text = " ".join(f"w{min(int(rng.expovariate(0.02)), 400)}" + ("." if rng.random() < 0.1 else "") for _ in range(120_000))
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    assert found_phrases(collocations.collocations(docs)) == brute.collocations([("en", text)])


def test_the_index_finds_every_phrase():
    rng = np.random.default_rng(4)
    seq = rng.integers(0, 5, 400)
    seq = np.concatenate(([0], seq[(seq != 0) | (np.roll(seq, 1) != 0)], [0]))
    index = collocations.Index(seq, 4)
    first, second, low, high, _ = collocations.pairs(seq, index)
    plain = {}
    for a, b in zip(seq, seq[1:]):
        if a and b:
            plain[a, b] = plain.get((a, b), 0) + 1
    assert {(a, b): n for a, b, n in zip(first, second, high - low)} == plain
    kept = {k for k, n in plain.items() if n > 8}
    got = {}
    for rows, counts in collocations.longer(seq, lambda a, b: np.array([(x, y) in kept for x, y in zip(a, b)], dtype=bool)):
        got |= {tuple(int(x) for x in r if x): int(n) for r, n in zip(rows, counts)}
    want = {}
    for m in (3, 4):
        for i in range(len(seq) - m + 1):
            p = tuple(int(x) for x in seq[i:i + m])
            if all((x, y) in kept for x, y in zip(p, p[1:])):
                want[p] = want.get(p, 0) + 1
    assert got == want and any(len(p) == 4 for p in got)


# -- vectors --------------------------------------------------------------------------------------
def odd_rows(seed=1):
    """Ordinary rows, equal ones, repeated ids, other lengths, components far beyond 2^53, nulls and non-finite ones."""
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], i % 3) for i in range(400)]
    rows += [(400 + i, [0.5] * 6, i % 4) for i in range(40)]
    rows += [(50, [1.0] * 6, 1), (50, [1.0] * 6, 1), (100, [0.25] * 6, 2), (7, [9.0] * 6, 0)]
    rows += [(600 + i, [float(2 ** 30), float(2 ** 30 - i), 0.0], i % 2) for i in range(12)]
    rows += [(700 + i, [1e30, -1e300, float(i)], 1) for i in range(3)] + [(703, [2.0 ** 61, 3.0, 1.0], 0), (650, [1e9, 1e9 + 1, 1.0], 0)]
    rows += [(800, None, 1), (801, [1.0, None, 2.0], 1), (802, [float("nan")] * 6, 1), (803, [float("inf")] + [0.0] * 5, 1), (None, [1.0] * 6, 1),
             (804, [1.0] * 6, None), (900, [], 1), (950, [], 1), (951, [1.0], 0), (1000, [2.0], 0)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ROWS).withColumn("dim", F.lit("d")).withColumn("v", F.lit(1)).withColumn("block", F.lit(1)) \
        .withColumn("g", F.lit(1)).repartition(7)


def test_top_k_of_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(topk, "TREE", 90)
    monkeypatch.setattr(topk, "PAGE", 8)
    monkeypatch.setattr(topk, "BLOCK", 5)
    want = brute.top_k([(i, v) for i, v, _ in odd_rows()], lambda i: i % 50 == 0)
    got = topk.top_k(odd, F.col("vec_id") % 50 == 0)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want
    assert topk.top_k(odd.filter("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_units_without_broadcasts(spark, odd):
    """Where no side may be broadcast, units are still spread over tasks."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = topk.top_k(odd, F.col("vec_id") % 50 == 0)
        want = brute.top_k([(i, v) for i, v, _ in odd_rows()], lambda i: i % 50 == 0)
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == want
        blocks = spark.range(64).select(F.lit(3).alias("dim"), F.col("id").cast("string").cast("binary").alias("block"))
        queries_ = spark.createDataFrame([(3, bytearray(b"q"))], "dim int, queries binary")
        pairs = vectors.paired(blocks, 64, queries_)
        spread = pairs.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in spread) == 64 and pairs.select("g").distinct().count() > 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_copies_are_not_broadcast(spark):
    """A side that is copied to every group looks small to Spark: broadcast, its copies would all be in the driver."""
    blocks = spark.range(64).select(F.lit(3).alias("dim"), F.col("id").cast("string").cast("binary").alias("block"))
    asked = spark.range(6).select(F.lit(3).alias("dim"), F.concat(F.lit("q"), F.col("id").cast("string")).cast("binary").alias("queries"))
    for groups, shares in ((None, 1), (5, 3)):
        pairs = vectors.paired(blocks, 64, asked, groups, shares) if groups else vectors.paired(blocks, 64, asked)
        assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
        assert pairs.select("block", "queries").distinct().count() == pairs.count() == 64 * 6


def test_few_bytes_are_copied(spark):
    """Neither copies of the queries nor of the rows grow with rows times queries; no group meets too many bytes of queries."""
    for rows, asked in ((10, 1), (51_282, 1026), (615_000, 12_300), (2_500_000, 50_000), (15_000_000, 300_000), (15_000_000, 150_000)):
        n_blocks, size = -(-asked // 4096), 136 * asked
        groups, shares = vectors.grid(spark, rows, asked, n_blocks, size)
        assert groups >= 1 and 1 <= shares <= n_blocks and size / shares <= vectors.HELD
        assert rows * asked / (groups * shares) <= 2 * vectors.MANY and groups * asked + shares * rows <= 8 * (rows + asked)
    assert vectors.grid(spark, 0, 0, 0, 0) == (1, 1)


def test_top_k_over_groups_and_shares(spark, odd, monkeypatch):
    """What a query finds in one tree goes on to the next, in every group and share."""
    monkeypatch.setattr(topk, "TREE", 30)
    monkeypatch.setattr(topk, "PAGE", 8)
    monkeypatch.setattr(topk, "BLOCK", 1)
    monkeypatch.setattr(topk, "TOGETHER", 2)
    want = brute.top_k([(i, v) for i, v, _ in odd_rows()], lambda i: i % 50 == 0)
    for few, held in ((1, 1 << 20), (1 << 30, 1)):
        monkeypatch.setattr(vectors, "FEW", few)
        monkeypatch.setattr(vectors, "HELD", held)
        found = topk.top_k(odd, F.col("vec_id") % 50 == 0)
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == want


def test_products_are_exact_in_every_type():
    rng = np.random.default_rng(9)
    for most in (100, 1 << 11, 1 << 20, 1 << 40, 1 << 58):
        rows, own = rng.integers(-most, most + 1, (30, 7)).astype(np.float64), rng.integers(-most, most + 1, (4, 7)).astype(np.float64)
        kept = vectors.small(rows)
        assert np.array_equal(kept.astype(np.float64), rows)
        want = [[min(max(sum(int(a) * int(b) for a, b in zip(q, r)), vectors.LONG[0]), vectors.LONG[1]) for r in rows.tolist()] for q in own.tolist()]
        assert vectors.products(kept, own).tolist() == want


def test_hard_negatives_of_odd_rows(odd, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 70)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    for step in (100, 50):
        want = brute.negatives([(i, y, v) for i, v, y in odd_rows()], lambda i: i % step == 0)
        got = negatives.mine(odd, F.col("vec_id") % step == 0)
        assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got.collect()) == sorted(want)
        assert len(want) > 50
    assert negatives.mine(odd.filter("false"), F.col("vec_id") % 100 == 0).count() == 0


def found_negatives(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_hard_negatives_over_groups_and_shares(odd, monkeypatch):
    """What a window of scores has found goes on to the task's next block, in every group and share; nothing copied is broadcast."""
    monkeypatch.setattr(negatives, "ROWS", 25)
    monkeypatch.setattr(negatives, "ANCHORS", 8)
    monkeypatch.setattr(negatives, "TOGETHER", 3)
    want = sorted(brute.negatives([(i, y, v) for i, v, y in odd_rows()], lambda i: i % 50 == 0))
    own, plans = negatives.paired, []

    def paired(*args):
        plans.append((own(*args)._jdf.queryExecution().executedPlan().toString(), args[3:]))
        return own(*args)

    monkeypatch.setattr(negatives, "paired", paired)
    for few, held in ((1, 1 << 20), (1 << 30, 1)):
        monkeypatch.setattr(vectors, "FEW", few)
        monkeypatch.setattr(vectors, "HELD", held)
        assert found_negatives(negatives.mine(odd, F.col("vec_id") % 50 == 0)) == want and len(want) > 100
    assert len(plans) == 4 and all("Broadcast" not in p for p, _ in plans)
    assert max(g for _, (g, _) in plans) > 1 and max(s for _, (_, s) in plans) > 1


def test_an_anchor_is_stored_once_for_its_windows(spark):
    rows = [(a, a % 3, [float(a), 1.0], p, 10 * p) for a in (300, 100, 200) for p in range(5)]
    windows = spark.createDataFrame(rows, "vec_id long, label long, v array<double>, positive_id long, positive_score long").repartition(4)
    blocks = [vectors.unpacked(r.anchors) for r in negatives.anchor_blocks(windows, 1, ["positive_id", "positive_score"]).collect()]
    assert sum(len(b["v"]) for b in blocks) == 3
    got = [(int(b["vec_id"][o]), int(b["label"][o]), b["v"][o].tolist(), int(p), int(s)) for b in blocks
           for o, p, s in zip(b["of"], b["positive_id"], b["positive_score"])]
    assert sorted(got) == sorted(rows)


def test_best_of_windows_over_blocks():
    """Found rows arrive block by block; rows that agree in id and score count once, fewer than k leave a window open."""
    rng = random.Random(3)
    best, every = negatives.Best.none(4, 3), set()
    for _ in range(30):
        new = [(rng.randrange(3), rng.choice([-5, 0, 7, 2 ** 60, rng.randrange(100)]), rng.randrange(6)) for _ in range(rng.randrange(1, 9))]
        every |= set(new)
        best.add(*(np.array(x, dtype=np.int64) for x in zip(*new)))
        for w in range(4):
            want = sorted((-s, i) for o, s, i in every if o == w)[:3]
            assert [(-int(s), int(i)) for s, i in zip(best.scores[w], best.ids[w])][:best.n[w]] == want


def test_scores_at_the_end_of_the_range(spark):
    """Scores beyond a long's range count as its ends, for positives as well."""
    rows = [(100, [2.0 ** 54, 0.0], 1), (1, [2.0 ** 54, 1.0], 1), (2, [1 / 256, 0.0], 2), (3, [2 / 256, 0.0], 2), (4, [-2.0 ** 54, 0.0], 1)]
    got = found_negatives(negatives.mine(spark.createDataFrame(rows, ROWS), F.col("vec_id") == 100))
    assert got == brute.negatives([(i, y, v) for i, v, y in rows], lambda i: i == 100) and len(got) == 1


def test_summaries_bound_every_score():
    rng = np.random.default_rng(6)
    rows, own = np.floor(rng.normal(0, 300, (200, 37))), np.floor(rng.normal(0, 300, (1, 37)))
    true = vectors.products(rows, own)[0]
    for n in (1, 3, 16, 37, 50):
        low, high = (x[0] for x in negatives.bounds(negatives.summaries(own, n), negatives.summaries(rows, n),
                                            1e-9 * np.linalg.norm(rows, axis=1) * np.linalg.norm(own)))
        assert (low <= true).all() and (true <= high).all()
        if n >= 37:
            assert np.allclose(low, high)
