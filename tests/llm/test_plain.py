"""Plain forms, worked out word by word and line by line, of the operators that SQL cannot express; long texts and hot keys."""

import itertools
import math
import re

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.llm import chat, secret_scan, toxicity
from tests.llm import brute

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# -- toxicity -------------------------------------------------------------------------------------------
def plain_words(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().translate(bytes.maketrans(
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))


def plain_bucket(gram):
    code = gram[0]
    for b in gram[1:]:
        code = (code * 0x01000193 & 0xFFFFFFFF) ^ b
    h = (code + len(gram)) * 0x85EBCA6B & 0xFFFFFFFF
    return (h ^ h >> 15) % toxicity.BUCKETS


def plain_score(text, model):
    words = plain_words(text)
    margins = []
    for at in range(0, len(words), 4):
        total = 0.0
        for w in set(words[at:at + 4]):
            marked = b" " + w + b" "
            values = [float(model.folded[plain_bucket(marked[i:i + n])]) for n in (3, 4, 5) for i in range(len(marked) - n + 1)]
            total += sum(values) / len(values)
        margins.append(total / 4)
    if not margins:
        return 0.0
    best = sorted(margins)[-2:]
    return 1 / (1 + math.exp(-(sum(best) / len(best) + model.bias)))


ODD = ["", " ", "...", "a", "A b", "one one one one", "Ünïcode wörds ÄÖ é", "x" * 5000, "it's a 3-part e-mail", "dünn dick 你好"]


def test_scores_match_a_plain_bag_of_subwords(spark):
    rows = [(r.text.encode(), r.doc_id % 2) for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(60).collect() if r.text]
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    for model in (toxicity.train(rows), toxicity.Model(np.random.default_rng(1).normal(0, 9, toxicity.BUCKETS).astype(np.float32), -0.4)):
        texts = {r.doc_id: r.text for r in docs.collect()} | {-i - 1: t for i, t in enumerate(ODD)}
        frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        for r in toxicity.score(frame, model).collect():
            assert r.score == pytest.approx(plain_score(texts[r.doc_id], model), rel=1e-6, abs=1e-9), texts[r.doc_id][:80]


@pytest.mark.parametrize("held", [1, 16, 300, 4000])
def test_cut_texts_score_as_whole_ones(monkeypatch, held):
    rng = np.random.default_rng(held)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS).astype(np.float32), 0.1)
    texts = ["".join(rng.choice(["ab", "c ", "xyz ", "  ", "é ", ". ", "long" * 40, " "], 300)).encode() for _ in range(20)]
    whole = model.scores(texts)
    monkeypatch.setattr(toxicity, "HELD_BYTES", held)
    assert all(b"".join(p for own in toxicity._cut(t) for p in own) == t for t in texts)
    assert np.allclose(model.scores(texts), whole, rtol=1e-12)


# -- chat -----------------------------------------------------------------------------------------------
def plain_viterbi(numbers, model):
    """Score of the best of all state paths, each tried."""
    best = -math.inf
    for path in itertools.product(range(chat.STATES), repeat=len(numbers)):
        score = model.move[chat.START][path[0]] + model.emit[path[0]][numbers[0]]
        for a, b, o in zip(path, path[1:], numbers[1:]):
            score += model.move[a][b] + model.emit[b][o]
        best = max(best, score)
    return best


def path_score(path, numbers, model):
    score = model.move[chat.START][path[0]] + model.emit[path[0]][numbers[0]]
    return score + sum(model.move[a][b] + model.emit[b][o] for a, b, o in zip(path, path[1:], numbers[1:]))


def test_decoding_matches_all_paths_tried():
    """Whole sequences, and sequences of two blocks joined by their matrices."""
    rng = np.random.default_rng(4)
    for _ in range(6):
        model = chat.Model(rng.integers(0, 30, (chat.STATES + 1, chat.STATES)), rng.integers(0, 9, (chat.STATES, chat.OBSERVATIONS)))
        numbers = rng.integers(0, chat.OBSERVATIONS, 4)
        want = plain_viterbi(numbers.tolist(), model)
        whole = model.span(numbers)[chat.START]
        assert whole.max() == pytest.approx(want)
        assert path_score(model.decode(numbers, chat.START, int(whole.argmax())).tolist(), numbers, model) == pytest.approx(want)
        for cut in (1, 2, 3):
            first, second = model.span(numbers[:cut])[chat.START], model.span(numbers[cut:])[:chat.STATES]
            joined = first[:, None] + second
            border, last = np.unravel_index(joined.argmax(), joined.shape)
            path = [*model.decode(numbers[:cut], chat.START, int(border)), *model.decode(numbers[cut:], int(border), int(last))]
            assert path_score(path, numbers, model) == pytest.approx(want)


def test_one_transcript_of_many_blocks(spark):
    """A turn over several blocks, in a transcript that holds nearly all rows."""
    long_text = "user: " + "\n".join(f"line {i} of a plain text" for i in range(7000))
    rows = [("hot", 2 * i, f"user: question {i}?" + "\nasked again" * (i % 6)) for i in range(1500)] + [("hot", 2 * i + 1, f"assistant: answer {i}." + "\nand more of it" * (i % 6)) for i in range(1500)] \
        + [("hot", 5000, long_text), ("hot", 5001, "assistant: done"), ("cold", 0, "user: hi")]
    raw = spark.createDataFrame(rows, "conv_id string, turn int, text string").repartition(5)
    labelled = raw.withColumn("role", F.regexp_extract("text", "^(user|assistant):", 1))
    model = chat.train(chat.blocks(labelled.filter("turn < 5000"), role_col="role"))
    got = sorted(chat.recover(raw, model).collect(), key=lambda r: (r.conv, r.turn))
    hot = [r for r in got if r.conv == "hot"]
    assert len(hot) == 3002 and [r.turn for r in hot] == list(range(3002))
    assert hot[0].text == "question 0?" and hot[-1].text == "done" and [r.role for r in hot[1:3]] == ["assistant", "user"]
    assert hot[-2].role == "user" and hot[-2].text == long_text[6:]


# -- secrets --------------------------------------------------------------------------------------------
def test_secrets_of_long_texts_empty_tables_and_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(300_000)) + " token=abcdef1 " + "f" * 100_000 + " AKIA" + "Z" * 20
    rows = [(1, text), (1, text), (2, None), (None, "password: hunter22")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("found", "kind", "start", "end")})
    got = [(r.doc_id, [tuple(s) for s in r.found]) for r in secret_scan.find_secrets(docs).collect()]
    long = brute.base_spans(text)
    assert len(long) == 3
    assert sorted(got, key=str) == sorted([(1, long), (1, long), (2, []), (None, [("assign", 0, 18)])], key=str)
    assert secret_scan.find_secrets(docs.filter("false")).collect() == []
    assert secret_scan.redact(docs).columns == docs.columns


# -- pipeline -------------------------------------------------------------------------------------------
def test_stages_take_repeated_rows_other_columns_and_long_texts(spark):
    """Repeated rows stay (or go) together, columns of other names pass through, a very long text is kept whole."""
    long = " ".join(f"v{i % 997}q{i}" for i in range(80_000))
    rows = [(1, "some plain words here", "en", "s", 21)] * 3 + [(2, long, "en", "s", len(long)), (3, "", "en", "s", 0), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(c) for c in ("part", "key", "found", "score", "component_id", "piece")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns, name
        assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect())), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert packed.filter("doc_id = 1").count() == 3 and packed.filter("doc_id = 2").agg(F.sum("length")).first()[0] > 80_000
