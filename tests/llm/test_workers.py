"""The operators on workers that cannot import the package, and the cases that samples and profiles are fixed by."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.llm import langid, quality, sampling
from tests.conftest import ROOT

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as entry
from pyspark.sql import functions as F
@F.udf("boolean")
def importable(x):
    import importlib.util
    return importlib.util.find_spec("tablesmith") is not None
assert not spark.range(1).select(importable("id")).first()[0]
for name in {names!r}:
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


@pytest.mark.parametrize("names", [["op1_toxicity", "op2_secret_scan", "op3_chat_formatting", "op4_best_fit_packing", "op5_quality", "op10_language_id"],
                                   ["op6_ngram_jaccard", "op7_substring_dedup", "op8_exact_top_k", "op9_decontamination"],
                                   ["op11_fingerprints", "op12_collocations", "op13_hard_negatives", "pipeline"]])
def test_workers_need_no_copy_of_the_package(tmp_path, names):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, names=names)], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "all ran" in out.stdout, out.stderr[-3000:]


def test_signs_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "²½"), (2, "Ⅷ ³"), (3, "12 _ 7"), (4, "der die das und"), (5, None), (6, "一二")], "doc_id long, text string")
    known = langid.profiles(spark.createDataFrame([("de", "der die das und ist"), ("en", "the of and is")], "lang string, text string"))
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, known).collect()}
    assert got[1] == got[2] == got[3] == got[5] == "und" and got[4] == "de" and got[6] in ("de", "en")
    for c in "²½Ⅷ①":
        assert not langid.LETTERS.search(langid.without_signs(c))
    for c in "aéßж一ªʰ":
        assert langid.LETTERS.search(langid.without_signs(c)) and c.isalpha()
    every = "".join(c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000)
    assert set("".join(langid.LETTERS.findall(langid.without_signs(every)))) == {c for c in every if c.isalpha()}


def test_long_texts_are_not_cut_in_words(monkeypatch):
    text = " ".join(["word", "ünder", "x1y²z"] * 60) + " " + "long" * 40
    whole = langid.ngram_counts(text)
    for piece in (1, 7, 50, 333):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert all(np.array_equal(a, b) for a, b in zip(langid.ngram_counts(text), whole))


def test_predictions_match_a_plain_out_of_place_distance(spark):
    train = {"de": "der die das und ist nicht ein eine " * 5, "en": "the of and is not a an it to " * 5, "fr": "le la les et est pas un une " * 5}
    texts = ["das ist nicht gut", "it is not good", "la vie est une fleur", "a", "zzz qqq", "die the le"]
    known = langid.profiles(spark.createDataFrame(list(train.items()), "lang string, text string"))

    def ranks(text):
        count = {}
        for w in langid.LETTERS.findall(text.lower()):
            p = f"_{w}_"
            for n in (1, 2, 3):
                for i in range(len(p) - n + 1):
                    if p[i:i + n] != "_":
                        count[p[i:i + n]] = count.get(p[i:i + n], 0) + 1
        code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
        return sorted(count, key=lambda g: (-count[g], code(g)))[:langid.TOP]

    profiles = {k: {g: i for i, g in enumerate(ranks(v))} for k, v in train.items()}
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), known).collect()
    for r in got:
        own = ranks(texts[r.doc_id])
        far = {k: sum(abs(p[g] - i) if g in p else langid.TOP for i, g in enumerate(own)) for k, p in profiles.items()}
        best = min(far.values())
        assert far[r.lang_pred] == best and abs(r.score - (1 - best / (langid.TOP * len(own)))) < 1e-12


def test_samples_do_not_depend_on_partitions(spark):
    rows = [(i % 40, f"text {i} of some words", i) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {repr(sampling.labelled_sample(docs.repartition(n, F.col("n_chars")), labels, "quality", also="n_chars")) for n in (1, 3, 8, 17)}
    assert len(found) == 1


def test_the_stored_count_is_learnt():
    """Two kinds of documents that differ in their stored character count alone."""
    rows = [(b"the same words here", k % 2, 10_000 if k % 2 else 10) for k in range(200)]
    model = quality.train(rows)
    good, bad = model.scores([b"the same words here"] * 2, [10_000, 10])
    assert good > 0.8 and bad < 0.2
