"""The pipeline's stages against brute force, each on its own input."""

import corpus_pipeline
import __spark_entry__
from tests.llm import brute
from tests.llm.test_operators import check_packing

SF001 = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF001)
        if name == "packing":
            check_packing(out.collect(), before)
            break
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "ngram_jaccard":
            assert set(after) == {i for i, (_, c) in brute.jaccard_components(before).items() if i == c}
        elif name == "decontamination":
            items = {r.item_id: r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()}
            found = brute.contamination(before, items)
            assert set(after) == {i for i, (n, hit, _) in found.items() if not (hit and 20 * hit >= n)}
        elif name == "secrets":
            assert set(after) == set(before)
            assert not any(brute.base_spans(t) for t in after.values())
        else:
            assert set(after) <= set(before) and len(after) > 0.8 * len(before)
        seen.append(name)
    assert seen == ["toxicity", "ngram_jaccard", "decontamination", "secrets"]


def test_run_and_registration(spark):
    q = __spark_entry__.queries()
    assert [n for n in range(1, 11) if not any(k.startswith(f"op{n}_") for k in q)] == [] and "pipeline" in q
    assert q["pipeline"](spark, SF001).count() > 100


def test_null_and_empty_inputs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(None, "some text", "en", "s", 9), (-5, None, None, None, None), (-6, "", "en", "s", 0)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF001).count() == 3, name
        assert stage(spark, odd.filter("false"), SF001).count() == 0, name
