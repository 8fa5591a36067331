"""The registered queries of this subpackage: each applies one operator to its whole table.

An operator returns its own results (texts, spans, ids, scores); a query derives
from them the columns that its contract asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm import (chat, collocations, decontaminate, fingerprints, jaccard, langid, negatives, packing, quality, secret_scan,
                            substrings, topk, toxicity)
from tablesmith.llm.common import crc_mod, read, saved
from tablesmith.llm.oracle import ORACLE  # noqa: F401
from tablesmith.llm.sampling import labelled_sample

#: Rows that the classifiers are fitted on leave out this remainder of crc32(doc_id) by 3.
LABEL_FOLDS, LABEL_HELD_OUT = 3, 1
LANG_FOLDS, LANG_HELD_OUT = 5, 0


def in_fold(id_column: Column, folds: int, fold: int) -> Column:
    return F.coalesce(crc_mod(id_column, folds) == fold, F.lit(False))


def label_sample(spark: SparkSession, sf_dir: str, label: str, docs: DataFrame | None = None, also: str | None = None) -> list[tuple]:
    train = ~in_fold(F.col("doc_id"), LABEL_FOLDS, LABEL_HELD_OUT)
    return labelled_sample(read(spark, sf_dir, "documents") if docs is None else docs, read(spark, sf_dir, "labels"),
                           label, where=train, also=also)


def predictions(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", in_fold(F.col("doc_id"), LABEL_FOLDS, LABEL_HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> toxicity.Model:
    return toxicity.train(label_sample(spark, sf_dir, "toxic", docs))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(toxicity.score(read(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir)), toxicity.THRESHOLD)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents"))

    def n(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[n(k) for k in secret_scan.KINDS],
                        F.sha2(secret_scan.spans_text(F.col("found"), secret_scan.BASE_KINDS), 256).alias("base_sha256"),
                        secret_scan.spans_text(F.col("found")).alias("spans"))


#: Speaker markers that raw transcripts are written with, one style per conversation: (before, after, names).
STYLES = [("", ": ", {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}),
          ("### ", "\n", {"system": "System", "user": "Human", "assistant": "AI", "tool": "Function"}),
          ("[", "] ", {"system": "system", "user": "customer", "assistant": "agent", "tool": "tool"}),
          ("<|", "|>", {"system": "system", "user": "user", "assistant": "assistant", "tool": "tool"}),
          ("**", ":** ", {"system": "Context", "user": "Q", "assistant": "A", "tool": "Observation"})]


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """The conversations as raw text: turns end in an empty line and begin with the conversation's style of marker.

    One turn in five carries no marker, so that roles have to be recovered from what surrounds it.
    """
    style = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % len(STYLES)
    marker = F.lit(None).cast("string")
    for i, (before, after, names) in enumerate(STYLES):
        name = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("role")]
        marker = F.when(style == i, F.concat(F.lit(before), name, F.lit(after))).otherwise(marker)
    bare = F.crc32(F.concat_ws(":", "conv_id", "turn").cast("binary")) % 5 == 0
    text = F.concat(F.coalesce(F.when(~bare, marker), F.lit("")), F.coalesce("text", F.lit("")), F.lit("\n"))
    return conversations.select("conv_id", "turn", "role", text.alias("text"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transcripts(read(spark, sf_dir, "conversations"))
    cut = saved(chat.blocks(raw, role_col="role"), "chat-blocks")
    model = chat.train(cut.filter(~in_fold(F.col("conv"), LANG_FOLDS, LANG_HELD_OUT)))
    found = chat.turns(cut, model)
    return found.select(F.col("conv").cast("long").alias("conv_id"), "turn",
                        in_fold(F.col("conv"), LANG_FOLDS, LANG_HELD_OUT).alias("held_out"), "role", "text", "rendered")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), with_ids=False)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality.train(label_sample(spark, sf_dir, "quality", also="n_chars"))
    return predictions(quality.score(read(spark, sf_dir, "documents"), model), quality.THRESHOLD)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(read(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeated(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    known = langid.profiles(docs.filter(~in_fold(F.col("doc_id"), LANG_FOLDS, LANG_HELD_OUT)))
    return langid.predict(docs, known).select(
        "doc_id", in_fold(F.col("doc_id"), LANG_FOLDS, LANG_HELD_OUT).alias("held_out"), "lang_pred", "score")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited_pairs(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_secret_scan, op3_chat_formatting, op4_best_fit_packing, op5_quality, op6_ngram_jaccard, op7_substring_dedup, op8_exact_top_k, op9_decontamination,
                                   op10_language_id, op11_fingerprints, op12_collocations, op13_hard_negatives)}
