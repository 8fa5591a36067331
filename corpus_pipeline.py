"""A corpus pipeline of five stages, each one of the operators of ``tablesmith.llm`` over all that its predecessor kept.

toxicity: documents scoring 0.7 or more go. ngram_jaccard: of each group of near
copies (five-word shingles, similarity 0.75 or more, linked through others too)
the document with the smallest doc_id stays. decontaminate: documents that the
contamination rule finds go. secrets: found spans are masked in the text, all
documents stay. packing: the result, one row per packed piece.

Rows with a null id or text pass the filters; every stage but the last returns
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tablesmith.llm import decontaminate, jaccard, packing, secret_scan, toxicity
from tablesmith.llm.common import read
from tablesmith.llm.queries import toxicity_model
from tablesmith.session import work_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity_model(spark, sf_dir, docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, with_ids=False)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", keep_one_of_each), ("decontamination", drop_contaminated),
          ("secrets", mask_secrets), ("packing", pack)]

#: Trained models and tokenizers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: each stage's result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, "pipeline", f"{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
