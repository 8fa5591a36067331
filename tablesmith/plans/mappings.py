"""Schema CSVs -> mapping documents -> job registry rows.

Each schema CSV lists one table's columns (``source_key, destination_key,
data_type``). Many files are read in one scan; each file becomes one
document (its columns in file order), written as one JSON line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.functions import expressions as fx
from tablesmith.functions.tokens import PENDING
from tablesmith.operators.mapping import mapping_collect, mapping_document
from tablesmith.sinks.files import write_documents
from tablesmith.sources.files import mapping_scan

DOC_FIELDS = ["view_id", "source_table", "target_table"]


def schema_csv_mappings(spark: SparkSession, paths: str | Sequence[str], *, view_id: str | None = None,
                        source_table: str | None = None, target_table: str | None = None) -> DataFrame:
    """One ``(view_id, source_table, target_table, column_mapping)`` row per schema file.

    The three names are given for a single file; when omitted they default
    to the file's name (``<table>.csv``, or the ``<table>/`` folder of a
    part file), so a folder of schema files maps each to its own table.
    Positions follow row order within each file (schema files are small and
    scan as one split each).
    """
    scanned = mapping_scan(spark, paths)
    base = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?(/part-[^/]*)?$", 1)
    others = [c for c in scanned.columns if c not in {*DOC_FIELDS, "position", "source_key", "destination_key", "data_type"}]
    rows = scanned.select(
        F.lit(view_id).cast("string").alias("view_id") if view_id is not None else base.alias("view_id"),
        F.lit(source_table).alias("source_table") if source_table is not None else base.alias("source_table"),
        F.lit(target_table).alias("target_table") if target_table is not None else base.alias("target_table"),
        "position", "source_key", "destination_key", "data_type", *[fx.col(c) for c in others])
    return mapping_collect(rows, DOC_FIELDS, "position")


def schema_csv_documents(spark: SparkSession, paths: str | Sequence[str], *, out_path: str | None = None,
                         pretty: bool = False, **names: str) -> DataFrame:
    """Mapping documents as JSON text (one line each), written to ``out_path`` when given."""
    docs = mapping_document(schema_csv_mappings(spark, paths, **names), DOC_FIELDS, pretty=pretty)
    if out_path:
        write_documents(docs, "document", out_path)
    return docs


def jobs_from_mappings(docs: DataFrame, mapping_col: str = "column_mapping") -> DataFrame:
    """New registry rows (``PENDING``) from ``schema_csv_mappings``: one sync job per table."""
    return docs.select(
        F.col("target_table").alias("job_id"), F.col("source_table"), F.lit(None).cast("string").alias("source_sql"),
        F.col("target_table"), F.transform(mapping_col, lambda e: F.struct(*[e[k].alias(k) for k in (
            "source_key", "destination_key", "data_type")])).alias("column_mapping"), F.lit(PENDING).alias("status"),
        F.lit(None).cast("string").alias("message"), F.lit(0).cast("bigint").alias("updated_at"))
