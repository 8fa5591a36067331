"""File exports (written by the executors as part files, never through the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions import expressions as fx
from tablesmith.sources.files import CSV_OPTIONS

_TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, as a CSV export shows it (time stamps ``yyyy-MM-dd HH:mm:ss``)."""
    return df.select(*[fx.col(c).cast("string").alias(c) for c in df.columns])


def csv_export(df: DataFrame, path: str, *, mode: str = "errorifexists", times_as_text: bool = True,
               single_file: bool = False) -> str:
    """Write ``df`` as CSV with a header row; returns ``path``.

    Time columns are written as SQL text (the writer's own layout is ISO
    with ``T``). ``single_file`` coalesces to one part: only for small results.
    """
    out = df
    if times_as_text:
        out = out.select(*[(fx.col(f.name).cast("string") if isinstance(f.dataType, _TIME_TYPES)
                            else fx.col(f.name)).alias(f.name) for f in df.schema.fields])
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def view_export(df: DataFrame, path: str, response_format: str = "csv", *, mode: str = "errorifexists") -> str:
    """Export a table or view in ``csv``, ``json`` or ``parquet``; returns ``path``."""
    fmt = response_format.lower()
    if fmt == "csv":
        return csv_export(df, path, mode=mode)
    if fmt == "json":
        df.write.mode(mode).json(path)
        return path
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
        return path
    raise ValueError(f"unsupported format {response_format!r}; use csv, json or parquet")


def write_documents(docs: DataFrame, text_col: str, path: str, *, mode: str = "errorifexists") -> str:
    """One JSON document per line (e.g. mapping documents)."""
    docs.select(F.col(text_col).alias("value")).write.mode(mode).text(path)
    return path
