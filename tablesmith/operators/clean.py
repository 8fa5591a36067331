"""Missing-value tokens, number cleaning, NaN -> null, boolean spellings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablesmith.functions import expressions as fx
from tablesmith.functions.tokens import NA_TOKENS


def _check(df: DataFrame, columns: Iterable[str]) -> list[str]:
    names = list(columns)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"unknown column(s) {missing}; have {df.columns}")
    return names


def null_tokens(df: DataFrame, columns: Sequence[str] | None = None, tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Missing-value tokens (``NA``, ``N/A``, ``NULL``, empty, ...) -> null in string columns."""
    toks = list(tokens)
    names = _check(df, columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: fx.na_to_null(fx.col(c), toks) for c in names}) if names else df


def null_normalise(df: DataFrame, tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Every missing value becomes SQL NULL: tokens in text columns, NaN in floating columns."""
    toks = list(tokens)
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            out[f.name] = fx.na_to_null(fx.col(f.name), toks)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = fx.nan_to_null(fx.col(f.name))
    return df.withColumns(out) if out else df


def clean_number(df: DataFrame, column: str, dtype: str = "double", on_error: str = "raise") -> DataFrame:
    """One number column: thousands commas removed, parsed to ``dtype``."""
    _check(df, [column])
    return df.withColumn(column, fx.to_number(fx.col(column), dtype, on_error))


def clean_numbers(df: DataFrame, columns: Sequence[str], dtype: str = "double", on_error: str = "raise") -> DataFrame:
    """Several number columns at once (one projection)."""
    names = _check(df, columns)
    return df.withColumns({c: fx.to_number(fx.col(c), dtype, on_error) for c in names}) if names else df


def normalise_boolean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Boolean spellings (``True``, ``FALSE``, ...) stored as ``true``/``false``."""
    names = _check(df, columns)
    return df.withColumns({c: fx.boolean_text(fx.col(c)) for c in names}) if names else df
