"""Profiles that can be stored and merged: one row of sketches per table, or per part of one.

``table_sketches`` makes the row in one aggregate, ``merge_sketches`` adds up rows
of several parts (days, buckets, loads) without reading the parts again, and
``sketch_report`` reads the profile off a row. State per column is constant:
HyperLogLog for distinct values, KLL for quantiles, a frequent-items map for
common values.

Error bounds, n being the non-null rows of a column:

* distinct values: relative standard error ``1.04 / sqrt(2 ** DISTINCT_LG)``, 1.6 %;
* quantiles: the rank of a reported value is within ``rank_error(k)`` * n of the
  rank asked for (normalised, at 99 % confidence; Apache DataSketches' KLL);
* frequent values: no reported count is below the true one, none exceeds it by more
  than ``count_error(tracked)`` * n, and a value held by more than twice that share
  of the rows is among the reported ones (this bound is certain), as long as ``top``
  leaves room for it. Values that may be rarer are not reported.

Nulls are counted but enter no sketch; NaN has no rank. Quantiles are for numbers
(as doubles), dates and timestamps, null for other types and for columns without a
value. Frequent values are shown as text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions import expressions as fx

#: Sizes of the sketches: log2 of HyperLogLog's registers, KLL's k, values followed for frequency.
DISTINCT_LG, RANKS, TRACKED = 12, 400, 3072
QUANTILES = (0.25, 0.5, 0.75)

_ORDERABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def rank_error(k: int = RANKS) -> float:
    """Normalised rank error of a KLL sketch at 99 % confidence (the fit that its authors publish)."""
    return 2.296 / k ** 0.9723


def count_error(tracked: int = TRACKED) -> float:
    """Error of a frequent value's count, as a share of the rows: 3.5 by the size of the map, a power of two."""
    return 3.5 / 2 ** max(3, math.ceil(math.log2(tracked / 0.75)))


def _number(x: Column, t: T.DataType) -> Column | None:
    """The value as a double that orders alike, where there is one."""
    if isinstance(t, T.NumericType):
        return x.cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(x).cast("double")
    if isinstance(t, _TIMES):
        return F.unix_micros(x.cast("timestamp")).cast("double")
    return None


def _value(x: Column, t: T.DataType) -> Column:
    """Back from the double, as text."""
    if isinstance(t, T.DateType):
        return F.date_from_unix_date(x.cast("int")).cast("string")
    if isinstance(t, _TIMES):
        return F.timestamp_micros(x.cast("long")).cast(t).cast("string")
    return x.cast("string")


def table_sketches(df: DataFrame, columns: Sequence[str] | None = None, *, ranks: int = RANKS, tracked: int = TRACKED) -> DataFrame:
    """One row: ``n_rows``, ``sizes`` (of the sketches) and ``columns``, a struct of each column's counts and sketches.

    One aggregate without a key: each task sends one partial row of bounded size
    (longer cells make the frequent-items map larger; leave columns of long texts out
    through ``columns``).
    """
    names = list(columns) if columns is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    src = df.select(*[fx.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    parts, numbers = [], []
    for i, c in enumerate(names):
        x, t = F.col(f"c{i}"), types[c]
        known, number = isinstance(t, _ORDERABLE), _number(x, t)
        numbers += [] if number is None else [number.alias(f"r{i}")]
        text = f"cast(c{i} as string)"
        parts += [F.count(x).alias(f"nn{i}"), (F.min(x) if known else F.lit(None).cast("string")).alias(f"mn{i}"),
                  (F.max(x) if known else F.lit(None).cast("string")).alias(f"mx{i}"),
                  F.expr(f"hll_sketch_agg({text}, {DISTINCT_LG})").alias(f"nd{i}"),
                  (F.lit(None).cast("binary") if number is None else F.expr(f"kll_sketch_agg_double(r{i}, {int(ranks)})")).alias(f"rk{i}"),
                  F.expr(f"approx_top_k_accumulate({text}, {int(tracked)}) filter (where c{i} is not null)").alias(f"fq{i}")]
    row = src.select("*", *numbers).agg(F.count(F.lit(1)).alias("n_rows"), *parts)
    return _nested(row.withColumn("sizes", F.struct(F.lit(int(ranks)).alias("ranks"), F.lit(int(tracked)).alias("tracked"))), names)


def _nested(row: DataFrame, names: Sequence[str]) -> DataFrame:
    return row.select("n_rows", "sizes", F.struct(*[F.struct(
        F.col(f"nn{i}").alias("non_null"), F.col(f"mn{i}").alias("low"), F.col(f"mx{i}").alias("high"), F.col(f"nd{i}").alias("distinct"),
        F.col(f"rk{i}").alias("ranks"), F.col(f"fq{i}").alias("frequent")).alias(c) for i, c in enumerate(names)]).alias("columns"))


def _names(sketches: DataFrame) -> list[str]:
    return sketches.schema["columns"].dataType.names


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row for all rows of ``table_sketches`` given (parts of one table, sketches of one size; others fail).

    The bounds are those of one sketch over all parts. No rows: none back.
    """
    names, parts = _names(sketches), []
    for i, c in enumerate(names):
        at = f"columns.{fx.quote(c)}"
        parts += [F.sum(f"{at}.non_null").alias(f"nn{i}"), F.min(f"{at}.low").alias(f"mn{i}"), F.max(f"{at}.high").alias(f"mx{i}"),
                  F.expr(f"hll_union_agg({at}.distinct)").alias(f"nd{i}"),
                  F.expr(f"kll_merge_agg_double({at}.ranks)").alias(f"rk{i}"),
                  F.expr(f"approx_top_k_combine({at}.frequent)").alias(f"fq{i}")]
    row = sketches.groupBy(F.lit("one").alias("table")).agg(F.sum("n_rows").alias("n_rows"), F.min("sizes").alias("least"), F.max("sizes").alias("most"), *parts)
    same = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.raise_error(F.lit("sketches of several sizes")))
    return _nested(row.withColumn("sizes", same), names)


def sketch_report(sketches: DataFrame, *, quantiles: Sequence[float] = QUANTILES, top: int = 10) -> DataFrame:
    """One row per column of each sketch row: ``col_name, n_rows, n_non_null, n_distinct, min_value, max_value``,
    ``quantiles`` (one value per share asked, as text) and ``frequent`` (value, n; most first, ties by value;
    ``top`` of them, at most as many as the sketch follows)."""
    rows = []
    for f in sketches.schema["columns"].dataType.fields:
        at, t = F.col(f"columns.{fx.quote(f.name)}"), f.dataType["low"].dataType
        has_ranks = _number(F.lit(None), t) is not None
        ranks = at["ranks"]
        values = [_value(_quantile(ranks, q), t) for q in quantiles]
        frequent = F.expr(f"approx_top_k_estimate(columns.{fx.quote(f.name)}.frequent, {int(top)})")
        frequent = F.transform(F.sort_array(F.transform(frequent, lambda x: F.struct((-x["count"]).alias("less"), x["item"].alias("value")))),
                               lambda x: F.struct(x["value"].alias("value"), (-x["less"]).alias("n")))
        rows.append(F.struct(F.lit(f.name).alias("col_name"), at["non_null"].alias("n_non_null"),
                             F.expr(f"hll_sketch_estimate(columns.{fx.quote(f.name)}.distinct)").alias("n_distinct"),
                             at["low"].cast("string").alias("min_value"), at["high"].cast("string").alias("max_value"),
                             (F.array(*values) if has_ranks else F.lit(None).cast("array<string>")).alias("quantiles"),
                             frequent.alias("frequent")))
    return sketches.select("n_rows", F.explode(F.array(*rows)).alias("r")).select("r.col_name", "n_rows", *[
        f"r.{c}" for c in ("n_non_null", "n_distinct", "min_value", "max_value", "quantiles", "frequent")])


def _quantile(ranks: Column, q: float) -> Column:
    filled = F.call_function("kll_sketch_get_n_double", ranks) > 0
    return F.when(filled, F.call_function("kll_sketch_get_quantile_double", ranks, F.lit(float(q))))
