"""Table and column profiles, report specs, load audits.

All are aggregations with partial (map-side) aggregation, so hot
values are combined inside each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions import expressions as fx

_ORDERABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def profile_table(df: DataFrame, columns: Sequence[str] | None = None, *, exact: bool = False) -> DataFrame:
    """One row per column: ``col_name, n_rows, n_non_null, n_distinct, min_value, max_value``.

    One aggregate over the table: counts, minimum and maximum in the column's
    own ordering, and distinct counts by HyperLogLog++ (constant state per
    column); each task sends one partial row, no row is shuffled. ``exact=True``
    counts distinct values exactly instead, in a second aggregate: Spark expands
    each row into one (column, value) row per column, combines repeats map-side
    and shuffles the rest, which is most of the table for unique columns.
    """
    names = list(columns) if columns is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    src = df.select(*[fx.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(names):
        x, orderable = F.col(f"c{i}"), isinstance(types[c], _ORDERABLE)
        aggs += [F.count(x).alias(f"nn{i}"),
                 (F.min(x).cast("string") if orderable else F.lit(None).cast("string")).alias(f"mn{i}"),
                 (F.max(x).cast("string") if orderable else F.lit(None).cast("string")).alias(f"mx{i}"),
                 (F.lit(None).cast("bigint") if exact else F.approx_count_distinct(x)).alias(f"nd{i}")]
    stacked = ", ".join(f"{_sql_str(c)}, nn{i}, nd{i}, mn{i}, mx{i}" for i, c in enumerate(names))
    out = src.agg(*aggs).select(F.col("n").alias("n_rows"), F.expr(
        f"stack({len(names)}, {stacked}) as (col_name, n_non_null, n_distinct, min_value, max_value)"))
    if exact:
        dist = src.agg(*[F.count_distinct(F.col(f"c{i}")).alias(f"nd{i}") for i in range(len(names))])
        right = dist.select(F.expr(f"stack({len(names)}, " + ", ".join(f"{_sql_str(c)}, nd{i}" for i, c in enumerate(names))
                                   + ") as (col_name, n_distinct)"))       # one row per column
        out = out.drop("n_distinct").join(F.broadcast(right), "col_name")
    return out.select("col_name", "n_rows", "n_non_null", "n_distinct", "min_value", "max_value")


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def profile_column(df: DataFrame, column: str) -> DataFrame:
    """Frequency table of one column: ``value`` (as text, null kept) and ``n``."""
    return df.groupBy(fx.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class ReportSpec:
    """A report defined on one table: group columns and measures.

    ``measures`` are ``(function, column, alias)`` with function one of
    count, count_distinct, sum, avg, min, max (column ``*`` for count).
    ``round_to`` rounds sum/avg results.
    """

    group_by: Sequence[str]
    measures: Sequence[tuple[str, str, str]]
    group_aliases: Sequence[str] | None = None
    round_to: int | None = None
    name: str = "report"
    filters: Sequence[str] = field(default_factory=tuple)


_MEASURES = {
    "count": lambda c: F.count(F.lit(1)) if c is None else F.count(c),
    "count_distinct": F.count_distinct,
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
}


def similar_report(df: DataFrame, spec: ReportSpec, column_map: Mapping[str, str] | None = None) -> DataFrame:
    """Build ``spec`` (made on a reference table) on ``df``, whose columns go by other names (``column_map``).

    ``df`` is seen under the reference table's names, so that groups, measures
    and filters all apply as they are written.
    """
    cmap = dict(column_map or {})
    missing = [c for c in cmap.values() if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) {missing} not found")
    kept = [c for c in df.columns if c.lower() not in {k.lower() for k in cmap}]
    df = df.select(*[fx.col(new).alias(old) for old, new in cmap.items()], *[fx.col(c) for c in kept])
    for flt in spec.filters:
        df = df.filter(F.expr(flt))
    aliases = list(spec.group_aliases or spec.group_by)
    aggs = []
    for fn, c, alias in spec.measures:
        if fn not in _MEASURES:
            raise ValueError(f"unknown measure {fn!r}; use one of {sorted(_MEASURES)}")
        e = _MEASURES[fn](None if c == "*" else fx.col(c))
        if spec.round_to is not None and fn in ("sum", "avg"):
            e = F.round(e, spec.round_to)
        aggs.append(e.alias(alias))
    return df.groupBy(*[fx.col(g).alias(a) for g, a in zip(spec.group_by, aliases)]).agg(*aggs)


def load_audit(prepared: DataFrame, *, id_col: str = "id", null_columns: Sequence[str] = (),
               number_columns: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """One audit row for a batch about to be loaded.

    ``rows_read``; ``rows_loaded`` (distinct ids); ``duplicate_rows``; per
    ``null_columns`` a ``nulls_<c>`` count; per ``number_columns`` (still
    text) a ``bad_<c>`` count of cells that do not parse as numbers.
    """
    distinct = F.count_distinct(fx.col(id_col)) if exact else F.approx_count_distinct(fx.col(id_col))
    aggs = [F.count(F.lit(1)).alias("rows_read"), distinct.alias("rows_loaded")]
    aggs += [F.count_if(fx.col(c).isNull()).alias(f"nulls_{c}") for c in null_columns]
    aggs += [F.count_if(fx.bad_number(fx.col(c))).alias(f"bad_{c}") for c in number_columns]
    out = prepared.agg(*aggs)
    cols = out.columns
    return out.select(cols[0], cols[1], (F.col("rows_read") - F.col("rows_loaded")).alias("duplicate_rows"), *cols[2:])
