"""Row changes: add rows, update or delete rows matching a criteria.

A criteria is a Spark SQL boolean expression. ``None`` means every row and
must be passed explicitly. A row whose criteria evaluates to null is left as
it is (neither updated nor deleted).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions import expressions as fx


def _criteria(criteria: str | Column | None) -> Column:
    if criteria is None:
        return F.lit(True)
    c = F.expr(criteria) if isinstance(criteria, str) else criteria
    return F.coalesce(c, F.lit(False))


def _types(df: DataFrame) -> dict[str, Any]:
    return {f.name: f.dataType for f in df.schema.fields}


def _fits(value: Any, t: T.DataType) -> bool:
    """Whether a Python value can stand in a column of this type as it is."""
    try:
        T._make_type_verifier(t)(value)
        return True
    except Exception:
        return False


def _text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def add_rows(df: DataFrame, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Append rows given as name -> value; missing names are null, values cast to the column type."""
    types = _types(df)
    for r in rows:
        unknown = [k for k in r if k not in types]
        if unknown:
            raise ValueError(f"unknown column(s) {unknown}")
    if not rows:
        return df
    # One local relation, whatever the number of rows: values as text or as they are, then cast to the column's type.
    given = [[r.get(c) for r in rows] for c in types]
    as_text = [any(v is not None and not _fits(v, t) for v in own) for own, t in zip(given, types.values())]
    schema = T.StructType([T.StructField(f"c{i}", T.StringType() if text else t)
                           for i, (text, t) in enumerate(zip(as_text, types.values()))])
    data = [tuple(None if v is None else _text(v) if text else v for v, text in zip(row, as_text)) for row in zip(*given)]
    new = df.sparkSession.createDataFrame(data, schema)
    return df.unionByName(new.select(*[F.col(f"c{i}").cast(t).alias(c) for i, (c, t) in enumerate(types.items())]))


def update_where(df: DataFrame, values: Mapping[str, Any], criteria: str | Column | None,
                 observation: Observation | None = None) -> DataFrame:
    """Set ``values`` (literals, or Columns) on rows where ``criteria`` holds.

    With ``observation`` the number of updated rows is reported as
    ``updated_rows`` once the result is computed (no extra pass).
    """
    types = _types(df)
    unknown = [k for k in values if k not in types]
    if unknown:
        raise ValueError(f"unknown column(s) {unknown}")
    hit = _criteria(criteria)
    if observation is not None:
        df = df.observe(observation, F.count_if(hit).alias("updated_rows"))
    new = {}
    for k, v in values.items():
        val = v if isinstance(v, Column) else F.lit(v)
        new[k] = F.when(hit, val.cast(types[k])).otherwise(fx.col(k))
    return df.withColumns(new)


def delete_where(df: DataFrame, criteria: str | Column | None, observation: Observation | None = None) -> DataFrame:
    """Drop rows where ``criteria`` holds; with ``observation``: ``deleted_rows``.

    The kept rows are written as ``c IS NULL OR NOT c`` (not ``NOT coalesce(c, false)``)
    so that simple criteria still reach the Parquet scan as pushed filters.
    """
    if observation is not None:
        df = df.observe(observation, F.count_if(_criteria(criteria)).alias("deleted_rows"))
    if criteria is None:
        return df.filter(F.lit(False))
    c = F.expr(criteria) if isinstance(criteria, str) else criteria
    return df.filter(c.isNull() | ~c)
