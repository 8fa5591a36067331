"""Lookup columns: link a child column to a parent table's key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions import expressions as fx
from tablesmith.operators.sizing import DEFAULT_BROADCAST_ROWS, assert_unique, broadcast_if_small, within

def lookup(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
           columns: Sequence[str] | None = None, *, check_unique: bool = True,
           broadcast_max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Child rows with the parent's ``columns`` looked up by ``child_col = parent_col``.

    Left join: children without a parent keep null parent columns. The parent
    key must be unique (checked when ``check_unique``), so a child row never
    multiplies. The parent side is broadcast only after its row count is
    proven under ``broadcast_max_rows``; otherwise a shuffle join, where AQE
    splits a hot child key across tasks.
    """
    if child_col not in child.columns:
        raise ValueError(f"child column {child_col!r} not found")
    if parent_col not in parent.columns:
        raise ValueError(f"parent column {parent_col!r} not found")
    cols = list(columns) if columns is not None else [c for c in parent.columns if c != parent_col]
    clash = [c for c in cols if c.lower() in {x.lower() for x in child.columns}]
    if clash:
        raise ValueError(f"looked-up column(s) {clash} already in the child table; rename first")
    key = fx.fresh("_lookup_key", child.columns, parent.columns)
    side = parent.select(fx.col(parent_col).alias(key), *[fx.col(c) for c in cols]).filter(fx.col(key).isNotNull())
    if check_unique:  # the uniqueness job also measures the parent (rows and bytes) for the broadcast bound
        if within(assert_unique(side, [key], "lookup parent"), broadcast_max_rows):
            side = F.broadcast(side)
    else:
        side = broadcast_if_small(side, broadcast_max_rows)
    return child.join(side, fx.col(child_col) == fx.col(key), "left").drop(fx.col(key))


def remove_lookup(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Undo a lookup: drop the looked-up columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) {missing} not found")
    return df.drop(*[fx.col(c) for c in columns])
