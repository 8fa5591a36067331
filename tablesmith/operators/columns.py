"""Column changes: add, rename, delete, hide/show, formula columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions import expressions as fx
from tablesmith.operators.mapping import spark_type


def _lower_names(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def _require(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"column {name!r} not found; have {df.columns}")


def _free(df: DataFrame, name: str) -> None:
    if name.lower() in _lower_names(df):
        raise ValueError(f"column {name!r} already exists (names compare without case)")


def add_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """New typed column, null for existing rows. ``data_type`` is a logical type or a Spark type name."""
    _free(df, name)
    t = spark_type(data_type.upper()) if data_type.upper() in ("STRING", "NUMBER", "DATE", "BOOLEAN") else data_type
    return df.withColumn(name, F.lit(None).cast(t))


def rename_column(df: DataFrame, name: str, new_name: str) -> DataFrame:
    """Rename; fails when the column is absent or the new name is taken."""
    _require(df, name)
    if new_name.lower() != name.lower():
        _free(df, new_name)
    return df.withColumnRenamed(name, new_name)


def delete_column(df: DataFrame, name: str) -> DataFrame:
    """Drop; fails when the column is absent."""
    _require(df, name)
    return df.drop(fx.col(name))


def apply_formulas(df: DataFrame, formulas: Mapping[str, str]) -> DataFrame:
    """Formula columns (name -> Spark SQL expression) added to ``df``.

    Formulas are kept as text, so the set defined for one table applies to
    any other table that has the columns they use.
    """
    for n in formulas:
        _free(df, n)
    return df.withColumns({n: F.expr(e) for n, e in formulas.items()})


@dataclass(frozen=True)
class TableView:
    """A table plus the set of columns hidden from its visible projection."""

    data: DataFrame
    hidden: frozenset[str] = field(default_factory=frozenset)

    def visible(self) -> DataFrame:
        return self.data.select(*[fx.col(c) for c in self.data.columns if c not in self.hidden])


def hide_columns(view: TableView | DataFrame, names: Iterable[str]) -> TableView:
    """Hide columns: data is kept, they leave the visible projection."""
    v = view if isinstance(view, TableView) else TableView(view)
    names = list(names)
    for n in names:
        _require(v.data, n)
    return TableView(v.data, v.hidden | frozenset(names))


def show_columns(view: TableView, names: Iterable[str]) -> TableView:
    """Show hidden columns again, in their table position."""
    names = list(names)
    for n in names:
        _require(view.data, n)
    return TableView(view.data, view.hidden - frozenset(names))
