"""SQL and catalog sources, with named, typed query variables."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tablesmith.functions.expressions import quote


def sql_source(spark: SparkSession, query: str, args: dict[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """Result of a SQL query as a source. ``frames`` fill ``{name}`` placeholders, ``args`` ``:name`` markers."""
    return spark.sql(query, args=args, **frames)


def select_all(spark: SparkSession, table: str) -> DataFrame:
    """Every row and column of a catalog table or view (no SQL text built from the name)."""
    return spark.table(table)


@dataclass
class Variable:
    name: str
    datatype: str
    kind: str = "static"
    value: Any = None


def _typed(datatype: str, value: Any) -> Any:
    t = datatype.upper()
    if value is None:
        return None
    if t in ("NUMBER", "DOUBLE", "FLOAT"):
        return float(value)
    if t in ("INTEGER", "INT", "BIGINT", "LONG", "POSITIVE_NUMBER"):
        return int(value)
    if t == "DECIMAL":
        return Decimal(str(value))
    if t == "DATE":
        return value if isinstance(value, _dt.date) else _dt.date.fromisoformat(str(value))
    if t == "BOOLEAN":
        return value if isinstance(value, bool) else str(value).lower() in ("true", "1", "yes")
    return str(value)


class Variables:
    """Named, typed variables for parameterised queries (``:name`` markers)."""

    def __init__(self) -> None:
        self._vars: dict[str, Variable] = {}

    def create(self, name: str, datatype: str, kind: str = "static", value: Any = None) -> str:
        if name in self._vars:
            raise ValueError(f"variable {name!r} exists")
        self._vars[name] = Variable(name, datatype.upper(), kind, _typed(datatype, value))
        return name

    def update(self, name: str, new_name: str | None = None, datatype: str | None = None, kind: str | None = None,
               value: Any = None) -> None:
        v = self._vars.pop(name)
        v.name = new_name or v.name
        v.datatype = (datatype or v.datatype).upper()
        v.kind = kind or v.kind
        v.value = _typed(v.datatype, value if value is not None else v.value)
        self._vars[v.name] = v

    def delete(self, name: str) -> None:
        del self._vars[name]

    def get_variables(self) -> list[Variable]:
        return list(self._vars.values())

    def get_variable_details(self, name: str) -> Variable:
        return self._vars[name]

    def args(self) -> dict[str, Any]:
        return {n: v.value for n, v in self._vars.items()}

    def run(self, spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
        """``spark.sql`` with the variables bound as named parameters (never spliced into the text)."""
        return spark.sql(query, args=self.args(), **frames)


def table_name(name: str) -> str:
    """Quoted multi-part table name."""
    return ".".join(quote(p) for p in name.split("."))
