"""Column mappings: validation, logical types, projection, mapping documents.

A mapping is an ordered list of ``(source_key, destination_key, data_type)``.
It describes the columns of one table, so it is metadata of bounded size
(one entry per column) and is handled on the driver as a Python list.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions import expressions as fx
from tablesmith.functions.tokens import FALLBACK_TYPE, LOGICAL_TYPES
from tablesmith.operators.rowid import ID, source_names

MAPPING_DDL = "source_key string, destination_key string, data_type string"


class MappingError(ValueError):
    """A mapping that cannot be loaded (empty, unknown source, clashing destinations)."""


@dataclass(frozen=True)
class ColumnMap:
    source_key: str
    destination_key: str
    data_type: str = "STRING"


def parse_mapping(mapping: Iterable[ColumnMap | Mapping | Sequence]) -> list[ColumnMap]:
    """Accept ColumnMap, dicts with the three keys, or 2/3-tuples."""
    out = []
    for m in mapping:
        if isinstance(m, ColumnMap):
            out.append(m)
        elif isinstance(m, Mapping):
            out.append(ColumnMap(str(m["source_key"]), str(m["destination_key"]), str(m.get("data_type") or "STRING")))
        else:
            out.append(ColumnMap(*[str(x) for x in m]))
    return out


def spark_type(data_type: str, number_type: str = "double") -> str:
    """Logical type -> Spark type name; any other spelling (``number`` too) loads as text."""
    t = LOGICAL_TYPES.get(str(data_type), FALLBACK_TYPE)
    return number_type if t == "double" else t


def validate_mapping(mapping: Sequence[ColumnMap], source_columns: Sequence[str], reserved: Sequence[str] = (ID,)) -> None:
    """Reject what the target table could not hold.

    Empty mapping; source column absent; destination equal to a reserved
    name (the row id); destinations equal up to case (Spark resolves names
    case-insensitively, so ``Amt`` and ``amt`` would collide).
    """
    if not mapping:
        raise MappingError("mapping is empty")
    have = set(source_columns)
    missing = [m.source_key for m in mapping if m.source_key not in have]
    if missing:
        raise MappingError(f"source column(s) not found: {missing}")
    res = {r.lower() for r in reserved}
    bad = [m.destination_key for m in mapping if m.destination_key.lower() in res]
    if bad:
        raise MappingError(f"destination name(s) reserved: {bad}")
    seen: dict[str, str] = {}
    for m in mapping:
        k = m.destination_key.lower()
        if k in seen:
            raise MappingError(f"destinations clash: {seen[k]!r} and {m.destination_key!r}")
        seen[k] = m.destination_key
    empty = [m.source_key for m in mapping if not m.destination_key]
    if empty:
        raise MappingError(f"empty destination name for {empty}")


def typed_column(c: Column, data_type: str, *, number_type: str = "double", on_error: str = "raise",
                 source: T.DataType | None = None) -> Column:
    """Text cell -> value of the logical type.

    NUMBER: thousands commas removed, parsed (error or null on bad text); a
    ``source`` that is numeric already is cast, without a detour through text.
    BOOLEAN: boolean spellings stored as ``true``/``false``.
    STRING, DATE and anything else: text as it is.
    """
    t = str(data_type)
    if t == "NUMBER":
        if isinstance(source, T.NumericType):
            return fx.nan_to_null(c.cast(number_type)) if number_type in ("double", "float") else c.cast(number_type)
        return fx.to_number(c, number_type, on_error)
    if t == "BOOLEAN":
        return fx.boolean_text(c.cast("string"))
    return c.cast(spark_type(t, number_type))


def type_map(df: DataFrame, mapping: Iterable, *, number_type: str = "double", on_error: str = "raise") -> DataFrame:
    """Cast each mapped source column in place to its logical type."""
    maps = parse_mapping(mapping)
    validate_mapping(maps, df.columns)
    types: dict[str, str] = {}
    for m in maps:
        prev = types.setdefault(m.source_key, m.data_type)
        if prev != m.data_type:
            raise MappingError(f"{m.source_key!r} mapped with two types ({prev}, {m.data_type}); use map_columns")
    return df.withColumns({s: typed_column(fx.col(s), t, number_type=number_type, on_error=on_error, source=df.schema[s].dataType)
                           for s, t in types.items()})


def map_columns(df: DataFrame, mapping: Iterable, *, id_col: str | None = ID, cast: bool = True,
                number_type: str = "double", on_error: str = "raise") -> DataFrame:
    """Target projection: ``id_col`` first, then each destination in mapping order.

    Unmapped source columns are dropped. With ``cast`` every entry is typed
    by its own logical type, so one source may feed several destinations. A
    source column that ``row_id`` moved out of the way is found by its own name.
    """
    maps, names = parse_mapping(mapping), source_names(df)
    validate_mapping(maps, list(names), reserved=(id_col,) if id_col else ())
    if id_col and id_col not in df.columns:
        raise MappingError(f"row id column {id_col!r} missing; run row_id first")
    cols = [fx.col(id_col)] if id_col else []
    for m in maps:
        c = fx.col(names[m.source_key])
        if cast:
            c = typed_column(c, m.data_type, number_type=number_type, on_error=on_error, source=df.schema[names[m.source_key]].dataType)
        cols.append(c.alias(m.destination_key, metadata={}))
    return df.select(*cols)


def mapping_collect(rows: DataFrame, group_cols: Sequence[str], order_col: str = "position",
                    out_col: str = "column_mapping", entry_cols: Sequence[str] | None = None) -> DataFrame:
    """Mapping rows -> one array of column entries per document.

    An entry has ``source_key, destination_key, data_type`` and then every other
    column of the rows (``entry_cols``: just these others). A document groups
    the columns of one table, so each group is bounded by a table's column
    count; order within it follows ``order_col``.
    """
    main = ["source_key", "destination_key", "data_type"]
    others = [c for c in rows.columns if c not in {*group_cols, order_col, *main}] if entry_cols is None else list(entry_cols)
    names = main + others
    placed = F.struct(fx.col(order_col).alias("place"), F.struct(*[fx.col(c).alias(c) for c in names]).alias("entry"))
    entries = fx.fresh("_entries", group_cols)
    return (rows.groupBy(*[fx.col(g) for g in group_cols])
            .agg(F.array_sort(F.collect_list(placed), lambda a, b: F.when(a["place"] < b["place"], -1)
                              .when(a["place"] > b["place"], 1).otherwise(0)).alias(entries))
            .select(*[fx.col(g) for g in group_cols], F.transform(fx.col(entries), lambda e: e["entry"]).alias(out_col)))


def mapping_document(docs: DataFrame, fields: Sequence[str], mapping_col: str = "column_mapping",
                     out_col: str = "document", pretty: bool = False) -> DataFrame:
    """Mapping documents as JSON text: ``fields`` then the mapping array."""
    opts = {"pretty": "true"} if pretty else {}
    return docs.select(*[fx.col(f) for f in fields],
                       F.to_json(F.struct(*[fx.col(f) for f in fields], fx.col(mapping_col)), opts).alias(out_col))
