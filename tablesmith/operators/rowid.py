"""Row ids and duplicate removal.

Both dedup forms are aggregations, so Spark combines duplicates map-side
before the shuffle: a single id repeated across a third of the input reaches
the reducer as one partial row per task, never as one huge group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions import expressions as fx
from tablesmith.functions.tokens import NULL_HASH_TOKEN

ID = "id"


SOURCE_NAME = "tablesmith.source_name"


def source_names(df: DataFrame) -> dict[str, str]:
    """Source column -> its present name: columns that ``row_id`` moved out of the way go by their old name."""
    out = {c: c for c in df.columns}
    for f in df.schema.fields:
        if SOURCE_NAME in (f.metadata or {}):
            out[f.metadata[SOURCE_NAME]] = f.name
            out.pop(f.name, None)
    return out


def row_id(df: DataFrame, columns: Sequence[str] | None = None, *, id_col: str = ID, sep: str = "",
           null_token: str = NULL_HASH_TOKEN) -> DataFrame:
    """Add ``id_col`` = SHA-256 hex of the row's cells as text, joined with ``sep``.

    The default joins with no separator, so ``("ab","c")`` and ``("a","bc")``
    share an id; pass ``sep`` (e.g. ``"\\x1f"``) to tell them apart. Missing
    cells contribute ``null_token``. Every source column is hashed, one called
    ``id_col`` too: its values stay readable under a new name (``source_id``,
    or the first free name like it), and mappings still find it as ``id_col``.
    """
    cols = list(columns) if columns is not None else df.columns
    moved = fx.fresh(f"source_{id_col}", df.columns)
    hashed = fx.row_hash(cols, sep, null_token)
    if id_col not in df.columns:
        return df.withColumn(id_col, hashed)
    return df.select(*[fx.col(c).alias(moved, metadata={SOURCE_NAME: c}) if c == id_col else fx.col(c) for c in df.columns],
                     hashed.alias(id_col))


def dedup(df: DataFrame, keys: Sequence[str] = (ID,)) -> DataFrame:
    """One row per key; rows sharing a key are assumed equal (true for a full-row id)."""
    return df.dropDuplicates(list(keys))


def first_wins(df: DataFrame, keys: Sequence[str] = (ID,), order_by: str | Sequence[str] = "pos") -> DataFrame:
    """One row per key: the one with the smallest ``order_by`` (load position; a null position comes last).

    Written as ``min(struct(order, row))`` per key: a partial aggregate, so
    a hot key is reduced inside each task before anything is shuffled
    (a ``row_number`` window would sort the whole hot key in one task).
    Ties on the order columns are broken by the remaining columns.
    """
    keys = list(keys)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = [x for i, c in enumerate(order) for x in (fx.col(c).isNull().alias(f"n{i}"), fx.col(c).alias(f"o{i}"))]
    fields += [fx.col(c).alias(f"r{i}") for i, c in enumerate(rest)]
    best = fx.fresh("_best", df.columns)
    picked = df.groupBy(*[fx.col(k) for k in keys]).agg(F.min(F.struct(*fields)).alias(best))
    name = {**{c: f"o{i}" for i, c in enumerate(order)}, **{c: f"r{i}" for i, c in enumerate(rest)}}
    return picked.select(*[fx.col(c) if c in keys else fx.col(best)[name[c]].alias(c) for c in df.columns])
