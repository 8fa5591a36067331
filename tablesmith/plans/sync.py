"""Table sync: exported text -> row id -> typed, mapped columns -> one row per id -> load.

The whole path is one lazy plan: a narrow scan/projection stage (tokens,
hash, casts, rename) and one shuffle on ``id`` for the dedup, with
duplicates combined map-side first. Load metrics come from observations
on that same plan, so auditing costs no extra pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablesmith.functions import expressions as fx
from tablesmith.functions.tokens import NA_TOKENS, PASS
from tablesmith.operators.clean import null_tokens
from tablesmith.operators.mapping import ColumnMap, parse_mapping, typed_column, validate_mapping
from tablesmith.operators.rowid import ID, dedup, first_wins
from tablesmith.sinks.files import as_text


@dataclass
class SyncSpec:
    """How one exported table loads into its target."""

    mapping: Sequence[ColumnMap]
    target_table: str
    sep: str = ""
    on_error: str = "raise"
    number_type: str = "double"
    order_col: str | None = None
    na_tokens: Sequence[str] = field(default_factory=lambda: list(NA_TOKENS))

    def __post_init__(self) -> None:
        self.mapping = parse_mapping(self.mapping)


def prepare(text: DataFrame, spec: SyncSpec, observation: Observation | None = None) -> DataFrame:
    """Missing tokens -> null, id over every source column, mapped and typed columns (no dedup).

    With ``observation``: ``rows_read`` and, per NUMBER source column,
    ``bad_<column>`` (cells that are not numbers), counted on the same pass.
    """
    source_cols = [c for c in text.columns if c != spec.order_col]
    reserved = (ID, spec.order_col) if spec.order_col else (ID,)
    validate_mapping(spec.mapping, source_cols, reserved=reserved)
    df = null_tokens(text, source_cols, spec.na_tokens)
    if observation is not None:
        numbers = sorted({m.source_key for m in spec.mapping if m.data_type == "NUMBER"})
        df = df.observe(observation, F.count(F.lit(1)).alias("rows_read"),
                        *[F.count_if(fx.bad_number(fx.col(c), spec.number_type)).alias(f"bad_{c}") for c in numbers])
    # The hash covers every source column, one called ``id`` too; its values stay there for the mapping.
    cols = [fx.row_hash(source_cols, spec.sep).alias(ID)] + [
        typed_column(fx.col(m.source_key), m.data_type, number_type=spec.number_type, on_error=spec.on_error)
        .alias(m.destination_key) for m in spec.mapping]
    if spec.order_col:
        cols.append(fx.col(spec.order_col))
    return df.select(*cols)


def sync_rows(text: DataFrame, spec: SyncSpec, *, read_obs: Observation | None = None,
              load_obs: Observation | None = None) -> DataFrame:
    """The rows a sync loads: ``prepare`` then one row per id (first in load order when ``order_col``)."""
    df = prepare(text, spec, read_obs)
    if spec.order_col:
        df = first_wins(df, [ID], spec.order_col).drop(spec.order_col)
    else:
        df = dedup(df, [ID])
    if load_obs is not None:
        df = df.observe(load_obs, F.count(F.lit(1)).alias("rows_loaded"))
    return df


def text_export(df: DataFrame) -> DataFrame:
    """A table as its exported text (what a CSV export of it holds)."""
    return as_text(df)


@dataclass
class SyncResult:
    target_table: str
    status: str
    message: str
    rows_read: int | None = None
    rows_loaded: int | None = None
    location: str | None = None
    bad_numbers: dict | None = None


def sync_table(text: DataFrame, spec: SyncSpec, store, *, difference: bool = False) -> SyncResult:
    """Run one sync as a full refresh of ``spec.target_table`` in ``store``.

    ``difference`` writes only what changed since the last such sync: the id is a
    hash of the exported row, so rows with a new id are added and rows whose id is
    gone are dropped (``TableStore.refresh_difference``).
    """
    read_obs, load_obs = Observation("rows_read"), Observation("rows_loaded")
    rows = sync_rows(text, spec, read_obs=read_obs, load_obs=load_obs)
    if difference:
        how = f"{text.columns} {spec.mapping} {spec.sep!r} {spec.on_error} {spec.number_type} {spec.na_tokens}"
        store.refresh_difference(spec.target_table, rows, [ID], content=hashlib.sha256(how.encode()).hexdigest())
        path = store.location(spec.target_table)
    else:
        path = store.full_refresh(spec.target_table, rows)
    read = read_obs.get
    return SyncResult(spec.target_table, PASS, PASS, read.get("rows_read"), load_obs.get.get("rows_loaded"), path,
                      {k[4:]: v for k, v in read.items() if k.startswith("bad_")})


def mapping_from_rows(rows: Iterable) -> list[ColumnMap]:
    """Mapping entries from collected ``array<struct>`` values or dicts."""
    out = []
    for r in rows or []:
        d = r.asDict() if hasattr(r, "asDict") else dict(r)
        out.append(ColumnMap(d["source_key"], d["destination_key"], d.get("data_type") or "STRING"))
    return out
