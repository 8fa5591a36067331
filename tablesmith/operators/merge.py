"""Load semantics on DataFrames: append, truncate-add, update-or-add, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions import expressions as fx
from tablesmith.operators.rowid import ID, dedup, first_wins
from tablesmith.operators.sizing import DEFAULT_BROADCAST_ROWS, assert_unique, key_stats, unique_stats, within
from tablesmith.session import staged


def conform(batch: DataFrame, schema: T.StructType, *, allow_missing: bool = True) -> DataFrame:
    """Batch in the target's column order and types; absent columns null, unknown ones rejected."""
    have = set(batch.columns)
    extra = [c for c in batch.columns if c not in {f.name for f in schema.fields}]
    if extra:
        raise ValueError(f"batch column(s) {extra} not in the target")
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing and not allow_missing:
        raise ValueError(f"batch lacks column(s) {missing}")
    return batch.select(*[(fx.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in schema.fields])


def conform_batch(schema: T.StructType, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An update batch in the target's types: the keys and any subset of target columns."""
    missing_keys = [k for k in keys if k not in batch.columns]
    if missing_keys:
        raise ValueError(f"batch lacks key column(s) {missing_keys}")
    return conform(batch, T.StructType([f for f in schema.fields if f.name in set(batch.columns)]),
                   allow_missing=False)


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All target rows plus all batch rows (bag union)."""
    return target.unionByName(conform(batch, target.schema))


def truncate_add(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch rows only, in the target's schema (target rows replaced)."""
    return conform(batch, target.schema)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], *, check: bool = True, repeats: bool = False,
           broadcast_max_rows: int | None = DEFAULT_BROADCAST_ROWS, stats=None) -> DataFrame:
    """Update rows whose keys are in the batch, add the rest.

    Batch keys must be non-null and unique (checked when ``check``). With
    ``repeats`` a key may come several times: no batch row is dropped for another,
    so a whole-row batch is stored as it is, and each batch row of some columns
    gives a row with every target row of its key (one new row if it has none).
    The batch is computed once, into the shared folder, then checked, measured and
    merged (``stats``: its ``key_stats`` when the caller already stored and checked it).
    When the batch has every target column, matched target rows are
    replaced whole: ``target anti-join batch keys`` plus the batch. When it has
    some columns, only those change on matched rows and new keys get nulls
    elsewhere. A small batch (measured) is broadcast and never shuffles the
    target; a larger one is merged in one full outer join with a match flag.
    """
    keys = list(keys)
    tcols = target.columns
    if stats is None:
        batch, _ = staged(conform_batch(target.schema, batch, keys))
        stats = assert_unique(batch, keys, "upsert batch", repeats=repeats) if check else key_stats(batch, keys)
    else:
        batch = conform_batch(target.schema, batch, keys)
    small = within(stats, broadcast_max_rows)

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    if set(batch.columns) == set(tcols):
        kept = target.join(side(batch.select(*[fx.col(k) for k in keys])), on=keys, how="left_anti")
        return kept.select(*[fx.col(c) for c in tcols]).unionByName(batch.select(*[fx.col(c) for c in tcols]))
    upd_cols = [c for c in batch.columns if c not in keys]
    hit = fx.fresh("_matched", tcols)
    new = {c: fx.fresh(f"_new_{c}", tcols, [hit]) for c in upd_cols}
    changes = side(batch.select(*[fx.col(k) for k in keys], *[fx.col(c).alias(new[c]) for c in upd_cols],
                                F.lit(True).alias(hit)))
    merged = target.join(changes, on=keys, how="left" if small else "full").select(
        *[(F.when(fx.col(hit).isNotNull(), fx.col(new[c])).otherwise(fx.col(c)) if c in new else fx.col(c)).alias(c)
          for c in tcols])
    if not small:
        return merged
    return merged.unionByName(conform(_absent(target, batch, keys, True), target.schema))


def _absent(target: DataFrame, batch: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """Batch rows whose key is not in the target.

    Small batch: the target's keys stream through a semi-join against the
    broadcast batch keys; the keys found (at most one per batch key) are
    broadcast back into the anti-join, so no target key is shuffled. Large
    batch: a shuffled anti-join on the keys.
    """
    tkeys = target.select(*[fx.col(k) for k in keys])
    if not small:
        return batch.join(tkeys, on=keys, how="left_anti").select(*[fx.col(c) for c in batch.columns])
    present = tkeys.join(F.broadcast(batch.select(*[fx.col(k) for k in keys])), on=keys, how="left_semi").distinct()
    return batch.join(F.broadcast(present), on=keys, how="left_anti").select(*[fx.col(c) for c in batch.columns])


def first_per_key(batch: DataFrame, schema: T.StructType, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """The batch in the target's columns and types, one row per key (the first by ``order_by``, when given)."""
    keys = list(keys)
    if not order_by:
        return dedup(conform(batch, schema), keys)
    first = first_wins(batch, keys, order_by)
    return conform(first if order_by in schema.fieldNames() else first.drop(fx.col(order_by)), schema)


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str] = (ID,), order_by: str | None = None,
             broadcast_max_rows: int | None = DEFAULT_BROADCAST_ROWS, stats=None) -> DataFrame:
    """Batch rows (one per key) whose key is not in the target. Null keys are rejected, as a primary key does.

    The batch is reduced to one row per key and computed once, into the shared
    folder, then checked and measured (``stats``: its ``key_stats`` when the
    caller did so). A batch under the bound never shuffles the target: the
    target's keys are semi-joined against the broadcast batch keys (streamed
    once), the keys found (at most one per batch key) are broadcast back, and
    the batch is anti-joined against them. A larger batch uses a plain
    shuffled anti-join on the keys.
    """
    keys = list(keys)
    if stats is None:
        batch, _ = staged(first_per_key(batch, target.schema, keys, order_by))
        stats = unique_stats(batch, keys, "insert batch")
    return _absent(target, batch, keys, within(stats, broadcast_max_rows))


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str] = (ID,),
                  order_by: str | None = None) -> DataFrame:
    """Target plus batch rows whose key is absent (``ON CONFLICT DO NOTHING``)."""
    return target.unionByName(new_rows(target, batch, keys, order_by))
