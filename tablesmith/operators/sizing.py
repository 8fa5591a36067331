"""Size-checked broadcast and cheap bounded checks.

A side is hinted for broadcast only after a job has measured it: its row
count and its bytes (the text/binary length of every cell, fixed widths for
the rest) must both be under the bounds. Beyond them the join stays a
shuffle join, and AQE may still pick broadcast from measured shuffle sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.expressions import col, fresh

DEFAULT_BROADCAST_ROWS = 2_000_000
#: Raw cell bytes; the hash table of a broadcast takes several times as much.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _width(t: T.DataType) -> int | None:
    """Bytes of a fixed-width value; None for variable-width types."""
    if isinstance(t, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(t, T.ShortType):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(t, T.DecimalType):
        return 16
    if isinstance(t, T.NullType):
        return 1
    return None


def row_bytes(df: DataFrame) -> Column:
    """Bytes a row takes: cell lengths for text/binary/nested values, the type's width otherwise."""
    parts = []
    for f in df.schema.fields:
        w = _width(f.dataType)
        if w is not None:
            parts.append(F.lit(w))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(col(f.name)), F.lit(0)))
        else:
            parts.append(F.coalesce(F.octet_length(col(f.name).cast("string")), F.lit(0)))
    return reduce(lambda a, b: a + b, parts, F.lit(8)).cast("bigint")


def _count_and_bytes(df: DataFrame):
    # A plain aggregate: each task sends one partial row, so no rows move.
    # (A ``limit(n)`` first would ship up to n rows per task into a single
    # task, nearly the whole side at scale.)
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()


def fits_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> bool:
    """One aggregated job (a pruned scan of ``df``): True when both rows and bytes are in bounds."""
    if not max_rows or max_rows <= 0:
        return False
    row = _count_and_bytes(df)
    return row["n"] <= max_rows and (max_bytes is None or row["b"] <= max_bytes)


def broadcast_if_small(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a measured bound; otherwise the plain side."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def within(stats, max_rows: int | None, max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``key_stats`` figures (rows, bytes) are under the broadcast bounds."""
    if not max_rows or max_rows <= 0:
        return False
    return stats["rows"] <= max_rows and (max_bytes is None or (stats["bytes"] or 0) <= max_bytes)


def key_stats(df: DataFrame, keys: list[str], bucket: Column | None = None):
    """One job: distinct keys, repeated keys (and the worst count), rows with a null key,
    total rows and total bytes (for the broadcast bound).

    A partial-aggregated count per key, then a one-row summary. With
    ``bucket`` (a function of the keys with few values, e.g. a hash bucket),
    ``buckets`` lists the distinct values it takes, from the same job.
    """
    any_null = reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])
    n, null, size, bk = (fresh(x, keys) for x in ("_n", "_null", "_b", "_bk"))
    extra_key = [F.max(bucket).alias(bk)] if bucket is not None else []
    extra = [F.sort_array(F.collect_set(bk)).alias("buckets")] if bucket is not None else []
    per_key = df.groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias(n), F.max(any_null).alias(null), F.sum(row_bytes(df)).alias(size), *extra_key)
    return per_key.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col(n) > 1).alias("dups"),
                       F.coalesce(F.max(n), F.lit(0)).alias("mx"),
                       F.coalesce(F.sum(F.when(F.col(null), F.col(n)).otherwise(F.lit(0))), F.lit(0)).alias("nulls"),
                       F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
                       F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), *extra).first()


def assert_unique(df: DataFrame, keys: list[str], what: str, bucket: Column | None = None, *, repeats: bool = False):
    """Raise when ``keys`` are null or (unless ``repeats`` are allowed) repeat in ``df``; returns the ``key_stats`` row."""
    row = key_stats(df, keys, bucket)
    if row["nulls"]:
        raise ValueError(f"{what}: {row['nulls']} row(s) have a null in key {keys}")
    if row["dups"] and not repeats:
        raise ValueError(f"{what}: {row['dups']} key value(s) of {keys} repeat (up to {row['mx']} times)")
    return row



def unique_stats(df: DataFrame, keys: list[str], what: str, bucket: Column | None = None):
    """``key_stats`` of rows that have one row per key already: one aggregate without a shuffle. Raises on null keys."""
    any_null = reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])
    extra = [F.sort_array(F.collect_set(bucket)).alias("buckets")] if bucket is not None else []
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("nulls"),
                 F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"), *extra).first()
    if row["nulls"]:
        raise ValueError(f"{what}: {row['nulls']} row(s) have a null in key {keys}")
    return row
