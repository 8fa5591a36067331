"""Changes of stored tables that leave most of their files alone: rows by criteria, columns, and refresh by difference."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.expressions import col, fresh
from tablesmith.operators import columns as column_ops
from tablesmith.operators import rows as row_ops
from tablesmith.operators.rowid import ID
from tablesmith.operators.sizing import assert_unique, broadcast_if_small
from tablesmith.session import delete_path, staged
from tablesmith.sinks.loads import tracked
from tablesmith.sinks.versions import Part, Version, layout, plain


class RowChanges:
    """Update, delete and add rows of a stored table.

    One job finds which parts (of a bucketed table: which buckets) hold a row that
    the criteria takes, reading the criteria's columns only; those are written
    anew, all others keep their folders.
    """

    def _hits(self, v: Version, criteria: Column) -> list:
        """(part, bucket, n): where rows lie for which ``criteria`` holds, and how many."""
        part, bucket, n = (fresh(x, v.schema.names) for x in ("_part", "_in", "_n"))
        hit = self._placed(v, part, bucket).filter(criteria).groupBy(part, bucket).agg(F.count(F.lit(1)).alias(n))
        return [(r[part], r[bucket], r[n]) for r in hit.collect()]          # at most parts x buckets rows

    def _split(self, v: Version, hits: list) -> tuple[DataFrame, list[Part]]:
        """The rows of the places that were hit, and the parts as they are left."""
        if v.lay.bucketed:
            touched = {b for _, b, _ in hits}
            return self._frame(v, sorted(touched)), [p for p in (q.without(touched) for q in v.parts if q.live) if p]
        names = {p for p, _, _ in hits}
        own = [p for p in v.parts if p.path.rsplit("/", 1)[1] in names]
        return self._frame(replace(v, parts=tuple(own))), [p for p in v.parts if p not in own]

    def _change_rows(self, name: str, mode: str, criteria: str | Column | None, change: Callable[[DataFrame], DataFrame]) -> int:
        taken = F.lit(True) if criteria is None else F.expr(criteria) if isinstance(criteria, str) else criteria

        def work() -> int:
            started, v = int(time.time() * 1000), self._need(name)
            hits = self._hits(v, taken)
            n = sum(h[2] for h in hits)
            if n:
                rows, kept = self._split(v, hits)
                part, written = self._write(name, change(rows), v)
                counts = {"updated": n} if mode == "update_where" else {"removed": n}
                parts = [*kept, part] if written or not kept else kept
                self._commit(name, v, v.next(parts, self._load(name, mode, part, written, started, **counts)))
            return n

        return self._again(work)

    @tracked
    def update_where(self, name: str, values: Mapping[str, Any], criteria: str | Column | None) -> dict:
        """Set ``values`` where ``criteria`` holds (None: everywhere); ``{"columns": [...], "updated_rows": n}``."""
        self._check_columns(name, values)
        n = self._change_rows(name, "update_where", criteria, lambda rows: row_ops.update_where(rows, values, criteria))
        return {"columns": list(values), "updated_rows": n}

    @tracked
    def delete_where(self, name: str, criteria: str | Column | None) -> int:
        """Delete the rows where ``criteria`` holds (None: all); how many."""
        return self._change_rows(name, "delete_where", criteria, lambda rows: row_ops.delete_where(rows, criteria))

    @tracked
    def add_rows(self, name: str, rows: Sequence[Mapping[str, Any]]) -> dict:
        """Add rows given as name -> value, as one small part; ``{"columns": [...], "added_rows": n}``."""
        empty = self.spark.createDataFrame([], self._need(name).schema)
        new = row_ops.add_rows(empty, rows)
        if rows:
            self.append(name, new)
        return {"columns": list(dict.fromkeys(k for r in rows for k in r)), "added_rows": len(rows)}

    def _check_columns(self, name: str, values: Mapping[str, Any]) -> None:
        unknown = [k for k in values if k not in self._need(name).schema.names]
        if unknown:
            raise ValueError(f"unknown column(s) {unknown}")


class ColumnChanges:
    """Add, rename, delete, hide and show columns of a stored table: a commit, no file is touched.

    Files keep a column under its stored name (``Version``); a part written before
    a column was added is read with nulls there. Hidden columns keep their data:
    they leave ``read`` and the table's view.
    """

    def _reshape(self, name: str, mode: str, change: Callable[[Version], dict]) -> Version:
        def work() -> Version:
            started, v = int(time.time() * 1000), self._need(name)
            changes = {"parts": v.parts, "content": v.content} | change(v)
            parts = changes.pop("parts")
            return self._commit(name, v, v.next(parts, self._load(name, mode, None, 0, started), **changes))

        return self._again(work)

    def _empty(self, v: Version) -> DataFrame:
        return self.spark.createDataFrame([], v.schema)

    @tracked
    def add_column(self, name: str, column: str, data_type: str) -> str:
        """A new column, null in existing rows; returns its id (the name that its files use)."""
        def change(v: Version) -> dict:
            new = column_ops.add_column(self._empty(v), column, data_type).schema.fields[-1]
            taken, own, k = v.taken(), column, 1
            while own.lower() in taken:
                own, k = f"{column}_{k}", k + 1
            return {"schema": plain(T.StructType([*v.schema.fields, new])), "stored": (*v.stored, (column, own)),
                    "parts": [replace(p, lacks=(*p.lacks, own)) for p in v.parts]}

        return self._reshape(name, "add_column", change).stored_name(column)

    @tracked
    def rename_column(self, name: str, column: str, new_name: str) -> None:
        def change(v: Version) -> dict:
            schema = column_ops.rename_column(self._empty(v), column, new_name).schema
            swap = lambda names: tuple(new_name if n == column else n for n in names)
            stored = {n: s for n, s in v.stored if n != column} | {new_name: v.stored_name(column)}
            return {"schema": plain(schema), "stored": tuple(stored.items()), "hidden": swap(v.hidden),
                    "lay": replace(v.lay, keys=swap(v.lay.keys))}

        self._reshape(name, "rename_column", change)

    @tracked
    def delete_column(self, name: str, column: str) -> None:
        """Forget a column; a later one of that name has none of its data."""
        def change(v: Version) -> dict:
            schema = column_ops.delete_column(self._empty(v), column).schema
            if column in v.lay.keys:
                raise ValueError(f"column {column!r} is a bucket key")
            hidden = tuple(n for n in v.hidden if n != column)
            if len(hidden) == len(schema):
                raise ValueError("a table needs a visible column")
            return {"schema": plain(schema), "stored": tuple(x for x in v.stored if x[0] != column),
                    "hidden": hidden, "retired": (*v.retired, v.stored_name(column))}

        self._reshape(name, "delete_column", change)

    @tracked
    def hide_columns(self, name: str, names: Sequence[str]) -> None:
        def change(v: Version) -> dict:
            hidden = column_ops.hide_columns(column_ops.TableView(self._empty(v), frozenset(v.hidden)), names).hidden
            if len(hidden) == len(v.schema):
                raise ValueError("a table needs a visible column")
            return {"hidden": tuple(sorted(hidden))}

        self._reshape(name, "hide_columns", change)

    @tracked
    def show_columns(self, name: str, names: Sequence[str]) -> None:
        self._reshape(name, "show_columns", lambda v: {
            "hidden": tuple(sorted(column_ops.show_columns(column_ops.TableView(self._empty(v), frozenset(v.hidden)), names).hidden))})


class Refresh:
    """Full refresh that writes what differs."""

    @tracked
    def refresh_difference(self, name: str, df: DataFrame, keys: Sequence[str] = (ID,), *, content: str = "",
                           bucket_keys: Sequence[str] | None = None, buckets: int | None = None) -> dict:
        """Make the table hold exactly the rows of ``df``, whose ``keys`` say what a row is (a content hash): rows with new keys
        are added, rows whose key is gone are dropped, all others stay where they are. ``{"added": n, "removed": n}``.

        One join of ``df`` with the table's keys gives both (``df`` is computed
        once); only the buckets (or parts) that lose a row are written anew. The
        rows must have one row per key. ``content`` tags how keys and rows come
        about: the table is written whole when its tag, schema or bucketing differs
        or another kind of load changed it since.
        """
        started, lay = int(time.time() * 1000), layout(bucket_keys, buckets)
        v, keys = self.version(name), list(keys)
        tag = f"{','.join(keys)}|{content}"
        if v is None or v.content != tag or plain(df.schema) != v.schema or (lay is not None and lay != v.lay):
            self.publish(name, df, lay or (v.lay if v and all(k in df.columns for k in v.lay.keys) else None), "refresh_difference", tag)
            return {"added": self.last_load(name)["rows_written"], "removed": None}
        new, old = (fresh(x, df.columns) for x in ("_new", "_old"))
        stored = self._frame(v).select(*map(col, keys)).withColumn(old, F.lit(True))
        both = df.withColumn(new, F.lit(True)).join(stored, keys, "full").filter(col(new).isNull() | col(old).isNull())
        differing, path = staged(both)
        try:
            added = differing.filter(col(new).isNotNull()).select(*map(col, df.columns))
            gone = differing.filter(col(old).isNotNull()).select(*map(col, keys))
            n_added = assert_unique(added, keys, "refreshed rows")["rows"]
            n_gone = gone.count()
            self._refresh(name, v, added, gone, keys, n_added, n_gone, started, tag)
        finally:
            delete_path(self.spark, path)
        return {"added": n_added, "removed": n_gone}

    def _refresh(self, name: str, v: Version, added: DataFrame, gone: DataFrame, keys: list[str], n_added: int, n_gone: int,
                 started: int, tag: str) -> None:
        rows, parts, part, written = added, list(v.parts), None, 0
        if n_gone:
            gone = broadcast_if_small(gone)
            part_col, bucket_col = (fresh(x, v.schema.names) for x in ("_part", "_in"))
            if v.lay.bucketed and tuple(keys) == v.lay.keys:
                hits = [(None, r[0], 0) for r in gone.select(v.lay.bucket()).distinct().collect()]
            else:
                placed = self._placed(v, part_col, bucket_col).select(*map(col, keys), part_col, bucket_col)
                hits = [(*r, 0) for r in placed.join(gone, keys, "left_semi").select(part_col, bucket_col).distinct().collect()]
            own, parts = self._split(v, hits)
            rows = own.join(gone, keys, "left_anti").select(*map(col, v.schema.names)).unionByName(added)
        if n_added or n_gone:
            part, written = self._write(name, rows, v)
            parts = [*parts, part] if written or not parts else parts
        load = self._load(name, "refresh_difference", part, written, started, added=n_added, removed=n_gone)
        self._commit(name, v, v.next(parts, load, content=tag))
