"""What a commit of a table says: its columns, its layout and its live parts."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.expressions import col


@dataclass(frozen=True)
class Layout:
    """How a table's rows are laid out: plain, or bucketed by a hash of ``keys``."""

    keys: tuple[str, ...] = ()
    buckets: int = 0

    @property
    def bucketed(self) -> bool:
        return self.buckets > 0

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")


def layout(bucket_keys: Sequence[str] | None = None, buckets: int | None = None) -> Layout | None:
    if not bucket_keys and not buckets:
        return None
    if not bucket_keys or not buckets or buckets < 1:
        raise ValueError("bucketing needs both bucket_keys and buckets >= 1")
    return Layout(tuple(bucket_keys), int(buckets))


@dataclass(frozen=True)
class Part:
    """A folder of rows; of a bucketed table, the buckets it has and those of them that are live; the stored columns that
    it was written without."""

    path: str
    has: tuple[int, ...] | None = None
    live: tuple[int, ...] | None = None
    lacks: tuple[str, ...] = ()

    def without(self, buckets: set[int]) -> Part | None:
        live = tuple(b for b in self.live if b not in buckets)
        return replace(self, live=live) if live else None


@dataclass(frozen=True)
class Version:
    """One committed state of a table.

    A column is stored in the files under a name of its own that never changes
    and is never given to another column: ``stored`` has it where it differs from
    the column's name, ``retired`` those of deleted columns. ``content`` is the
    tag of a load whose keys say what the rows are (see ``refresh_difference``).
    """

    number: int
    schema: T.StructType
    lay: Layout
    bucket_col: str | None
    parts: tuple[Part, ...]
    load: dict = field(default_factory=dict)
    stored: tuple[tuple[str, str], ...] = ()
    hidden: tuple[str, ...] = ()
    retired: tuple[str, ...] = ()
    content: str | None = None

    def stored_name(self, column: str) -> str:
        return dict(self.stored).get(column, column)

    def taken(self) -> set[str]:
        """Stored names, in lower case, that a new column must not get."""
        own = [self.stored_name(f.name) for f in self.schema.fields]
        return {n.lower() for n in (*own, *self.retired, *([self.bucket_col] if self.bucket_col else []))}

    def next(self, parts: Iterable[Part], load: dict, **changes) -> Version:
        return replace(self, **{"parts": tuple(parts), "load": load, "content": None} | changes)

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema.json(), "keys": self.lay.keys, "buckets": self.lay.buckets,
                           "bucket_col": self.bucket_col, "parts": [[p.path, p.has, p.live, p.lacks] for p in self.parts], "load": self.load,
                           "stored": self.stored, "hidden": self.hidden, "retired": self.retired, "content": self.content})

    @staticmethod
    def from_json(text: str) -> Version:
        d = json.loads(text)
        tup = lambda x: None if x is None else tuple(x)
        parts = tuple(Part(p, tup(h), tup(v), tup(*(rest or [()]))) for p, h, v, *rest in d["parts"])
        return Version(d["number"], T.StructType.fromJson(json.loads(d["schema"])), Layout(tuple(d["keys"]), d["buckets"]), d["bucket_col"],
                       parts, d["load"], tuple(map(tuple, d.get("stored", ()))), tuple(d.get("hidden", ())), tuple(d.get("retired", ())),
                       d.get("content"))


def plain(schema: T.StructType) -> T.StructType:
    """Names and types only (all nullable, no metadata): what the files hold."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
