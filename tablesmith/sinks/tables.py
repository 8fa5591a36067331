"""Versioned tables: immutable part folders behind a view that is swapped in one catalog call.

A load never touches files that readers see. It writes a new part folder,
records a commit, and points the table's view (``ALTER VIEW``, one catalog
update) at the new list of parts. Readers see the table before or after
a load, never a half of it, and a load that fails at any step before the
commit leaves the previous version as it is.

Commits are small JSON files, one per version, in the table's ``_commits``
folder: schema, layout, live parts and the load's audit entry. A commit is
created exclusively (create-if-absent of the next number), so of two writers
that started from the same version only one gets it. The other one reads the
new version and does its work again (update-add, insert-ignore) or adds its part
to it (append); whatever an append wrote stays. Commits are never rewritten or
trimmed: they are the load history. Exclusive creation is what the shared
folder's file system has to offer (HDFS and local file systems do).

A table may be *key-bucketed*: its parts are partitioned by
``pmod(xxhash64(keys), n)``. An update-add or insert-ignore on those keys reads
only the buckets that the batch touches; an update-add writes those buckets
anew, and one commit makes the new part live for all of them at once and the old
parts dead for them. Rows are brought together by bucket before they are
written, so a load leaves about one file per bucket. ``compact`` rewrites a
table of many parts as one. ``save_as`` makes a table of the same parts;
``expire_versions`` deletes parts that no version still kept uses, of the table
itself or of one that shares them. Row and column changes and the refresh by
difference are in ``changes``, the entries of running and failed loads in
``loads``.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.expressions import col, fresh, quote
from tablesmith.operators.merge import conform, conform_batch, first_per_key, new_rows, upsert
from tablesmith.operators.rowid import ID
from tablesmith.operators.sizing import assert_unique, key_stats, unique_stats
from tablesmith.session import delete_path, staged, work_path
from tablesmith.sinks.changes import ColumnChanges, Refresh, RowChanges
from tablesmith.sinks.history import History
from tablesmith.sinks.loads import LoadJobs, load_id, tracked
from tablesmith.sinks.versions import Layout, Part, Version, layout, plain
from tablesmith.sources.sql import table_name

#: Times an update-add or insert-ignore starts again after another writer was faster.
RETRIES = 5
#: Seconds after which a claim without its commit is taken for a dead writer's (between the two lies one rename).
STALE_CLAIM_S = 60


class ConcurrentWrite(RuntimeError):
    """Another writer committed first."""


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


class TableStore(RowChanges, ColumnChanges, Refresh, LoadJobs, History):
    """Tables whose parts and commits live under ``root``, each readable by name through its view.

    ``root`` defaults to ``<spark.checkpoint.dir>/tablesmith/tables``, the
    cluster's shared folder.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, fmt: str = "parquet") -> None:
        self.spark = spark
        self.root = (root or work_path(spark, "tables", unique=False)).rstrip("/")
        self.fmt = fmt

    def with_session(self, spark: SparkSession) -> "TableStore":
        """The same store used from another session (e.g. a streaming micro-batch)."""
        return TableStore(spark, self.root, self.fmt)

    # -- commits -------------------------------------------------------------
    def _folder(self, name: str) -> str:
        return f"{self.root}/{re.sub(r'[^A-Za-z0-9_.-]', '_', name.lower())}"

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), jpath

    def _commit_file(self, name: str, number: int) -> str:
        return f"{self._folder(name)}/_commits/{number:010d}.json"

    def _latest_number(self, name: str) -> int:
        fs, path = self._fs(f"{self._folder(name)}/_commits")
        if not fs.exists(path):
            return 0
        found = [re.fullmatch(r"(\d{10})\.json", f.getPath().getName()) for f in fs.listStatus(path)]
        return max((int(m[1]) for m in found if m), default=0)

    def version(self, name: str) -> Version | None:
        """The table's current version (None: no such table)."""
        number = self._latest_number(name)
        if not number:
            return None
        v = Version.from_json(self._text(self._commit_file(name, number)))
        return None if v.load.get("mode") == "drop" else v

    def _text(self, path: str) -> str:
        fs, jpath = self._fs(path)
        stream = fs.open(jpath)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create_exclusively(self, path: str, text: str) -> bool:
        """Create the file with all of its text unless it exists; False when another writer has it.

        A claim, created if absent, decides between writers, and says whose it is.
        While another's claim stands its commit is waited for; a claim left behind
        for ``STALE_CLAIM_S`` without the file is cleared, and a writer whose claim
        was cleared so gives up.
        """
        fs, target = self._fs(path)
        fs.mkdirs(target.getParent())
        _, claim = self._fs(path + ".claim")
        owner = uuid.uuid4().hex
        while True:
            if fs.exists(target):
                return False
            try:
                out = fs.create(claim, False)
                out.write(bytearray(owner.encode()))
                out.close()
                break
            except Exception as e:
                if "AlreadyExists" not in str(e) and "already exists" not in str(e):
                    raise
            try:
                if time.time() * 1000 - fs.getFileStatus(claim).getModificationTime() > STALE_CLAIM_S * 1000:
                    fs.delete(claim, False)
            except Exception:       # gone meanwhile
                continue
            time.sleep(0.1)
        _, own = self._fs(f"{path}.{owner}.tmp")
        out = fs.create(own, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self._owner(path + ".claim") != owner or fs.exists(target):
            fs.delete(own, False)
            return False
        return bool(fs.rename(own, target))

    def _owner(self, claim: str) -> str | None:
        try:
            return self._text(claim)
        except Exception:           # cleared by another writer
            return None

    def _commit(self, name: str, base: Version | None, new: Version) -> Version:
        number = self._latest_number(name)
        if number != (base.number if base else number if self.version(name) is None else -1):
            raise ConcurrentWrite(f"table {name!r} is at version {number}")
        new = replace(new, number=number + 1)
        if not self._create_exclusively(self._commit_file(name, new.number), new.to_json()):
            raise ConcurrentWrite(f"version {new.number} of table {name!r} was taken")
        if new.number <= self._number(f"{self._folder(name)}/_expired"):        # taken long ago, expired and packed since
            fs, path = self._fs(self._commit_file(name, new.number))
            fs.delete(path, False)
            raise ConcurrentWrite(f"version {new.number} of table {name!r} was taken")
        self._swap(name)
        return new

    def _swap(self, name: str) -> None:
        """Point the name at the newest version: one catalog call, again if a newer one came meanwhile."""
        while True:
            v = self.version(name)
            if v is None:
                self.spark.sql(f"DROP VIEW IF EXISTS {table_name(name)}")
                return
            # ALTER VIEW is one catalog update; CREATE OR REPLACE would drop the view first.
            if not self.spark.catalog.tableExists(name):
                self.spark.sql(f"CREATE VIEW IF NOT EXISTS {table_name(name)} AS {self._view_sql(v)}")
            self.spark.sql(f"ALTER VIEW {table_name(name)} AS {self._view_sql(v)}")
            if self._latest_number(name) == v.number:
                return

    def _groups(self, v: Version) -> list[tuple[list[Part], tuple[int, ...] | None]]:
        """Parts that one scan reads, and the buckets to read if not all: plain parts with the same columns together, bucketed ones each."""
        if v.lay.bucketed:
            return [([p], None if p.live == p.has else p.live) for p in v.parts]
        alike: dict[tuple[str, ...], list[Part]] = {}
        for p in v.parts:
            alike.setdefault(tuple(sorted(p.lacks)), []).append(p)
        return [(parts, None) for parts in alike.values()]

    def _view_sql(self, v: Version) -> str:
        def column(f: T.StructField, lacks: tuple[str, ...]) -> str:
            own = v.stored_name(f.name)
            if own in lacks:
                return f"CAST(NULL AS {T.StructType([T.StructField('c', f.dataType)]).toDDL().split(' ', 1)[1]}) AS {quote(f.name)}"
            return quote(own) if own == f.name else f"{quote(own)} AS {quote(f.name)}"

        visible = [f for f in v.schema.fields if f.name not in v.hidden]
        selects = []
        for parts, live in self._groups(v):
            where = f" WHERE {quote(v.bucket_col)} IN ({', '.join(map(str, live))})" if live is not None else ""
            folders: dict[str, list[str]] = {}          # a table saved from another has parts in both folders
            for p in parts:
                folder, own = p.path.rsplit("/", 1)
                folders.setdefault(folder, []).append(own)
            for folder, names in folders.items():
                path = f"{folder}/{names[0]}" if len(names) == 1 else f"{folder}/{{{','.join(names)}}}"
                selects.append(f"SELECT {', '.join(column(f, parts[0].lacks) for f in visible)} FROM {self.fmt}.`{path}`{where}")
        return " UNION ALL ".join(selects)

    # -- reading ---------------------------------------------------------------
    def exists(self, name: str) -> bool:
        return self.version(name) is not None or self.spark.catalog.tableExists(name)

    def _scans(self, v: Version, buckets: Sequence[int] | None = None) -> list[DataFrame]:
        """The stored rows of each group of parts, under their stored names."""
        fields = [T.StructField(v.stored_name(f.name), f.dataType) for f in v.schema.fields]
        schema = T.StructType([*fields, *([T.StructField(v.bucket_col, T.IntegerType())] if v.bucket_col else [])])
        frames = []
        for parts, live in self._groups(v):
            df = self.spark.read.schema(schema).format(self.fmt).load([p.path for p in parts])
            if live is not None:
                df = df.filter(col(v.bucket_col).isin(list(live)))
            if buckets is not None:
                df = df.filter(col(v.bucket_col).isin(list(buckets)))
            frames.append(df)
        return frames

    def _frame(self, v: Version, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of a version (of the given buckets only), hidden columns too, without its bucket column."""
        columns = [col(v.stored_name(f.name)).alias(f.name) for f in v.schema.fields]
        return _union([df.select(*columns) for df in self._scans(v, buckets)])

    def _placed(self, v: Version, part: str, bucket: str) -> DataFrame:
        """The rows with the name of their part's folder and their bucket (null where there are none)."""
        where = F.regexp_extract(F.col("_metadata.file_path"), r"/(v-[0-9]+-[0-9a-f]+)/[^/]*(?:/[^/]*)?$", 1).alias(part)
        own = (col(v.bucket_col) if v.bucket_col else F.lit(None).cast("int")).alias(bucket)
        return _union([df.select(*[col(v.stored_name(f.name)).alias(f.name) for f in v.schema.fields], where, own) for df in self._scans(v)])

    def read(self, name: str, hidden: bool = False) -> DataFrame:
        """The table's current rows (with ``hidden``, its hidden columns too). A name that is no table of this store is read
        from the catalog."""
        v = self.version(name)
        if v is None:
            return self.spark.table(table_name(name))
        rows = self._frame(v)
        return rows if hidden or not v.hidden else rows.select(*[col(f.name) for f in v.schema.fields if f.name not in v.hidden])

    def _need(self, name: str) -> Version:
        v = self.version(name)
        if v is None:
            raise ValueError(f"no table {name!r}")
        return v

    def layout(self, name: str) -> Layout:
        v = self.version(name)
        return v.lay if v else Layout()

    def location(self, name: str) -> str | None:
        """The folder that the table's last load wrote (None: no such table)."""
        v = self.version(name)
        return v.load.get("location") if v else None

    def bucket_parts(self, name: str) -> dict[int, list[str]]:
        """Bucket -> part folders that hold its live rows."""
        out: dict[int, list[str]] = {}
        for p in self._need(name).parts:
            for b in p.live or ():
                out.setdefault(b, []).append(p.path)
        return out

    def last_load(self, name: str):
        """Details of the table's most recent load, or None."""
        v = self.version(name)
        return Row(**v.load) if v else None

    # -- writing -----------------------------------------------------------------
    def drop(self, name: str) -> None:
        """Forget the table; its folders and its history are kept."""
        v = self.version(name)
        if v is not None:
            self._commit(name, v, Version(0, v.schema, Layout(), None, (), {"mode": "drop"}))

    def _write(self, name: str, df: DataFrame, v: Version) -> tuple[Part, int]:
        """``df``, with the version's columns, as a new part folder of its layout; (part, rows)."""
        obs = Observation(f"load_{uuid.uuid4().hex}")
        path = f"{self._folder(name)}/v-{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        columns = [col(f.name).alias(v.stored_name(f.name)) for f in v.schema.fields]
        if not v.lay.bucketed:
            df.select(*columns).observe(obs, F.count(F.lit(1)).alias("rows")).write.format(self.fmt).save(path)
            return Part(path), self._observed(obs, path)
        # Rows of a bucket come together before they are written (a large bucket is split by Spark).
        rows = df.select(*columns, v.lay.bucket().alias(v.bucket_col)).observe(obs, F.count(F.lit(1)).alias("rows")) \
            .hint("rebalance", col(v.bucket_col))
        rows.write.format(self.fmt).partitionBy(v.bucket_col).save(path)
        fs, jpath = self._fs(path)
        found = [re.fullmatch(r".*=(\d+)", f.getPath().getName()) for f in fs.listStatus(jpath)]
        has = tuple(sorted(int(m[1]) for m in found if m))
        if not has:     # no rows: a folder without files has no schema of its own
            df.limit(0).select(*columns, F.lit(0).alias(v.bucket_col)).write.format(self.fmt).mode("overwrite").save(path)
            return Part(path, has, has), 0
        return Part(path, has, has), self._observed(obs, path)

    def _observed(self, obs: Observation, path: str) -> int:
        """Rows written; counted from the files where Spark's optimiser took the observation out with an empty plan."""
        try:
            return obs.get.get("rows") or 0
        except Py4JError:
            return self.spark.read.format(self.fmt).load(path).count()

    def _load(self, name: str, mode: str, part: Part | None, rows: int, started: int, updated: int | None = None,
              added: int | None = None, removed: int | None = None) -> dict:
        return {"load_id": load_id(), "table_name": name, "mode": mode, "location": part.path if part else None,
                "rows_written": rows, "updated": updated, "added": added, "removed": removed, "started_ms": started,
                "ended_ms": int(time.time() * 1000)}

    def _check_free(self, name: str) -> None:
        if self.version(name) is None and self.spark.catalog.tableExists(name):
            raise ValueError(f"{name!r} is a table or view that this store did not make")

    def _again(self, work: Callable[[], str]) -> str:
        """Run ``work`` on the current version; again when another writer committed meanwhile."""
        for left in range(RETRIES, -1, -1):
            try:
                return work()
            except ConcurrentWrite:
                if not left:
                    raise
                time.sleep(0.2 * (RETRIES + 1 - left))
        raise AssertionError

    def publish(self, name: str, df: DataFrame, lay: Layout | None = None, mode: str = "publish", content: str | None = None,
                like: Version | None = None) -> str:
        """Write ``df`` as the table's next version, replacing all its rows (``like``: under that version's columns)."""
        started, lay = int(time.time() * 1000), lay or Layout()
        self._check_free(name)
        missing = [k for k in lay.keys if k not in df.columns]
        if missing:
            raise ValueError(f"bucket key(s) {missing} not in the table")
        new = like or Version(0, plain(df.schema), lay, fresh("_bucket", df.columns) if lay.bucketed else None, ())
        part, rows = self._write(name, df, new)
        return self._again(lambda: self._commit(name, self.version(name), new.next(
            [part], self._load(name, mode, part, rows, started), content=content)).load["location"])

    # -- load modes ----------------------------------------------------------------
    @tracked
    def create_table(self, name: str, schema: T.StructType | str, *, bucket_keys: Sequence[str] | None = None,
                     buckets: int | None = None) -> str:
        """Empty table from a design (StructType or DDL), optionally key-bucketed."""
        if self.exists(name):
            raise ValueError(f"table {name!r} exists")
        return self.publish(name, self.spark.createDataFrame([], schema), layout(bucket_keys, buckets), "create")

    @tracked
    def import_new_table(self, name: str, df: DataFrame, *, bucket_keys: Sequence[str] | None = None,
                         buckets: int | None = None) -> str:
        """Create the table from ``df``; fails when it exists."""
        if self.exists(name):
            raise ValueError(f"table {name!r} exists")
        return self.publish(name, df, layout(bucket_keys, buckets), "import_new")

    @tracked
    def full_refresh(self, name: str, df: DataFrame, *, bucket_keys: Sequence[str] | None = None,
                     buckets: int | None = None) -> str:
        """Replace table and schema by ``df``. The table keeps its bucketing unless a new one is given."""
        lay = layout(bucket_keys, buckets) or self.layout(name)
        if lay.bucketed and any(k not in df.columns for k in lay.keys):
            lay = Layout()
        return self.publish(name, df, lay, "full_refresh")

    @tracked
    def truncate_add(self, name: str, df: DataFrame) -> str:
        """Replace all rows, keep the table's schema and layout."""
        v = self._need(name)
        return self.publish(name, conform(df, v.schema), v.lay, "truncateadd", like=v)

    def _add_part(self, name: str, df: DataFrame, mode: str, expected: Version, rebase: bool, started: int) -> str:
        part, rows = self._write(name, df, expected)
        shape = lambda v: (v.schema, v.lay, sorted(v.stored))

        def commit() -> str:
            v = self._need(name)
            if v.number != expected.number and not (rebase and shape(v) == shape(expected)):
                raise ConcurrentWrite(f"table {name!r} changed")
            keep = v.parts if not rows else (*[p for p in v.parts if p.live is None or p.live], part)
            return self._commit(name, v, v.next(keep or (part,), self._load(name, mode, part, rows, started, 0, rows))).load["location"]

        return self._again(commit) if rebase else commit()

    @tracked
    def append(self, name: str, df: DataFrame) -> str:
        """Add rows as a new part. Another writer's commit meanwhile is kept, too."""
        v, started = self._need(name), int(time.time() * 1000)
        return self._add_part(name, conform(df, v.schema), "append", v, True, started)

    @tracked
    def update_add(self, name: str, df: DataFrame, keys: Sequence[str], **kw) -> str:
        """Update rows with matching keys, add the rest; the audit entry has both counts.

        The batch is computed once, into the shared folder. Of a table bucketed
        on ``keys`` only the buckets that the batch touches are read and written.
        With ``repeats`` a key may come several times in the batch, as in
        ``upsert``; the rows that the table gains by it count as added.
        """
        started = int(time.time() * 1000)
        batch, path = staged(conform_batch(self._need(name).schema, df, keys))
        try:
            return self._again(lambda: self._update_add(name, batch, list(keys), started, **kw))
        finally:
            delete_path(self.spark, path)

    def _update_add(self, name: str, batch: DataFrame, keys: list[str], started: int, check: bool = True,
                    repeats: bool = False, **kw) -> str:
        v = self._need(name)
        own = v.lay.bucketed and tuple(keys) == v.lay.keys
        bucket = v.lay.bucket() if own else None
        # One job checks the batch's keys, measures it and lists the buckets it touches.
        stats = (assert_unique(batch, keys, "upsert batch", bucket=bucket, repeats=repeats) if check
                 else key_stats(batch, keys, bucket=bucket))
        touched = set(stats["buckets"]) if own else None
        if own and not touched:
            return self._commit(name, v, v.next(v.parts, self._load(name, "updateadd", None, 0, started, 0, 0))).load["location"]
        part_rows = self._frame(v, sorted(touched)) if own else self._frame(v)
        part, rows = self._write(name, upsert(part_rows, batch, keys, stats=stats, **kw), v)
        kept = [p for p in (q.without(touched) for q in v.parts if q.live) if p] if own else []
        added = rows - self._count(v, sorted(touched) if own else None)
        load = self._load(name, "updateadd", part, rows, started, stats["rows"] - added, added)
        return self._commit(name, v, v.next([*kept, part], load)).load["location"]

    @tracked
    def update_matching(self, name: str, df: DataFrame, keys: Sequence[str]) -> str:
        """Set the batch's columns on the rows with its keys; keys that the table lacks are passed over."""
        started = int(time.time() * 1000)
        batch, path = staged(conform_batch(self._need(name).schema, df, keys))

        def work() -> str:
            v = self._need(name)
            present = batch.join(self._frame(v).select(*map(col, keys)), on=list(keys), how="left_semi").select(*map(col, batch.columns))
            return self._update_add(name, present, list(keys), started)

        try:
            return self._again(work)
        finally:
            delete_path(self.spark, path)

    def _count(self, v: Version, buckets: Sequence[int] | None) -> int:
        """Rows of a version (of some buckets): Parquet footers, no column is read."""
        return self._frame(v, buckets).count()

    @tracked
    def insert_ignore(self, name: str, df: DataFrame, keys: Sequence[str] = (ID,), order_by: str | None = None,
                      observation: Observation | None = None) -> str:
        """Add batch rows whose key is absent (a new part; nothing is rewritten). Null keys are rejected.

        The batch is computed and reduced to one row per key once, into the
        shared folder. Of a table bucketed on ``keys``, only the buckets that
        the batch touches are searched.
        """
        started, v = int(time.time() * 1000), self._need(name)
        batch, path = staged(first_per_key(df, v.schema, keys, order_by))
        try:
            return self._again(lambda: self._insert_ignore(name, batch, list(keys), observation, started))
        finally:
            delete_path(self.spark, path)

    def _insert_ignore(self, name: str, batch: DataFrame, keys: list[str], observation: Observation | None, started: int) -> str:
        v = self._need(name)
        own = v.lay.bucketed and tuple(keys) == v.lay.keys
        stats = unique_stats(batch, keys, "insert batch", bucket=v.lay.bucket() if own else None)
        target = self._frame(v, sorted(stats["buckets"])) if own and stats["buckets"] else self._frame(v)
        add = new_rows(target, batch, keys, stats=stats)
        if observation is not None:
            add = add.observe(observation, F.count(F.lit(1)).alias("inserted_rows"))
        return self._add_part(name, add, "insert_ignore", v, False, started)

    @tracked
    def compact(self, name: str) -> str:
        """The same rows as one part."""
        def work() -> str:
            started, v = int(time.time() * 1000), self._need(name)
            part, rows = self._write(name, self._frame(v), v)
            return self._commit(name, v, v.next([part], self._load(name, "compact", part, rows, started), content=v.content)).load["location"]
        return self._again(work)

    @tracked
    def compact_small(self, name: str) -> list[str]:
        """Bring the small parts together: from the smallest on, as long as a part has no more rows than those before it have
        together. Larger parts keep their folders, so a row is written again about as often as its part doubles. Returns the
        parts that were replaced."""
        def work() -> list[str]:
            started, v = int(time.time() * 1000), self._need(name)
            sizes: dict[str, int] = {}
            for part, _, n in self._hits(v, F.lit(True)):          # rows per part: no column is read
                sizes[part] = sizes.get(part, 0) + n
            rows = lambda p: sizes.get(p.path.rsplit("/", 1)[1], 0)
            small, total = [], 0
            for p in sorted(v.parts, key=rows):
                if len(small) > 1 and rows(p) > total:
                    break
                small.append(p)
                total += rows(p)
            if len(small) < 2:
                return []
            part, n = self._write(name, self._frame(replace(v, parts=tuple(small))), v)
            parts = [*[p for p in v.parts if p not in small], part]
            self._commit(name, v, v.next(parts, self._load(name, "compact", part, n, started), content=v.content))
            return [p.path for p in small]

        return self._again(work)

    def n_parts(self, name: str) -> int:
        return len(self._need(name).parts)

    def _uses(self, folder: str) -> list:
        """(path, last) of a table's parts: the newest version that uses each (one scan of its commits)."""
        commits = self.spark.read.schema("number bigint, parts array<array<string>>").option("pathGlobFilter", "*.json").json(f"{folder}/_commits")
        return commits.select("number", F.explode("parts").alias("p")).groupBy(F.col("p")[0].alias("path")) \
            .agg(F.max("number").alias("last")).collect()

    def _number(self, path: str) -> int:
        fs, jpath = self._fs(path)
        return int(self._text(path)) if fs.exists(jpath) else 0

    def _children(self, path: str) -> list[str]:
        fs, jpath = self._fs(path)
        return [f.getPath().getName() for f in fs.listStatus(jpath)] if fs.exists(jpath) else []

    def expire_versions(self, name: str, keep: int = 2) -> list[str]:
        """Forget all but the last ``keep`` versions and delete the part folders that no version uses any more, neither of this
        table nor of one that shares them; returns those folders. Commits stay, as the load history."""
        own = self._folder(name)
        fs, path = self._fs(f"{own}/_expired")
        out = fs.create(path, True)
        out.write(bytearray(str(max(0, self._latest_number(name) - max(1, keep))).encode()))
        out.close()
        gone = {r["path"] for r in self._uses(own)}
        owners = {p.rsplit("/", 1)[0] for p in gone}
        sharing = {own, *owners, *(f"{self.root}/{t}" for o in owners for t in self._children(f"{o}/_shared"))}
        for folder in sharing:
            expired = self._number(f"{folder}/_expired")
            gone -= {r["path"] for r in self._uses(folder) if r["last"] > expired}
        for p in sorted(gone):
            delete_path(self.spark, p)
        return sorted(gone)

    @tracked
    def save_as(self, source: str, new_name: str) -> str:
        """The table under a new name, of the same parts: no rows are written, and either may change or expire on its own."""
        if self.exists(new_name):
            raise ValueError(f"table {new_name!r} exists")
        v, started = self.version(source), int(time.time() * 1000)
        if v is None:
            return self.publish(new_name, self.read(source), None, "save_as")
        for owner in {p.path.rsplit("/", 1)[0] for p in v.parts}:         # known as a user before it uses them
            fs, mark = self._fs(f"{owner}/_shared/{self._folder(new_name).rsplit('/', 1)[1]}")
            fs.create(mark, True).close()
        load = self._load(new_name, "save_as", None, 0, started) | {"location": v.load.get("location")}
        return self._commit(new_name, None, v.next(v.parts, load, content=v.content)).load["location"]

    def copy_tables(self, names: Sequence[str], dest_database: str) -> dict[str, str]:
        """Copy tables (data and layout) into another database; returns ``name -> new name``."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(dest_database)}")
        out = {}
        for n in names:
            new = f"{dest_database}.{n.split('.')[-1]}"
            self.save_as(n, new)
            out[n] = new
        return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out
