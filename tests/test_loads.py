"""Load invariants, round trips and the table store."""

import uuid

import pytest
from pyspark.sql import functions as F

import tablesmith as ts
from tablesmith.plans.sync import SyncSpec, sync_table
from tablesmith.registry.inputs import ORDERS_MAPPING, orders_export, table
from tablesmith.session import work_path
from tablesmith.sinks.files import csv_export
from tablesmith.sources.files import csv_scan
from tests.conftest import SF001


def _name(p):
    return f"{p}_{uuid.uuid4().hex[:8]}"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_full_refresh_twice_equals_once(spark, store):
    name = _name("t_refresh")
    spec = SyncSpec(ORDERS_MAPPING, name)
    r1 = sync_table(orders_export(spark, SF001), spec, store)
    once = _rows(store.read(name))
    r2 = sync_table(orders_export(spark, SF001), spec, store)
    assert _rows(store.read(name)) == once
    assert r1.rows_loaded == r2.rows_loaded == len(once)
    assert r1.rows_read > r1.rows_loaded  # the export repeats rows
    assert r1.location != r2.location  # a new version each time


def test_failed_load_keeps_previous_version(spark, store):
    name = _name("t_keep")
    spec = SyncSpec(ORDERS_MAPPING, name)
    good = orders_export(spark, SF001)
    sync_table(good, spec, store)
    before = _rows(store.read(name))
    bad = good.withColumn("o_totalprice", F.lit("1.2.3"))
    with pytest.raises(Exception):
        sync_table(bad, spec, store)
    assert _rows(store.read(name)) == before


def test_insert_ignore_twice_equals_once(spark, store):
    name = _name("t_ignore")
    o = table(spark, SF001, "orders")
    store.import_new_table(name, o.filter("o_orderkey % 3 = 0"))
    store.insert_ignore(name, o, ["o_orderkey"])
    once = _rows(store.read(name))
    store.insert_ignore(name, o, ["o_orderkey"])
    assert _rows(store.read(name)) == once == _rows(o)


def test_upsert_one_row_per_key(spark):
    o = table(spark, SF001, "orders")
    batch = o.filter("o_orderkey % 5 = 0").withColumn("o_totalprice", F.lit(1.0))
    out = ts.upsert(o, batch, ["o_orderkey"])
    assert out.count() == out.select("o_orderkey").distinct().count() == o.count()
    assert out.filter("o_orderkey % 5 = 0 and o_totalprice != 1.0").count() == 0


def test_upsert_rejects_repeated_batch_keys(spark):
    o = table(spark, SF001, "orders")
    with pytest.raises(ValueError, match="repeat"):
        ts.upsert(o, o.unionByName(o.limit(1)), ["o_orderkey"])


def test_first_wins_keeps_earliest(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("k", 2, "b"), ("j", 9, "z")],
                               "id string, pos int, v string")
    assert _rows(ts.first_wins(df, ["id"], "pos")) == [("j", 9, "z"), ("k", 1, "a")]


def test_insert_ignore_first_in_order_wins(spark):
    target = spark.createDataFrame([("a", "old")], "id string, v string")
    batch = spark.createDataFrame([("b", "2nd", 2), ("b", "1st", 1), ("a", "new", 0)], "id string, v string, pos int")
    assert _rows(ts.insert_ignore(target, batch, ["id"], order_by="pos")) == [("a", "old"), ("b", "1st")]


def test_csv_round_trip(spark):
    o = table(spark, SF001, "orders")
    path = csv_export(o, work_path(spark, "rt"))
    back = csv_scan(spark, path)
    typed = back.select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus",
        F.col("o_totalprice").cast("double"), F.col("o_orderdate").cast("timestamp_ntz"), "o_orderpriority")
    assert _rows(typed) == _rows(o)


def test_truncate_add_keeps_schema(spark, store):
    name = _name("t_trunc")
    o = table(spark, SF001, "orders")
    store.import_new_table(name, o)
    store.truncate_add(name, o.select("o_orderkey", "o_totalprice").limit(3))
    out = store.read(name)
    assert out.columns == o.columns and out.count() == 3


def test_create_table_rejects_existing(spark, store):
    name = _name("t_exists")
    store.create_table(name, "a int, b string")
    with pytest.raises(ValueError):
        store.create_table(name, "a int")
    assert store.read(name).count() == 0


def test_append_checks_columns(spark, store):
    name = _name("t_app")
    store.create_table(name, "a int, b string")
    store.append(name, spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(ValueError):
        store.append(name, spark.createDataFrame([(1,)], "zz int"))
    assert _rows(store.read(name)) == [(1, None)]


def test_bucketed_update_add_rewrites_only_touched_buckets(spark, store):
    o = table(spark, SF001, "orders")
    plain, bucketed = _name("t_plain"), _name("t_bucketed")
    store.import_new_table(plain, o)
    store.import_new_table(bucketed, o, bucket_keys=["o_orderkey"], buckets=16)
    assert store.read(bucketed).columns == o.columns
    before = store.bucket_parts(bucketed)
    assert len(before) == 16
    batch = o.filter("o_orderkey in (3, 4)").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    batch = batch.unionByName(spark.createDataFrame([(10_000_000, 1.0)], "o_orderkey bigint, o_totalprice double"))
    store.update_add(plain, batch, ["o_orderkey"])
    store.update_add(bucketed, batch, ["o_orderkey"])
    assert _rows(store.read(bucketed)) == _rows(store.read(plain))
    after = store.bucket_parts(bucketed)
    moved = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(moved) <= 3  # only the buckets of the three batch keys


def test_bucketed_insert_ignore_and_append(spark, store):
    o = table(spark, SF001, "orders")
    name = _name("t_bucket_ins")
    store.create_table(name, o.schema, bucket_keys=["o_orderkey"], buckets=8)
    store.append(name, o.filter("o_orderkey % 2 = 0"))
    store.insert_ignore(name, o, ["o_orderkey"])
    store.insert_ignore(name, o, ["o_orderkey"])
    assert _rows(store.read(name)) == _rows(o)
    copy = name + "_copy"
    store.save_as(name, copy)
    assert store.layout(copy) == store.layout(name)
    store.full_refresh(copy, o.limit(5))
    assert store.layout(copy).bucketed and store.read(copy).count() == 5


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_view_export_and_import_formats(spark, store, fmt):
    from tablesmith.sinks.files import view_export
    from tablesmith.sources.files import read_file
    o = table(spark, SF001, "orders")
    path = view_export(o, work_path(spark, "fmt", fmt), fmt)
    schema = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")
    opts = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"} if fmt == "csv" else None
    back = read_file(spark, path, fmt, auto_identify=False, schema=None if fmt == "parquet" else schema, options=opts)
    name = _name(f"t_{fmt}")
    store.import_new_table(name, back)
    assert _rows(store.read(name)) == _rows(o)


def test_auto_identify_infers_types(spark):
    from tablesmith.sources.files import read_file
    o = table(spark, SF001, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = csv_export(o, work_path(spark, "auto"))
    types = dict(read_file(spark, path, "csv", auto_identify=True).dtypes)
    assert types == {"o_orderkey": "int", "o_totalprice": "double", "o_orderstatus": "string"}


def test_load_history_records_every_write(spark):
    from tablesmith.sinks.tables import TableStore
    st = TableStore(spark, work_path(spark, "hist"))
    assert st.last_load("nothing") is None
    o = table(spark, SF001, "orders")
    name = _name("t_hist")
    st.import_new_table(name, o.filter("o_orderkey % 2 = 0"))
    st.append(name, o.filter("o_orderkey % 2 = 1"))
    st.insert_ignore(name, o, ["o_orderkey"])
    st.update_add(name, o.filter("o_orderkey < 10"), ["o_orderkey"])
    modes = [(r["mode"], r["rows_written"]) for r in st.load_history(name).collect()]
    n = o.count()
    assert modes == [("import_new", o.filter("o_orderkey % 2 = 0").count()),
                     ("append", o.filter("o_orderkey % 2 = 1").count()), ("insert_ignore", 0), ("updateadd", n)]
    last = st.last_load(name)
    assert last["mode"] == "updateadd" and last["location"] == st.location(name).replace("file:", "")
    st.full_refresh(name, o.select("o_orderkey"))  # schema change: the table is re-created, history kept
    assert [r["mode"] for r in st.load_history(name).collect()][-2:] == ["updateadd", "full_refresh"]


def test_copy_tables_to_another_database(spark, store):
    o = table(spark, SF001, "orders")
    name = _name("t_copy")
    store.import_new_table(name, o)
    dest = _name("db")
    out = store.copy_tables([name], dest)
    assert _rows(store.read(out[name])) == _rows(o)


def test_partial_upsert_sets_given_columns_only(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, x double")
    b = spark.createDataFrame([(2, None), (3, 9.0)], "k int, x double")
    assert _rows(ts.upsert(t, b, ["k"])) == [(1, "a", 1.0), (2, "b", None), (3, None, 9.0)]


@pytest.mark.parametrize("bound", [10**6, 0])
def test_upsert_keeps_repeated_batch_keys_when_asked(spark, bound):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, x double")
    whole = spark.createDataFrame([(2, "c", 3.0), (2, "d", 4.0), (5, "e", 5.0), (5, "e", 5.0)], t.schema)
    ask = dict(keys=["k"], repeats=True, broadcast_max_rows=bound)
    assert _rows(ts.upsert(t, whole, **ask)) == [(1, "a", 1.0), (2, "c", 3.0), (2, "d", 4.0), (5, "e", 5.0), (5, "e", 5.0)]
    some = sorted(map(tuple, ts.upsert(t, whole.select("x", "k"), **ask).collect()), key=str)
    assert some == [(1, "a", 1.0), (2, "b", 3.0), (2, "b", 4.0), (5, None, 5.0), (5, None, 5.0)]
    with pytest.raises(ValueError, match="null"):
        ts.upsert(t, spark.createDataFrame([(None, "z", 1.0)], t.schema), **ask)


def test_bucketed_update_add_still_checks_batch_keys(spark, store):
    o = table(spark, SF001, "orders")
    name = _name("t_bucket_dup")
    store.import_new_table(name, o, bucket_keys=["o_orderkey"], buckets=8)
    dup = o.filter("o_orderkey = 3").select("o_orderkey", "o_totalprice")
    with pytest.raises(ValueError, match="repeat"):
        store.update_add(name, dup.unionByName(dup), ["o_orderkey"])
    assert _rows(store.read(name)) == _rows(o)


@pytest.mark.parametrize("buckets", [None, 4])
@pytest.mark.parametrize("bound", [10**6, 0])
def test_update_add_keeps_repeated_batch_keys_when_asked(spark, store, buckets, bound):
    name = _name("t_repeats")
    store.import_new_table(name, spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, x double"),
                           **({"bucket_keys": ["k"], "buckets": buckets} if buckets else {}))
    batch = spark.createDataFrame([(2, 3.0), (2, 4.0), (5, 5.0), (5, 5.0)], "k int, x double")
    store.update_add(name, batch, ["k"], repeats=True, broadcast_max_rows=bound)
    want = [(1, "a", 1.0), (2, "b", 3.0), (2, "b", 4.0), (5, None, 5.0), (5, None, 5.0)]
    assert sorted(map(tuple, store.read(name).collect()), key=str) == want
    load = store.last_load(name)
    assert (load.updated, load.added) == (1, 3)
    with pytest.raises(ValueError, match="null"):
        store.update_add(name, spark.createDataFrame([(None, 1.0)], "k int, x double"), ["k"], repeats=True)


# -- safe publishing -----------------------------------------------------------------
def test_failed_schema_change_keeps_the_table(spark, store):
    """A refresh that the catalog or the writer refuses leaves the table as it was; odd nested names load."""
    name = _name("t_nested")
    store.import_new_table(name, spark.createDataFrame([(1, "a")], "a int, b string"))
    nested = spark.createDataFrame([((1,),)], "s struct<`x y`:int>")
    store.full_refresh(name, nested)
    assert store.read(name).first()["s"]["x y"] == 1 and spark.table(name).count() == 1
    broken = nested.withColumn("boom", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        store.full_refresh(name, broken)
    assert store.read(name).columns == ["s"] and spark.table(name).columns == ["s"]


def test_swap_failure_leaves_a_readable_table(spark, store, monkeypatch):
    """The writer dies after its commit, before the view is replaced: nothing is lost, the next load repairs the view."""
    name, o = _name("t_die"), table(spark, SF001, "orders")
    store.import_new_table(name, o.filter("o_orderkey % 2 = 0"))
    monkeypatch.setattr(type(store), "_swap", lambda self, n: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        store.append(name, o.filter("o_orderkey % 2 = 1"))
    monkeypatch.undo()
    assert store.read(name).count() == o.count()
    store.append(name, o.limit(1))
    assert spark.table(name).count() == o.count() + 1


def test_bucketed_update_add_is_all_or_nothing(spark, store, monkeypatch):
    """A writer that dies before its commit changes no bucket."""
    name, o = _name("t_atomic"), table(spark, SF001, "orders")
    store.import_new_table(name, o, bucket_keys=["o_orderkey"], buckets=8)
    monkeypatch.setattr(type(store), "_commit", lambda self, *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        store.update_add(name, o.select("o_orderkey", F.lit(1.0).alias("o_totalprice")), ["o_orderkey"])
    monkeypatch.undo()
    assert _rows(store.read(name)) == _rows(o) == _rows(spark.table(name))
    store.update_add(name, o.select("o_orderkey", F.lit(1.0).alias("o_totalprice")), ["o_orderkey"])
    assert {r["o_totalprice"] for r in spark.table(name).collect()} == {1.0}


@pytest.mark.parametrize("buckets", [None, 8])
def test_append_during_update_add_is_kept(spark, store, monkeypatch, buckets):
    name, o = _name("t_race"), table(spark, SF001, "orders")
    store.import_new_table(name, o, **({"bucket_keys": ["o_orderkey"], "buckets": buckets} if buckets else {}))
    added = o.limit(3).withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    write, raced = type(store)._write, []

    def slow(self, n, df, *a):
        out = write(self, n, df, *a)
        if n == name and not raced:     # another writer commits between this one's write and its commit
            raced.append(1)
            self.append(name, added)
        return out

    monkeypatch.setattr(type(store), "_write", slow)
    batch = o.filter("o_orderkey < 100").select("o_orderkey", F.lit(5.0).alias("o_totalprice"))
    store.update_add(name, batch, ["o_orderkey"])
    monkeypatch.undo()
    got = {r["o_orderkey"]: r["o_totalprice"] for r in store.read(name).collect()}
    assert len(got) == store.read(name).count() == o.count() + 3
    assert {got[r["o_orderkey"]] for r in batch.collect()} == {5.0}


def test_two_insert_ignores_add_a_key_once(spark, store, monkeypatch):
    name, o = _name("t_two"), table(spark, SF001, "orders")
    store.create_table(name, o.schema)
    write, raced = type(store)._write, []

    def slow(self, n, df, *a):
        out = write(self, n, df, *a)
        if n == name and not raced:
            raced.append(1)
            self.insert_ignore(name, o.filter("o_orderkey < 50"), ["o_orderkey"])
        return out

    monkeypatch.setattr(type(store), "_write", slow)
    store.insert_ignore(name, o, ["o_orderkey"])
    monkeypatch.undo()
    assert _rows(store.read(name)) == _rows(o)


def test_concurrent_appends_are_all_kept(spark, store):
    from concurrent.futures import ThreadPoolExecutor
    name = _name("t_threads")
    store.create_table(name, "a int")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: store.append(name, spark.createDataFrame([(k,)], "a int")), range(4)))
    assert _rows(store.read(name)) == [(k,) for k in range(4)] == _rows(spark.table(name))


def test_history_is_whole_and_loads_are_found_by_id(spark, store):
    name = _name("t_many")
    store.create_table(name, "a int")
    for k in range(13):
        store.append(name, spark.createDataFrame([(k,)], "a int"))
    history = store.load_history(name).collect()
    assert [h["mode"] for h in history] == ["create"] + ["append"] * 13
    first = store.load_details(name, history[0]["load_id"])
    assert first["mode"] == "create" and store.load_details(name, "no such load") is None


def test_update_counts_and_compaction(spark, store):
    name, o = _name("t_counts"), table(spark, SF001, "orders")
    store.import_new_table(name, o, bucket_keys=["o_orderkey"], buckets=4)
    batch = o.filter("o_orderkey < 100").unionByName(o.filter("o_orderkey < 50").withColumn("o_orderkey", F.col("o_orderkey") + 10**8))
    n, m = o.filter("o_orderkey < 100").count(), o.filter("o_orderkey < 50").count()
    store.update_add(name, batch, ["o_orderkey"])
    assert (store.last_load(name)["updated"], store.last_load(name)["added"]) == (n, m)
    store.append(name, o.limit(0))
    before = _rows(store.read(name))
    store.compact(name)
    assert store.n_parts(name) == 1 and _rows(store.read(name)) == before == _rows(spark.table(name))
    gone = store.expire_versions(name, keep=1)
    assert gone and _rows(store.read(name)) == before and store.expire_versions(name, keep=1) == gone


def test_bucketed_files_are_bounded(spark, store):
    """About one file per bucket, however many tasks write."""
    import glob
    name = _name("t_files")
    wide = spark.range(0, 20_000, 1, 8).selectExpr("id as k", "cast(id as string) as v")
    store.import_new_table(name, wide, bucket_keys=["k"], buckets=16)
    files = glob.glob(store.location(name).replace("file:", "") + "/*/*.parquet")
    assert 16 <= len(files) <= 32


def test_bucket_column_name_may_be_taken(spark, store):
    name = _name("t_taken")
    df = spark.createDataFrame([(1, 7), (2, 8)], "k int, _bucket int")
    store.import_new_table(name, df, bucket_keys=["k"], buckets=2)
    store.update_add(name, spark.createDataFrame([(2, 9)], "k int, _bucket int"), ["k"])
    assert _rows(store.read(name)) == [(1, 7), (2, 9)]


def test_location_column_and_foreign_names(spark, store):
    name = _name("t_loc")
    store.import_new_table(name, spark.createDataFrame([("x",)], "Location string"))
    assert "/v-" in store.location(name)
    other = _name("t_foreign")
    spark.sql(f"create table {other} (a int) using parquet")
    with pytest.raises(ValueError):
        store.full_refresh(other, spark.createDataFrame([(1,)], "a int"))
    assert spark.table(other).count() == 0


def _counted(spark, df):
    """``df`` with a column that counts how often its rows are computed."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def tick(x):
        seen.add(1)
        return x

    return df.withColumn("o_custkey", tick.asNondeterministic()("o_custkey")), seen


@pytest.mark.parametrize("what", ["update_add", "update_add_some", "insert_ignore", "upsert"])
@pytest.mark.parametrize("buckets", [None, 4])
def test_a_batch_is_computed_once(spark, store, what, buckets):
    o = table(spark, SF001, "orders")
    batch, seen = _counted(spark, o.filter("o_orderkey < 200"))
    name = _name("t_once")
    if what != "upsert":
        store.import_new_table(name, o.filter("o_orderkey % 2 = 0"),
                               **({"bucket_keys": ["o_orderkey"], "buckets": buckets} if buckets else {}))
    if what == "insert_ignore":
        store.insert_ignore(name, batch, ["o_orderkey"])
    elif what == "upsert":
        ts.upsert(o, batch, ["o_orderkey"]).write.format("noop").mode("overwrite").save()
    else:
        store.update_add(name, batch if what == "update_add" else batch.select("o_orderkey", "o_custkey"), ["o_orderkey"])
    assert seen.value == o.filter("o_orderkey < 200").count()


def test_null_keys_are_rejected(spark, store):
    name = _name("t_null")
    store.create_table(name, "id string, a int")
    for _ in range(2):
        with pytest.raises(ValueError, match="null"):
            store.insert_ignore(name, spark.createDataFrame([(None, 1), ("x", 2)], "id string, a int"))
    assert store.read(name).count() == 0


def test_large_partial_upsert_is_one_join(spark):
    o = table(spark, SF001, "orders")
    batch = o.filter("o_orderkey % 3 = 0").select("o_orderkey", F.lit(None).cast("double").alias("o_totalprice")) \
        .unionByName(o.filter("o_orderkey < 30").select((F.col("o_orderkey") + 10**7).alias("o_orderkey"), "o_totalprice"))
    small, large = (ts.upsert(o, batch, ["o_orderkey"], broadcast_max_rows=n) for n in (10**6, 0))
    assert large._jdf.queryExecution().executedPlan().toString().count("Join ") == 1
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
