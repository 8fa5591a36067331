"""Changes of stored tables, refresh by difference, shared scans, loads by id, and CSV files read in blocks."""

import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

import tablesmith as ts
from tablesmith.plans import jobs as jobplan
from tablesmith.plans.sync import SyncSpec, sync_table
from tablesmith.registry.inputs import ORDERS_MAPPING, orders_export, shared_jobs_frame, table
from tablesmith.registry.spark import QUERIES
from tablesmith.session import work_path
from tablesmith.sinks.tables import TableStore
from tablesmith.sources.files import csv_records, csv_scan
from tests.conftest import SF001


def _name(p):
    return f"{p}_{uuid.uuid4().hex[:8]}"


def _rows(df):
    return sorted(map(str, df.collect()))


def _parts(store, name):
    return [p.path for p in store.version(name).parts]


@pytest.fixture
def three(spark, store):
    """Orders in three parts."""
    o, name = table(spark, SF001, "orders"), _name("t_three")
    store.import_new_table(name, o.filter("o_orderkey % 3 = 0"))
    for k in (1, 2):
        store.append(name, o.filter(f"o_orderkey % 3 = {k}"))
    return name, o


# -- rows ------------------------------------------------------------------------------------
def test_only_parts_with_a_hit_are_written(spark, store, three):
    name, o = three
    before = _parts(store, name)
    done = store.update_where(name, {"o_orderstatus": "U"}, "o_orderkey % 3 = 1 and o_totalprice > 1000")
    n = o.filter("o_orderkey % 3 = 1 and o_totalprice > 1000").count()
    assert done == {"columns": ["o_orderstatus"], "updated_rows": n} and n
    after = _parts(store, name)
    assert before[0] in after and before[2] in after and before[1] not in after and len(after) == 3
    want = ts.update_where(o, {"o_orderstatus": "U"}, "o_orderkey % 3 = 1 and o_totalprice > 1000")
    assert _rows(store.read(name)) == _rows(want) == _rows(spark.table(name))
    assert store.last_load(name)["updated"] == n and store.last_load(name)["rows_written"] == o.filter("o_orderkey % 3 = 1").count()


def test_whole_parts_go_and_nothing_hit_writes_nothing(spark, store, three):
    name, o = three
    version = store.version(name).number
    assert store.delete_where(name, "o_orderkey < 0") == 0 and store.update_where(name, {"o_custkey": 1}, "o_custkey is null")["updated_rows"] == 0
    assert store.version(name).number == version
    assert store.delete_where(name, "o_orderkey % 3 = 2") == o.filter("o_orderkey % 3 = 2").count()
    assert len(_parts(store, name)) == 2
    n = store.read(name).count()
    assert store.delete_where(name, None) == n and store.read(name).count() == 0 and store.read(name).columns == o.columns
    store.append(name, o)
    assert _rows(store.read(name)) == _rows(o)
    assert store.delete_where(name, "nullif(o_orderstatus, 'F') = 'O'") == o.filter("o_orderstatus = 'O'").count()      # null criteria: kept


@pytest.mark.parametrize("change", ["update", "delete", "key"])
def test_only_buckets_with_a_hit_are_written(spark, store, change):
    name, o = _name("t_hit"), table(spark, SF001, "orders")
    store.import_new_table(name, o, bucket_keys=["o_orderkey"], buckets=16)
    before, criteria = store.bucket_parts(name), "o_orderkey in (3, 5)"
    if change == "update":
        store.update_where(name, {"o_custkey": F.col("o_custkey") + 1}, criteria)
        want = ts.update_where(o, {"o_custkey": F.col("o_custkey") + 1}, criteria)
    elif change == "delete":
        store.delete_where(name, criteria)
        want = o.filter(f"not ({criteria})")
    else:       # a row whose key changes moves to the bucket of its new key
        store.update_where(name, {"o_orderkey": F.col("o_orderkey") + 10**7}, criteria)
        want = ts.update_where(o, {"o_orderkey": F.col("o_orderkey") + 10**7}, criteria)
        store.update_add(name, spark.createDataFrame([(10**7 + 3, 77)], "o_orderkey bigint, o_custkey bigint"), ["o_orderkey"])
        want = ts.update_where(want, {"o_custkey": 77}, f"o_orderkey = {10**7 + 3}")
    assert _rows(store.read(name)) == _rows(want) == _rows(spark.table(name))
    after = store.bucket_parts(name)
    assert 1 <= len({b for b in before if before[b] != after.get(b)}) <= 4


def test_changes_reject_unknown_columns_and_keep_the_table(spark, store, three):
    name, o = three
    for bad in (lambda: store.update_where(name, {"zz": 1}, None), lambda: store.delete_where(name, "zz = 1"), lambda: store.add_rows(name, [{"zz": 1}])):
        with pytest.raises(Exception):
            bad()
    assert _rows(store.read(name)) == _rows(o)
    assert store.add_rows(name, []) == {"columns": [], "added_rows": 0}
    assert store.add_rows(name, [{"o_orderkey": -1}, {"o_custkey": "7"}]) == {"columns": ["o_orderkey", "o_custkey"], "added_rows": 2}
    assert store.read(name).count() == o.count() + 2


def test_update_during_an_append_keeps_both(spark, store, three, monkeypatch):
    name, o = three
    write, raced = type(store)._write, []

    def slow(self, n, df, *a):
        out = write(self, n, df, *a)
        if not raced:
            raced.append(1)
            self.append(name, o.limit(3).withColumn("o_orderkey", F.col("o_orderkey") + 10**7))
        return out

    monkeypatch.setattr(type(store), "_write", slow)
    n = store.update_where(name, {"o_orderstatus": "U"}, None)["updated_rows"]
    monkeypatch.undo()
    assert n == o.count() + 3 == store.read(name).filter("o_orderstatus = 'U'").count()


# -- columns ---------------------------------------------------------------------------------------
@pytest.mark.parametrize("buckets", [None, 4])
def test_columns_change_without_rewriting(spark, store, buckets):
    name = _name("t_cols")
    df = spark.createDataFrame([(1, "x", 2.5), (2, "y", None)], "k int, a string, b double")
    store.import_new_table(name, df, **({"bucket_keys": ["k"], "buckets": buckets} if buckets else {}))
    before = _parts(store, name)
    store.rename_column(name, "a", "old_a")
    own = store.add_column(name, "a", "STRING")
    assert own != "a"                                       # the files' column of that name is another one
    store.delete_column(name, "b")
    store.add_column(name, "b", "bigint")
    assert _parts(store, name) == before
    want = [(1, "x", None, None), (2, "y", None, None)]
    for read in (store.read, spark.table):
        assert sorted(map(tuple, read(name).collect()), key=str) == sorted(want, key=str) and read(name).columns == ["k", "old_a", "a", "b"]
    store.append(name, spark.createDataFrame([(3, "new", 9)], "k int, a string, b bigint"))
    store.update_add(name, spark.createDataFrame([(2, "z", "zz"), (4, None, "q")], "k int, old_a string, a string"), ["k"])
    want = {(1, "x", None, None), (2, "z", "zz", None), (3, None, "new", 9), (4, None, "q", None)}
    assert {tuple(r) for r in store.read(name).collect()} == want == {tuple(r) for r in spark.table(name).collect()}
    store.rename_column(name, "k", "key")                   # a bucket key keeps its buckets
    store.update_add(name, spark.createDataFrame([(1, 5)], "key int, b bigint"), ["key"])
    store.rename_column(name, "a", "A")                     # only the case
    store.compact(name)
    want = {(1, "x", None, 5), (2, "z", "zz", None), (3, None, "new", 9), (4, None, "q", None)}
    assert {tuple(r) for r in store.read(name).collect()} == want and store.read(name).columns == ["key", "old_a", "A", "b"]
    assert store.update_where(name, {"A": "u"}, "b = 5")["updated_rows"] == 1
    store.truncate_add(name, store.read(name).filter("key = 1"))
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "x", "u", 5)]


def test_hidden_columns_keep_their_data(spark, store):
    name = _name("t_hide")
    store.import_new_table(name, spark.createDataFrame([(1, "x", "y")], "k int, a string, b string"))
    store.hide_columns(name, ["a"])
    assert store.read(name).columns == spark.table(name).columns == ["k", "b"] and store.read(name, hidden=True).columns == ["k", "a", "b"]
    store.append(name, spark.createDataFrame([(2, "z")], "k int, b string"))
    store.rename_column(name, "a", "c")
    store.show_columns(name, ["c"])
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == [(1, "x", "y"), (2, None, "z")]
    for wrong in (lambda: store.hide_columns(name, ["zz"]), lambda: store.hide_columns(name, ["k", "b", "c"]), lambda: store.add_column(name, "K", "STRING"),
                  lambda: store.rename_column(name, "c", "B"), lambda: store.delete_column(name, "zz")):
        with pytest.raises(ValueError):
            wrong()
    bucketed = _name("t_key")
    store.import_new_table(bucketed, spark.createDataFrame([(1, "x")], "k int, a string"), bucket_keys=["k"], buckets=2)
    with pytest.raises(ValueError, match="bucket key"):
        store.delete_column(bucketed, "k")


# -- refresh by difference ---------------------------------------------------------------------------
@pytest.mark.parametrize("buckets", [None, 8])
def test_refresh_difference_equals_a_full_refresh(spark, store, buckets):
    name, full = _name("t_diff"), _name("t_full")
    spec, whole = SyncSpec(ORDERS_MAPPING, name), SyncSpec(ORDERS_MAPPING, full)
    layout = {"bucket_keys": ["id"], "buckets": buckets} if buckets else {}
    store.create_table(name, "id string, order_no string, amount double, order_date string, priority string, status string", **layout)
    o = orders_export(spark, SF001)
    k = F.col("o_orderkey").cast("bigint")
    later = o.filter(k % 400 != 7).withColumn("o_orderstatus", F.when(k % 300 == 5, "X").otherwise(F.col("o_orderstatus")))
    for export, changes in ((o, True), (o, False), (later, True), (later, False), (o, True)):
        before = set(_parts(store, name))
        result = sync_table(export, spec, store, difference=True)
        sync_table(export, whole, store)
        assert _rows(store.read(name)) == _rows(store.read(full)) == _rows(spark.table(name))
        assert result.rows_loaded == store.read(full).count() and result.bad_numbers == {"o_totalprice": 0}
        load = store.last_load(name)
        assert (load["rows_written"] > 0) == changes == (set(_parts(store, name)) != before)
    if buckets:
        assert store.layout(name).buckets == buckets
    n = o.filter(k % 400 == 7).distinct().count() + o.filter((k % 300 == 5) & (k % 400 != 7)).distinct().count()
    assert load["added"] == n


def test_refresh_difference_writes_whole_when_it_must(spark, store):
    name = _name("t_whole")
    rows = lambda *r: spark.createDataFrame(r, "id string, v int")
    assert store.refresh_difference(name, rows(("a", 1), ("b", 2)), content="1")["added"] == 2
    store.update_where(name, {"v": 9}, "id = 'a'")          # ids no longer say what the rows are
    store.refresh_difference(name, rows(("a", 1), ("b", 2)), content="1")
    assert _rows(store.read(name)) == _rows(rows(("a", 1), ("b", 2)))
    store.refresh_difference(name, rows(("a", 5), ("b", 6)), content="2")        # another way to make rows
    assert _rows(store.read(name)) == _rows(rows(("a", 5), ("b", 6)))
    assert store.refresh_difference(name, rows(("a", 5), ("c", 7)), content="2") == {"added": 1, "removed": 1}
    with pytest.raises(ValueError, match="repeat"):
        store.refresh_difference(name, rows(("d", 1), ("d", 1), ("a", 5), ("c", 7)), content="2")
    with pytest.raises(ValueError, match="null"):
        store.refresh_difference(name, rows((None, 1), ("a", 5), ("c", 7)), content="2")
    assert store.refresh_difference(name, rows(), content="2") == {"added": 0, "removed": 2} and store.read(name).count() == 0


# -- copies ---------------------------------------------------------------------------------------------
def test_copies_share_parts_and_expire_on_their_own(spark, store, three):
    name, o = three
    copy, second = name + "_copy", name + "_second"
    parts = _parts(store, name)
    store.save_as(name, copy)
    store.save_as(copy, second)
    assert _parts(store, second) == parts and store.last_load(second)["rows_written"] == 0
    store.truncate_add(name, o.limit(2))
    assert store.expire_versions(name, keep=1) == []                         # the copies use them all
    assert _rows(store.read(copy)) == _rows(o) == _rows(spark.table(second))
    store.delete_where(copy, "o_orderkey % 3 = 1")
    store.expire_versions(copy, keep=1)
    assert _rows(store.read(second)) == _rows(o)
    store.append(second, o.limit(1))
    assert spark.table(second).count() == o.count() + 1
    store.truncate_add(second, o.limit(1))
    gone = store.expire_versions(second, keep=1)
    assert parts[1] in gone and parts[0] not in gone                         # the first copy still has two of them
    assert _rows(store.read(copy)) == _rows(o.filter("o_orderkey % 3 <> 1")) and store.read(name).count() == 2


@pytest.mark.parametrize("buckets", [None, 4])
def test_compaction_leaves_large_parts_alone(spark, store, buckets):
    name = _name("t_small")
    big = spark.range(0, 1000).selectExpr("id as k", "cast(id as string) as v")
    store.import_new_table(name, big, **({"bucket_keys": ["k"], "buckets": buckets} if buckets else {}))
    [first] = _parts(store, name)
    for i in range(5):
        store.append(name, spark.range(2000 + 3 * i, 2003 + 3 * i).selectExpr("id as k", "'new' as v"))
    store.update_add(name, spark.createDataFrame([(2001, "changed")], "k bigint, v string"), ["k"]) if buckets else None
    before, parts = _rows(store.read(name)), _parts(store, name)
    gone = store.compact_small(name)
    assert _rows(store.read(name)) == before == _rows(spark.table(name))
    assert first in _parts(store, name) and len(gone) > 2 and len(_parts(store, name)) == len(parts) - len(gone) + 1
    assert store.n_parts(name) <= 3
    one = _name("t_one")
    store.import_new_table(one, big)
    assert store.compact_small(one) == []


# -- loads by id ------------------------------------------------------------------------------------------
def test_loads_are_found_by_id(spark):
    store, name = TableStore(spark, work_path(spark, "loads")), _name("t_loads")
    store.create_table(name, "a int")
    slow = F.udf(lambda x: time.sleep(2) or x, "int")
    handle = store.start_load("append", name, spark.createDataFrame([(1,)], "a int").select(slow("a").alias("a")))
    running = handle.details()
    assert (running["status"], running["mode"], running["message"]) == ("RUNNING", "append", None)
    with pytest.raises(TimeoutError):
        handle.wait(0.01)
    done = handle.wait()
    assert (done["status"], done["rows_written"], done["load_id"]) == ("COMPLETED", 1, handle.load_id)
    failed = store.start_load("append", name, spark.createDataFrame([(1,)], "zz int"))
    found = failed.wait()
    assert found["status"] == "FAILED" and "zz" in found["message"] and found["ended_ms"] >= found["started_ms"]
    with pytest.raises(ValueError):
        store.append(name, spark.createDataFrame([(1,)], "yy int"))           # a load without a handle leaves its entry, too
    open_loads = store.open_loads(name).collect()
    assert {r["status"] for r in open_loads} == {"FAILED"} and len(open_loads) == 2 and store.read(name).count() == 1
    assert store.load_details(name, "no such load") is None
    again = TableStore(spark, store.root)                                     # from anywhere that sees the folder
    assert again.load_details(name, failed.load_id)["message"] == found["message"]


def test_a_writer_whose_claim_was_cleared_gives_up(spark, monkeypatch):
    from tablesmith.sinks import tables
    store, name = TableStore(spark, work_path(spark, "claims")), _name("t_claim")
    store.create_table(name, "a int")
    target = store._commit_file(name, 2)
    owner = type(store)._owner
    monkeypatch.setattr(type(store), "_owner", lambda self, claim: "another writer")
    assert store._create_exclusively(target, "{}") is False                   # paused between claim and rename
    monkeypatch.setattr(type(store), "_owner", owner)
    monkeypatch.setattr(tables, "STALE_CLAIM_S", 1)
    began = time.time()
    store.append(name, spark.createDataFrame([(1,)], "a int"))                # waits for the dead writer's claim to grow old
    assert time.time() - began >= 0.5 and store.read(name).count() == 1


# -- jobs ---------------------------------------------------------------------------------------------------
def test_jobs_of_one_table_share_a_scan(spark, store):
    table(spark, SF001, "customer").createOrReplaceTempView("customer")
    run = _name("")
    jobs = shared_jobs_frame(spark, SF001, run)
    rows, own = jobplan._routed(spark, "customer", jobs.collect())
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and len(own) == 24
    results, _ = jobplan.run_jobs(spark, jobs, store, pending=True)
    by = {r["job_id"]: r for r in results.collect()}
    assert {k for k, r in by.items() if r["status"] != "PASS"} == {"7"} and "no_such_column" in by["7"]["message"]
    alone, _ = jobplan.run_jobs(spark, shared_jobs_frame(spark, SF001, _name("")), store, pending=True, share=False)
    assert {r["job_id"]: r["rows_loaded"] for r in alone.collect()} == {k: r["rows_loaded"] for k, r in by.items()}
    one = store.read(f"cust_nation_3{run}")
    assert one.count() == by["3"]["rows_loaded"] == table(spark, SF001, "customer").filter("c_nationkey = 3").count()


def test_a_failing_shared_scan_leaves_the_jobs_to_themselves(spark, store):
    table(spark, SF001, "customer").createOrReplaceTempView("customer")
    jobs = shared_jobs_frame(spark, SF001, _name("")).filter("job_id in ('1', '2', '3')") \
        .withColumn("source_where", F.when(F.col("job_id") == "2", "raise_error('broken') is null").otherwise(F.col("source_where")))
    results, _ = jobplan.run_jobs(spark, jobs, store, pending=True, retries=0)
    assert {r["job_id"]: r["status"] for r in results.collect()} == {"1": "PASS", "2": "FAILED", "3": "PASS"}


@pytest.mark.parametrize("key", ["sync_jobs", "refetch"])
def test_job_queries_run_again_in_a_session(spark, key):
    assert _rows(QUERIES[key](spark, SF001)) == _rows(QUERIES[key](spark, SF001))


# -- files in blocks ------------------------------------------------------------------------------------------
def _cell(rng):
    if rng.random() < 0.3:
        return '"' + rng.choice(['a ""b"" c', "x,\ny", "line\r\nbreak\n\n\nmore", '""""', "", '"","",\n""', "é\n" * rng.randint(1, 30)]) + '"'
    return rng.choice(["plain", "1.2", "", "NA", "é", "z" * rng.randint(0, 60)])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng, path = random.Random(1), tmp_path_factory.mktemp("csv")
    for f, end in enumerate(("\n", "\r\n")):
        text = [f'a,b,"c d"{end}']
        for i in range(150):
            text.append(f"{f}-{i},{_cell(rng)},{_cell(rng)}{end}" + (end if rng.random() < 0.03 else ""))
        (path / f"f{f}.csv").write_bytes("".join(text).encode())
    return str(path)


@pytest.mark.parametrize("size", [31, 100, 777, 4096, 1 << 20])
def test_split_files_read_alike_at_every_cut(spark, folder, size):
    whole = _rows(csv_scan(spark, folder))
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        scan = csv_scan(spark, folder, split=True, with_position=True)
        rows = scan.collect()
        assert sorted(str(r) for r in scan.drop("pos").collect()) == whole
        assert [r["a"] for r in sorted(rows, key=lambda r: tuple(r["pos"]))] == [f"{f}-{i}" for f in range(2) for i in range(150)]
        if size < 4096:
            assert len({(r["pos"]["file"], r["pos"]["block"]) for r in rows}) > 2
        firsts = ts.first_wins(scan.withColumn("k", F.length("a")), ["k"], "pos").select("a")
        assert {r["a"] for r in firsts.collect()} == {"0-0", "0-10", "0-100"}
        plan = csv_records(spark, folder)
        plan.collect()
        assert size > 4096 or "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()      # lines are brought together once
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_split_files_check_their_headers(spark, folder, tmp_path):
    with pytest.raises(Exception, match="header"):
        csv_scan(spark, folder, ["a", "b", "x"], split=True).collect()
    (tmp_path / "e.csv").write_text("a,b\n")
    assert csv_scan(spark, str(tmp_path), split=True).count() == 0 and csv_scan(spark, str(tmp_path), split=True).columns == ["a", "b"]
    (tmp_path / "f.csv").write_text('a,b\n1,2,3\n')
    with pytest.raises(Exception):
        csv_scan(spark, str(tmp_path), split=True).collect()


# -- history --------------------------------------------------------------------------------------------
def test_packed_history(spark, store):
    """Loads stay known, versions kept stay readable, few commits are left; a second call finds nothing to do."""
    name = _name("t_history")
    store.create_table(name, "a int")
    for i in range(7):
        store.append(name, spark.createDataFrame([(i,)], "a int"))
    store.truncate_add(name, spark.createDataFrame([(9,)], "a int"))
    before = store.load_history(name).collect()
    assert store.pack_history(name, keep=2, least=100) == 0                 # not worth it yet
    assert store.pack_history(name, keep=2, least=5) == 7
    assert store.load_history(name).collect() == before and len(before) == 9
    commits = [f for f in store._children(f"{store._folder(name)}/_commits") if f.endswith(".json")]
    assert len(commits) == 2 and store.pack_history(name, keep=2, least=1) == 0
    store.append(name, spark.createDataFrame([(10,)], "a int"))
    assert _rows(store.read(name)) == _rows(spark.table(name)) and store.read(name).count() == 2
    assert store.pack_history(name, keep=1, least=1) == 2
    assert [r["load_id"] for r in store.load_history(name).collect()][:9] == [r["load_id"] for r in before]
    assert store.load_details(name, before[0]["load_id"])["status"] == "COMPLETED" and store.read(name).count() == 2


def test_packing_that_was_interrupted_counts_no_load_twice(spark, store):
    name = _name("t_history")
    store.create_table(name, "a int")
    for i in range(3):
        store.append(name, spark.createDataFrame([(i,)], "a int"))
    before = store.load_history(name).collect()
    own = store._folder(name)
    store._commit_loads(f"{own}/_commits").filter("number <= 2").write.json(f"{own}/_history/0000000002-dead")
    assert store.load_history(name).collect() == before
    assert store.pack_history(name, keep=1, least=1) == 3 and store.load_history(name).collect() == before


def test_a_writer_that_slept_through_packing_starts_again(spark, store):
    from tablesmith.sinks.tables import ConcurrentWrite
    name = _name("t_history")
    store.create_table(name, "a int")
    slow = store.version(name)
    for i in range(4):
        store.append(name, spark.createDataFrame([(i,)], "a int"))
    store.pack_history(name, keep=1, least=1)
    latest, current = store._latest_number, store.version
    store._latest_number, store.version = lambda n: slow.number, lambda n: slow
    try:
        with pytest.raises(ConcurrentWrite):
            store._commit(name, slow, slow.next(slow.parts, {"load_id": "x"}))
    finally:
        store._latest_number, store.version = latest, current
    assert store.read(name).count() == 4 and len(store.load_history(name).collect()) == 5


def test_packed_tables_share_parts(spark, store):
    """A part that a copy still reads outlives the packing of its own table's commits, and goes with the copy's."""
    name = _name("t_history")
    store.import_new_table(name, spark.range(5).toDF("a"))
    copy, part = name + "_copy", _parts(store, name)[0]
    store.save_as(name, copy)
    for _ in range(2):
        store.truncate_add(name, spark.range(1).toDF("a"))
    store.pack_history(name, keep=1, least=1)
    assert store.read(copy).count() == 5
    store.truncate_add(copy, spark.range(2).toDF("a"))
    assert part in store.expire_versions(copy, keep=1) and store.read(copy).count() == 2 and store.read(name).count() == 1
