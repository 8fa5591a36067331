"""Column changes, lookups, profiles, jobs."""

import pytest
from pyspark.sql import functions as F

import tablesmith as ts
from tablesmith.plans import jobs as jp
from tablesmith.registry.inputs import jobs_frame, register_views, table
from tests.conftest import SF001


def test_rename_and_delete_need_existing_columns(spark):
    df = table(spark, SF001, "part")
    with pytest.raises(ValueError):
        ts.rename_column(df, "nope", "x")
    with pytest.raises(ValueError):
        ts.rename_column(df, "p_name", "P_BRAND")
    with pytest.raises(ValueError):
        ts.delete_column(df, "nope")
    with pytest.raises(ValueError):
        ts.add_column(df, "P_NAME", "STRING")


def test_hide_show_keeps_table_order(spark):
    df = table(spark, SF001, "part")
    v = ts.hide_columns(df, ["p_name", "p_size"])
    assert v.visible().columns == ["p_partkey", "p_brand", "p_type", "p_retailprice"]
    assert ts.show_columns(v, ["p_size", "p_name"]).visible().columns == df.columns


def test_formulas_move_between_tables(spark):
    f = {"double_price": "p_retailprice * 2"}
    a = ts.apply_formulas(table(spark, SF001, "part"), f)
    b = ts.apply_formulas(table(spark, "/root/testdata/sf0.01", "part"), f)
    assert "double_price" in a.columns and "double_price" in b.columns


def test_lookup_requires_unique_parent(spark):
    c, n = table(spark, SF001, "customer"), table(spark, SF001, "nation")
    with pytest.raises(ValueError, match="repeat"):
        ts.lookup(c, "c_nationkey", n.unionByName(n), "n_nationkey", ["n_name"])


def test_lookup_keeps_every_child(spark):
    c, n = table(spark, SF001, "customer"), table(spark, SF001, "nation").filter("n_regionkey = 0")
    out = ts.lookup(c, "c_nationkey", n, "n_nationkey", ["n_name"])
    assert out.count() == c.count()
    assert out.filter(F.col("n_name").isNotNull()).count() == c.join(n, c.c_nationkey == n.n_nationkey).count()


def test_profile_exact_and_approx(spark):
    c = table(spark, SF001, "customer")
    exact = {r["col_name"]: r for r in ts.profile_table(c, exact=True).collect()}
    approx = {r["col_name"]: r for r in ts.profile_table(c).collect()}
    assert exact["c_custkey"]["n_distinct"] == c.count()
    assert abs(approx["c_custkey"]["n_distinct"] - c.count()) <= 0.05 * c.count()


def test_job_failure_is_isolated(spark, store):
    register_views(spark, SF001, "customer")
    jobs = jobs_frame(spark, SF001)
    broken = jobs.withColumn("source_sql", F.when(F.col("job_id") == "3", F.lit("select * from no_such_table"))
                             .otherwise(F.col("source_sql")))
    results, updated = jp.run_jobs(spark, broken, store, pending=True, retries=1)
    status = {r["job_id"]: r["status"] for r in results.collect()}
    assert status.pop("3") == "FAILED"
    assert set(status.values()) == {"PASS"}
    row = updated.filter("job_id = '3'").first()
    assert row["status"] == "FAILED" and "no_such_table" in row["message"].lower()


def test_due_jobs_never_picks_failed(spark):
    jobs = jobs_frame(spark, SF001)
    for pending in (True, False):
        assert jp.due_jobs(jobs, pending).filter("status = 'FAILED'").count() == 0


def test_update_job_state_reports_unknown_key(spark):
    from pyspark.sql import Observation
    jobs = jobs_frame(spark, SF001)
    miss, hit = Observation("miss"), Observation("hit")
    out = jp.update_job_state(jobs, "no-such-job", "PASS", "PASS", updated_at=1, observation=miss)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, jobs.collect()))
    assert miss.get["matched"] == 0
    jp.update_job_state(jobs, "4", "PASS", "PASS", updated_at=1, observation=hit).collect()
    assert hit.get["matched"] == 1


def test_schema_files_to_documents_and_jobs(spark):
    import json

    from tablesmith.plans.mappings import jobs_from_mappings, schema_csv_documents, schema_csv_mappings
    from tablesmith.session import work_path
    from tablesmith.sinks.files import csv_export
    root = work_path(spark, "schemas")
    n = table(spark, SF001, "nation")
    for region in (0, 1):
        rows = n.filter(F.col("n_regionkey") == region).orderBy("n_nationkey").select(
            F.col("n_name").alias("source_key"), F.lower("n_name").alias("destination_key"),
            F.lit("STRING").alias("data_type"))
        csv_export(rows, f"{root}/region_{region}", single_file=True)
    docs = {r["target_table"]: json.loads(r["document"]) for r in schema_csv_documents(spark, root).collect()}
    assert set(docs) == {"region_0", "region_1"}
    want = [r["n_name"] for r in n.filter("n_regionkey = 0").orderBy("n_nationkey").collect()]
    assert [m["source_key"] for m in docs["region_0"]["column_mapping"]] == want
    jobs = jobs_from_mappings(schema_csv_mappings(spark, root))
    assert {r["status"] for r in jobs.collect()} == {"PENDING"} and jobs.count() == 2


def test_jobs_through_csv_files_match_in_plan_export(spark, store):
    register_views(spark, SF001, "customer")
    jobs = jobs_frame(spark, SF001).filter("job_id in ('0', '3')")
    a, _ = jp.run_jobs(spark, jobs, store, pending=True)
    b, _ = jp.run_jobs(spark, jobs, store, pending=True, hop="csv")
    key = lambda df: sorted((r["job_id"], r["status"], r["rows_loaded"]) for r in df.collect())
    assert key(a) == key(b)
    assert {r["status"] for r in b.collect()} == {"PASS"}


def test_sync_counts_bad_numbers_on_the_same_pass(spark, store):
    from tablesmith.plans.sync import SyncSpec, sync_table
    df = spark.createDataFrame([("1", "1,000.5"), ("2", "x"), ("3", None)], "k string, amt string")
    res = sync_table(df, SyncSpec([("k", "key", "STRING"), ("amt", "amount", "NUMBER")], "t_bad_numbers",
                                  on_error="null"), store)
    assert res.rows_read == 3 and res.rows_loaded == 3 and res.bad_numbers == {"amt": 1}


def test_registry_status_written_back(spark, store):
    import uuid
    register_views(spark, SF001, "customer")
    name = f"registry_{uuid.uuid4().hex[:8]}"
    store.import_new_table(name, jobs_frame(spark, SF001))
    results = jp.run_registry(spark, store, name, pending=True)
    assert {r["status"] for r in results.collect()} == {"PASS"}
    after = {r["job_id"]: r["status"] for r in store.read(name).collect()}
    assert all(after[str(k)] == "PASS" for k in range(0, 25, 3))
    assert jp.due_jobs(store.read(name), pending=True).count() == 0  # nothing left pending
    assert store.last_load(name)["mode"] == "updateadd"


def test_registry_rows_added_meanwhile_stay(spark, store, monkeypatch):
    import uuid
    register_views(spark, SF001, "customer")
    name = f"registry_{uuid.uuid4().hex[:8]}"
    jobs = jobs_frame(spark, SF001)
    store.import_new_table(name, jobs.filter("job_id in ('0', '3')"))
    run, added = jp._run_one, []

    def one(*a):
        if not added:
            added.append(1)
            store.append(name, jobs.filter("job_id = '6'"))
        return run(*a)

    monkeypatch.setattr(jp, "_run_one", one)
    jp.run_registry(spark, store, name, pending=True, max_workers=1)
    assert {r["job_id"]: r["status"] for r in store.read(name).collect()} == {"0": "PASS", "3": "PASS", "6": "PENDING"}


def test_only_transient_errors_are_retried(spark, store):
    register_views(spark, SF001, "customer")
    jobs = jobs_frame(spark, SF001).filter("job_id in ('0', '3')")
    calls = []

    def source(error):
        def of(spark, job):
            calls.append(job["job_id"])
            raise error
        return of

    for error, runs in ((ValueError("bad mapping\nline two " + "x" * 2000), 1), (ConnectionError("lost"), 3)):
        calls.clear()
        results, _ = jp.run_jobs(spark, jobs, store, pending=True, retries=2, source=source(error))
        assert len(calls) == 2 * runs
        assert {r["message"] for r in results.collect()} == {str(error)}       # the whole text


def test_alerts_are_for_this_runs_failures(spark):
    jobs = jobs_frame(spark, SF001)
    results = spark.createDataFrame([("0", "FAILED", "m", 0, None, None), ("3", "PASS", "PASS", 0, 1, 1)], jp.RESULT_DDL)
    got = jp.failure_alerts(jobs, results).collect()
    assert [r["job_id"] for r in got] == ["0"] and got[0]["subject"] == "Table sync failed 01-01-1970 05:30:00"


def test_cli_sync_and_jobs(spark, store, capsys):
    import json
    import uuid

    from tablesmith import cli
    from tablesmith.session import work_path
    from tablesmith.sinks.files import csv_export
    from tablesmith.registry.inputs import orders_export
    root = store.root
    export = csv_export(orders_export(spark, SF001), work_path(spark, "cli", "export"))
    mapping = csv_export(spark.createDataFrame([("o_orderkey", "order_no", "STRING"), ("o_totalprice", "amount", "NUMBER")],
                                               "source_key string, destination_key string, data_type string"),
                         work_path(spark, "cli", "mapping"), single_file=True)
    target = f"cli_{uuid.uuid4().hex[:8]}"
    assert cli.main(["sync", "--export", export, "--mapping", mapping, "--target", target, "--root", root]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["status"] == "PASS" and out["rows_loaded"] == store.read(target).count()
    register_views(spark, SF001, "customer")
    reg = f"cli_reg_{uuid.uuid4().hex[:8]}"
    store.import_new_table(reg, jobs_frame(spark, SF001).filter("job_id in ('0', '3')"))
    assert cli.main(["jobs", "--registry", reg, "--pending", "--root", root]) == 0
    assert {r["status"] for r in store.read(reg).collect()} == {"PASS"}


def test_cut_lineage_keeps_rows(spark):
    from tablesmith.session import cut_lineage
    df = table(spark, SF001, "orders")
    for i in range(5):
        df = ts.update_where(df, {"o_orderpriority": f"P{i}"}, f"o_orderkey % 5 = {i}")
    cut = cut_lineage(df)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, df.collect()))
    assert "Scan parquet" not in cut._jdf.queryExecution().executedPlan().toString()


# -- strictness ---------------------------------------------------------------------
def _files(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_headers_must_agree(spark, tmp_path):
    from tablesmith.sources.files import csv_scan, mapping_scan, read_file
    path = _files(tmp_path, a="x,y\n1,2\n", b="y,x\n8,9\n")
    for scan in (lambda: csv_scan(spark, path), lambda: csv_scan(spark, path, ["x", "y"]), lambda: csv_scan(spark, path, multi_line=False),
                 lambda: read_file(spark, path), lambda: read_file(spark, path, schema="x int, y int")):
        with pytest.raises(Exception, match="header"):
            scan().collect()
    other = tmp_path / "maps"
    other.mkdir()
    path = _files(other, a="source_key,destination_key,data_type\ns,d,STRING\n", b="destination_key,source_key,data_type\nd2,s2,STRING\n")
    with pytest.raises(Exception, match="header"):
        mapping_scan(spark, path).collect()


def test_landing_rejects_bad_files(spark, tmp_path, store):
    import uuid
    from tablesmith.plans.sync import SyncSpec
    from tablesmith.session import work_path
    from tablesmith.streaming import landing_sync
    for k, text in enumerate(("b,a\n1,2\n", "a,b\nonly\n")):
        folder = tmp_path / str(k)
        folder.mkdir()
        spec = SyncSpec([("a", "a", "STRING"), ("b", "b", "STRING")], f"t_landed_{uuid.uuid4().hex[:8]}")
        with pytest.raises(Exception):
            landing_sync(spark, _files(folder, f=text), ["a", "b"], spec, store, checkpoint=work_path(spark, "streams")).awaitTermination()
        assert store.read(spec.target_table).count() == 0


def test_malformed_records_fail(spark, tmp_path):
    from tablesmith.sources.files import csv_scan, parse_text_rows, read_file
    (tmp_path / "x.json").write_text('{"a": 1}\n{oops\n')
    with pytest.raises(Exception):
        read_file(spark, str(tmp_path / "x.json"), "json", schema="a int").collect()
    lines = spark.createDataFrame([("1,2",), ("1,2,3",), ("x,2",)], "line string")
    for bad in ("line = '1,2,3'", "line = 'x,2'"):
        with pytest.raises(Exception):
            parse_text_rows(lines.filter(bad), "line", "a int, b int").collect()
    assert parse_text_rows(lines.filter("line = '1,2'"), "line", "a int, b int").first() == (1, 2)
    with pytest.raises(Exception):
        csv_scan(spark, _files(tmp_path, short="a,b\nonly\n") + "/short.csv").collect()


def test_missing_tokens_in_typed_and_detected_csv(spark, tmp_path):
    from tablesmith.sources.files import read_file
    path = _files(tmp_path, f="n,t,w,z\n1,NA,2024-01-02,12D\nNA,x,N/A,1\n")
    got = read_file(spark, path)
    assert dict(got.dtypes) == {"n": "int", "t": "string", "w": "date", "z": "string"}
    assert [r["n"] for r in got.collect()] == [1, None]
    typed = read_file(spark, path, schema="n double, t string, w date, z string").collect()
    assert typed[1]["n"] is None and typed[1]["w"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_file(spark, path, schema="n int, t string, w date, z double").collect()


def test_numbers_are_strict(spark):
    from tablesmith.functions import expressions as fx
    cells = ["1,234.50", "12D", "5f", "0x1p3", " NaN", "nan", " 7 ", "-1e3", ".5", "5.", "1_000", "inf", None, "", "+3"]
    got = [tuple(r) for r in spark.createDataFrame([(c,) for c in cells], "c string").select(
        fx.to_number(F.col("c"), on_error="null"), fx.bad_number(F.col("c"))).collect()]
    assert got == [(1234.5, False), (None, True), (None, True), (None, True), (None, False), (None, False), (7.0, False),
                   (-1000.0, False), (0.5, False), (5.0, False), (None, True), (float("inf"), False), (None, False), (None, True),
                   (3.0, False)]


def test_a_source_column_called_id(spark):
    from tablesmith.plans.sync import SyncSpec, sync_rows
    df = spark.createDataFrame([("x", "ab"), ("y", "ab")], "id string, c string")
    got = ts.dedup(ts.row_id(df))
    assert got.count() == 2 and {r["source_id"] for r in got.collect()} == {"x", "y"}
    mapped = ts.map_columns(ts.row_id(df), [("id", "key", "STRING"), ("c", "c", "STRING")])
    assert {r["key"] for r in mapped.collect()} == {"x", "y"} and mapped.columns == ["id", "key", "c"]
    assert {r["key"] for r in sync_rows(df, SyncSpec([("id", "key", "STRING")], "t")).collect()} == {"x", "y"}


def test_names_of_users_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 1, 4)], "k int, _o0 int, _best int")
    assert ts.first_wins(df, ["k"], "_o0").collect() == [(1, 1, 4)]
    t = spark.createDataFrame([(1, "a", 5)], "_n int, _matched string, _new__matched int")
    batch = spark.createDataFrame([(1, "b"), (2, "c")], "_n int, _matched string")
    assert sorted(map(tuple, ts.upsert(t, batch, ["_n"]).collect()), key=str) == [(1, "b", 5), (2, "c", None)]
    child = spark.createDataFrame([(1, 9)], "_lookup_key int, x int")
    parent = spark.createDataFrame([(1, "n")], "id int, name string")
    assert ts.lookup(child, "_lookup_key", parent, "id").collect() == [(1, 9, "n")]


def test_null_positions_lose(spark):
    df = spark.createDataFrame([("a", None, "late"), ("a", 1, "first"), ("b", None, "only")], "id string, pos int, v string")
    assert sorted(map(tuple, ts.first_wins(df).collect())) == [("a", 1, "first"), ("b", None, "only")]


def test_similar_report_carries_filters(spark):
    df = spark.createDataFrame([("x", 1.0, "p"), ("x", 5.0, "q"), ("y", 9.0, "r")], "g string, v double, kind string")
    spec = ts.ReportSpec(["kind"], [("sum", "value", "total")], filters=["value > 2"])
    assert sorted(map(tuple, ts.similar_report(df, spec, {"kind": "g", "value": "v"}).collect())) == [("x", 5.0), ("y", 9.0)]


def test_time_stamps_outside_utc(spark):
    from tablesmith.functions import expressions as fx
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.sql("select timestamp_millis(1704067200123) as at, timestamp_ntz'2024-01-01 00:00:00.123' as wall")
    try:
        for z in ("Asia/Kolkata", "UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            r = df.select(fx.epoch_ms(F.col("at"), instant=True), fx.epoch_ms(F.col("wall")),
                          fx.zone_text(F.col("at"), instant=fx.is_instant(df, "at")), fx.zone_text(F.col("wall"), instant=fx.is_instant(df, "wall"))).first()
            assert tuple(r) == (1704067200000, 1704067200000, "01-01-2024 05:30:00", "01-01-2024 05:30:00"), z
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_mapping_documents_keep_every_header(spark, tmp_path):
    import json
    from tablesmith.plans.mappings import jobs_from_mappings, schema_csv_documents, schema_csv_mappings
    path = _files(tmp_path, t="source_key,destination_key,data_type,note,unit\na,b,STRING,n1,kg\nc,d,NUMBER,,m\n")
    doc = json.loads(schema_csv_documents(spark, path).first()["document"])
    assert doc["column_mapping"][0] == {"source_key": "a", "destination_key": "b", "data_type": "STRING", "note": "n1", "unit": "kg"}
    assert [set(e) for e in json.loads(jobs_from_mappings(schema_csv_mappings(spark, path)).toJSON().first())["column_mapping"]] == [
        {"source_key", "destination_key", "data_type"}] * 2


def test_many_added_rows(spark):
    import datetime
    df = spark.createDataFrame([(1, "a", 1.5, datetime.date(2024, 1, 1))], "k bigint, s string, x double, d date")
    got = ts.add_rows(df, [{"k": i, "x": i, "d": "2024-02-03"} for i in range(3000)] + [{"s": 5, "k": "7"}])
    assert got.count() == 3002
    assert got.filter("k = 2999").first() == (2999, None, 2999.0, datetime.date(2024, 2, 3))
    assert got.filter("s = '5'").first()["k"] == 7


def test_a_cluster_needs_a_shared_folder():
    from tablesmith.session import shared_dir

    class Conf(dict):
        def get(self, k, d=None):
            return d

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
