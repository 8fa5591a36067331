"""Spark side of each registered check: the library operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablesmith as ts
from tablesmith.functions import expressions as fx
from tablesmith.functions.tokens import NA_TOKENS
from tablesmith.operators.sketches import count_error, rank_error
from tablesmith.plans import jobs as jobplan
from tablesmith.plans.sync import SyncSpec, sync_rows, sync_table
from tablesmith.registry.inputs import (EXPORT_COLUMNS, ORDERS_MAPPING, jobs_frame, mapping_rows, orders_export,
                                        register_views, shared_jobs_frame, table)
from tablesmith.session import work_path
from tablesmith.sinks.files import csv_export, view_export, write_documents
from tablesmith.sinks.tables import TableStore
from tablesmith.sources.dialects import Dialect
from tablesmith.sources.files import csv_scan, inline_rows, mapping_scan, parse_text_rows, read_file
from tablesmith.sources.sql import Variables, select_all, sql_source

Query = Callable[[SparkSession, str], DataFrame]


def _store(spark: SparkSession) -> TableStore:
    return TableStore(spark, work_path(spark, "checks"))


def _name(prefix: str) -> str:
    import uuid
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


ORDERS_SPEC = dict(mapping=ORDERS_MAPPING, target_table="orders_synced")


# -- projections / ids ----------------------------------------------------
def q_row_id(spark, sf):
    """The source has a column ``id`` of its own: hashed like any other, readable afterwards."""
    li = table(spark, sf, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("R"))) \
        .withColumnRenamed("l_linestatus", "id")
    return ts.row_id(li).select("l_orderkey", "l_linenumber", "source_id", "id")


def _odd_numbers(c):
    """Number text with spellings that load as null: no numbers (bad), and NaN (missing)."""
    k = F.col("o_orderkey")
    return (F.when(k % 17 == 0, F.lit("12D")).when(k % 19 == 0, F.lit("0x1p3")).when(k % 23 == 0, F.lit(" NaN"))
            .when(k % 29 == 0, F.lit("5f")).when(k % 31 == 0, F.concat(F.lit(" "), c, F.lit(" "))).otherwise(c))


def q_clean_numbers(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _odd_numbers(F.format_number("o_totalprice", 2)).alias("amount_text"))
    return ts.clean_numbers(o.withColumn("amount", F.col("amount_text")), ["amount"], on_error="null") \
        .withColumn("bad", fx.bad_number(F.col("amount_text")))


def q_dedup(spark, sf):
    o = table(spark, sf, "orders")
    return ts.dedup(ts.row_id(o.unionByName(o))).select("id", "o_orderkey", "o_totalprice")


def q_first_wins(spark, sf):
    """The position is missing on the first orders of each group: the others win over them."""
    o = table(spark, sf, "orders")
    keyed = ts.row_id(o, ["o_orderstatus", "o_orderpriority"]) \
        .withColumn("pos", F.when(F.col("o_orderkey") % 5 != 1, F.col("o_orderkey")))
    return ts.first_wins(keyed.select("id", "pos", "o_orderkey", "o_custkey", "o_totalprice"), ["id"], "pos")


def q_null_normalise(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    toks = F.array(*[F.lit(t) for t in NA_TOKENS])
    dirty = o.select(
        "o_orderkey",
        F.when(k % 40 < len(NA_TOKENS), F.element_at(toks, (k % 40 + 1).cast("int")))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 11 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
    )
    return ts.null_normalise(dirty)


def _typed_text(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.format_number("o_totalprice", 2).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "F", F.lit("True")).when(F.col("o_orderstatus") == "O", F.lit("false"))
        .otherwise(F.lit("yes")).alias("is_final"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
    )


TYPE_MAPPING = [("o_orderkey", "order_no", "STRING"), ("o_totalprice", "amount", "NUMBER"),
                ("is_final", "final", "BOOLEAN"), ("o_orderdate", "order_date", "DATE")]


def q_type_map(spark, sf):
    return ts.type_map(_typed_text(spark, sf), TYPE_MAPPING)


def q_map_columns(spark, sf):
    return ts.map_columns(ts.row_id(table(spark, sf, "orders")), ORDERS_MAPPING)


def q_sync_table(spark, sf):
    return sync_rows(orders_export(spark, sf), SyncSpec(**ORDERS_SPEC))


def q_sync_source_id(spark, sf):
    """A sync whose export has a column ``id`` and odd numbers; bad ones load as null."""
    text = orders_export(spark, sf).withColumn("o_totalprice", _odd_numbers(F.col("o_totalprice"))) \
        .withColumnRenamed("o_custkey", "id")
    mapping = [("id", "customer", "STRING"), ("o_orderkey", "order_no", "STRING"), ("o_totalprice", "amount", "NUMBER")]
    return sync_rows(text, SyncSpec(mapping, "orders_with_id", on_error="null"))


def q_full_refresh(spark, sf):
    store, name = _store(spark), _name("orders_synced")
    spec = SyncSpec(ORDERS_MAPPING, name)
    for _ in range(2):  # a second refresh must leave the same table
        sync_table(orders_export(spark, sf), spec, store)
    return store.read(name)


# -- sources / sinks --------------------------------------------------------
def q_csv_export(spark, sf):
    path = csv_export(table(spark, sf, "orders"), work_path(spark, "exports", "orders"))
    return csv_scan(spark, path, na_tokens=None)


def _dirty_export(spark, sf):
    k = F.col("o_orderkey").cast("bigint")
    quoted = F.concat(F.lit('say "hi", '), F.lit("\n"), F.lit("then bye"))
    return orders_export(spark, sf).withColumn(
        "o_orderpriority", F.when(k % 13 == 0, quoted).otherwise(F.col("o_orderpriority")))


def q_csv_scan(spark, sf):
    path = csv_export(_dirty_export(spark, sf), work_path(spark, "exports", "orders_dirty"))
    return csv_scan(spark, path, EXPORT_COLUMNS)


def q_view_export(spark, sf):
    o = table(spark, sf, "orders")
    view = _name("orders_by_customer")
    o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price")) \
        .createOrReplaceTempView(view)
    path = view_export(spark.table(view), work_path(spark, "exports", view), "json")
    return read_file(spark, path, "json", schema="o_custkey bigint, n_orders bigint, max_price double")


def q_select_all(spark, sf):
    """A catalog view over orders and customer, read whole."""
    name = _name("orders_named")
    table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .select("o_orderkey", "c_name", (F.col("o_totalprice") * 2).alias("doubled")).createOrReplaceTempView(name)
    return select_all(spark, name)


def q_inline_rows(spark, sf):
    """Raw text given in a call, the nations with their regions as a user would paste them, looked up by the customers."""
    lines = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.to_csv(F.struct("n_nationkey", "n_name", "r_name")).alias("line")).orderBy("n_nationkey").collect()
    text = "\n".join(["key,nation,region", *[r["line"] for r in lines]])      # the call's argument: one line per nation
    given = inline_rows(spark, text, work_dir=work_path(spark, "inline"), schema="key int, nation string, region string")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return c.join(given, F.col("c_nationkey") == F.col("key"), "left").select("c_custkey", "nation", "region")


def q_text_rows(spark, sf):
    c = table(spark, sf, "customer")
    lines = c.select(F.to_csv(F.struct(*c.columns)).alias("line"))
    return parse_text_rows(lines, "line", "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                                          "c_mktsegment string").withColumn("c_name", F.lower("c_name"))


def q_add_row(spark, sf):
    o = table(spark, sf, "orders")
    return ts.add_rows(o, [
        {"o_orderkey": 1_000_000_001, "o_custkey": 1, "o_orderstatus": "O", "o_totalprice": 10.5,
         "o_orderdate": "2024-01-02 00:00:00", "o_orderpriority": "1-URGENT"},
        {"o_orderkey": 1_000_000_002},
    ])


# -- mapping documents ------------------------------------------------------
def _schema_rows(spark, sf):
    """Mapping rows with one header more than the three that a mapping needs."""
    return mapping_rows(spark, sf).withColumn("comment", F.concat(F.lit("column "), F.col("position").cast("string")))


def q_mapping_scan(spark, sf):
    rows = mapping_rows(spark, sf).select("source_key", "destination_key", "data_type")
    path = csv_export(rows, work_path(spark, "schemas", "nation"))
    return mapping_scan(spark, path).select("source_key", "destination_key", "data_type")


def q_mapping_collect(spark, sf):
    docs = ts.mapping_collect(_schema_rows(spark, sf).drop("view_id", "source_table"), ["target_table"], "position")
    return docs.select("target_table", F.size("column_mapping").cast("bigint").alias("n_columns"),
                       F.to_json("column_mapping").alias("column_mapping_json"))


def q_mapping_json(spark, sf):
    docs = ts.mapping_collect(_schema_rows(spark, sf), ["view_id", "source_table", "target_table"], "position")
    path = write_documents(ts.mapping_document(docs, ["view_id", "source_table", "target_table"]), "document",
                           work_path(spark, "mappings"))
    return spark.read.text(path).select(F.col("value").alias("document"))


# -- SQL sources / parameters --------------------------------------------------
def q_sql_source(spark, sf):
    return sql_source(spark, "select o_orderstatus, count(*) as n_orders, round(sum(o_totalprice), 2) as total "
                             "from {orders} group by o_orderstatus", orders=table(spark, sf, "orders"))


def q_param_query(spark, sf):
    v = Variables()
    v.create("min_price", "NUMBER", value=200000)
    v.create("status", "STRING", value="F")
    return v.run(spark, "select o_orderkey, o_totalprice from {orders} "
                        "where o_totalprice > :min_price and o_orderstatus = :status", orders=table(spark, sf, "orders"))


# -- loads --------------------------------------------------------------------
def q_import_new_table(spark, sf):
    """The file has missing-value tokens in text and number cells."""
    store, name = _store(spark), _name("orders_imported")
    k = F.col("o_orderkey")
    dirty = table(spark, sf, "orders").withColumn("o_orderpriority", F.when(k % 7 == 0, "N/A").otherwise(F.col("o_orderpriority"))) \
        .withColumn("o_totalprice", F.when(k % 11 == 0, "NA").otherwise(F.col("o_totalprice").cast("string")))
    path = csv_export(dirty, work_path(spark, "exports", "orders"))
    df = read_file(spark, path, "csv", auto_identify=False,
                   schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string",
                   options={"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"})
    store.import_new_table(name, df)
    return store.read(name)


def q_import_append(spark, sf):
    store, name = _store(spark), _name("orders_appended")
    o = table(spark, sf, "orders")
    store.import_new_table(name, o.filter(F.col("o_orderkey") % 2 == 0))
    store.append(name, o.filter(F.col("o_orderkey") % 2 == 1).withColumn("o_totalprice", F.col("o_totalprice") + 1))
    store.append(name, o.filter(F.col("o_orderkey") % 10 == 1).select("o_orderkey", "o_custkey"))  # other columns null
    return store.read(name)


def q_save_as(spark, sf):
    store, name = _store(spark), _name("orders_src")
    store.import_new_table(name, table(spark, sf, "orders"))
    store.save_as(name, name + "_copy")
    store.truncate_add(name, table(spark, sf, "orders").filter("o_orderstatus = 'F'"))   # the copy stays as it was
    return store.read(name + "_copy").withColumn("of", F.lit("copy")) \
        .unionByName(store.read(name).withColumn("of", F.lit("source")))


def q_create_table(spark, sf):
    store, name = _store(spark), _name("orders_designed")
    o = table(spark, sf, "orders")
    store.create_table(name, "o_note string, o_custkey bigint, o_orderkey bigint, o_totalprice decimal(18,2)")
    empty = store.read(name).agg(F.count(F.lit(1)).alias("rows_at_first"))
    store.append(name, o.select("o_orderkey", "o_custkey", "o_totalprice"))
    return store.read(name).withColumn("o_totalprice", F.col("o_totalprice").cast("double")).crossJoin(F.broadcast(empty))


def q_import_truncateadd(spark, sf):
    store, name = _store(spark), _name("orders_truncated")
    o = table(spark, sf, "orders")
    store.import_new_table(name, o)
    store.truncate_add(name, o.filter(F.col("o_orderstatus") == "F"))
    return store.read(name)


def _partial_batch(o):
    """Doubled prices of every 10th order, and new orders. Beyond a million orders a new key may be one of the others, too."""
    k = F.col("o_orderkey")
    changed = o.filter(k % 10 == 0).select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"))
    added = o.filter(k % 100 == 0).select((k + 1_000_000).alias("o_orderkey"), "o_totalprice")
    return changed.unionByName(added)


def q_import_updateadd(spark, sf):
    store, name = _store(spark), _name("orders_upserted")
    o = table(spark, sf, "orders")
    store.import_new_table(name, o, bucket_keys=["o_orderkey"], buckets=16)
    store.update_add(name, _partial_batch(o), ["o_orderkey"], repeats=True)  # rewrites only the touched buckets
    return store.read(name)


def _full_batch(o):
    k = F.col("o_orderkey")
    changed = o.filter(k % 10 == 0).withColumn("o_totalprice", F.col("o_totalprice") * 2) \
        .withColumn("o_orderpriority", F.lit("0-CHANGED"))
    added = o.filter(k % 100 == 0).withColumn("o_orderkey", k + 1_000_000)
    return changed.unionByName(added)


def q_upsert(spark, sf):
    o = table(spark, sf, "orders")
    return ts.upsert(o, _full_batch(o), ["o_orderkey"], repeats=True)


def q_insert_ignore(spark, sf):
    store, name = _store(spark), _name("orders_ignored")
    o = table(spark, sf, "orders")
    store.import_new_table(name, o.filter(F.col("o_orderkey") % 2 == 0))
    batch = o.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for _ in range(2):  # a second load of the same batch adds nothing
        store.insert_ignore(name, batch, ["o_orderkey"])
    return store.read(name)


# -- row and column changes -----------------------------------------------------
UPDATE_CRITERIA = "o_totalprice > 400000 and nullif(o_orderstatus, 'P') = 'F'"
DELETE_CRITERIA = "nullif(o_orderstatus, 'O') = 'F' and o_totalprice > 100000"


def q_update_where(spark, sf):
    return ts.update_where(table(spark, sf, "orders"), {"o_orderpriority": "0-CRITICAL", "o_custkey": 0},
                           UPDATE_CRITERIA)


def q_delete_where(spark, sf):
    return ts.delete_where(table(spark, sf, "orders"), DELETE_CRITERIA)


def q_add_column(spark, sf):
    return ts.add_column(table(spark, sf, "part"), "p_note", "STRING")


def q_rename_column(spark, sf):
    return ts.rename_column(table(spark, sf, "part"), "p_name", "p_title")


def q_delete_column(spark, sf):
    return ts.delete_column(table(spark, sf, "part"), "p_type")


def q_hide_columns(spark, sf):
    return ts.hide_columns(table(spark, sf, "part"), ["p_brand", "p_type"]).visible()


def q_show_columns(spark, sf):
    view = ts.hide_columns(table(spark, sf, "part"), ["p_brand", "p_type", "p_size"])
    return ts.show_columns(view, ["p_type"]).visible()


FORMULAS = {"revenue": "l_extendedprice * (1 - l_discount)",
            "charge": "l_extendedprice * (1 - l_discount) * (1 + l_tax)"}


def q_apply_formulas(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    return ts.apply_formulas(li, FORMULAS).select("l_orderkey", "l_linenumber", "revenue", "charge")


def _lookup(spark, sf):
    """Customers, some with a nation that there is not."""
    k = F.col("c_nationkey")
    child = table(spark, sf, "customer").withColumn("c_nationkey", F.when(F.col("c_custkey") % 7 == 0, k + 100).otherwise(k))
    return ts.lookup(child, "c_nationkey", table(spark, sf, "nation"), "n_nationkey", ["n_name", "n_regionkey"])


def q_lookup(spark, sf):
    return _lookup(spark, sf)


def q_remove_lookup(spark, sf):
    return ts.remove_lookup(_lookup(spark, sf), ["n_regionkey"])


# -- aggregations ----------------------------------------------------------------
def q_profile_table(spark, sf):
    return ts.profile_table(table(spark, sf, "customer"), exact=True)


def q_profile_column(spark, sf):
    return ts.profile_column(table(spark, sf, "events"), "event_type")


EVENTS_REPORT = ts.ReportSpec(group_by=["event_type"], group_aliases=["group_key"], round_to=2,
                              filters=["value > 50000", "event_type <> 'P'"],
                              measures=[("count", "*", "n"), ("sum", "value", "total"), ("min", "value", "lo"),
                                        ("max", "value", "hi")])


def q_similar_report(spark, sf):
    return ts.similar_report(table(spark, sf, "orders"), EVENTS_REPORT,
                             {"event_type": "o_orderstatus", "value": "o_totalprice"})


def q_load_audit(spark, sf):
    text = ts.null_tokens(orders_export(spark, sf).withColumn("o_totalprice", _odd_numbers(F.col("o_totalprice"))))
    return ts.load_audit(ts.row_id(text), null_columns=["o_orderpriority"], number_columns=["o_totalprice"])


# -- jobs ---------------------------------------------------------------------------
def q_due_jobs(spark, sf):
    return jobplan.due_jobs(jobs_frame(spark, sf), pending=True).select("job_id", "target_table", "status")


def q_update_job_state(spark, sf):
    return jobplan.update_job_state(jobs_frame(spark, sf), "7", "FAILED", "export failed",
                                    updated_at=1_700_000_000_000).select("job_id", "status", "message", "updated_at")


def q_failure_alerts(spark, sf):
    """A run of the pending jobs in which every second one failed; the others of the registry did not run."""
    jobs = jobs_frame(spark, sf)
    k = F.col("job_id").cast("int")
    results = jobplan.due_jobs(jobs, pending=True).select(
        "job_id", F.when(k % 2 == 0, "FAILED").otherwise("PASS").alias("status"),
        F.when(k % 4 == 0, "export failed\nat line 2").alias("message"),
        (F.lit(1_700_000_000_000) + k * 60_000).alias("updated_at"))
    return jobplan.failure_alerts(jobs, results)


def _job_report(store, run: str, results: DataFrame, updated: DataFrame) -> DataFrame:
    """Statuses, and what the tables of the jobs that ran now hold; target names without the end that this run gave them."""
    spark = updated.sparkSession
    loaded = spark.createDataFrame([], "n_rows bigint, balance double, first_name string, n_ids bigint, job_id string")
    for r in results.filter("status = 'PASS'").join(updated.select("job_id", "target_table"), "job_id").collect():
        loaded = loaded.unionByName(store.read(r["target_table"]).agg(
            F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("balance"), 2).alias("balance"), F.min("name").alias("first_name"),
            F.count_distinct("id").alias("n_ids")).withColumn("job_id", F.lit(r["job_id"])))
    return updated.join(results.select("job_id", "rows_loaded"), "job_id", "left").join(loaded, "job_id", "left") \
        .withColumn("target_table", F.replace("target_table", F.lit(run), F.lit(""))) \
        .select("job_id", "target_table", "status", "message", "rows_loaded", "n_rows", "balance", "first_name", "n_ids")


def q_sync_jobs(spark, sf):
    register_views(spark, sf, "customer")
    run, store = _name(""), _store(spark)
    return _job_report(store, run, *jobplan.run_jobs(spark, jobs_frame(spark, sf, run), store, pending=True))


def q_refetch(spark, sf):
    register_views(spark, sf, "customer")
    run, store = _name(""), _store(spark)
    return _job_report(store, run, *jobplan.refetch(spark, jobs_frame(spark, sf, run), store, "status = 'FAILED'"))


def q_sync_jobs_shared(spark, sf):
    """Twenty-five jobs over one table, which is scanned once; the one whose criteria is wrong fails alone."""
    register_views(spark, sf, "customer")
    run, store = _name(""), _store(spark)
    report = _job_report(store, run, *jobplan.run_jobs(spark, shared_jobs_frame(spark, sf, run), store, pending=True))
    return report.withColumn("message", F.when(F.col("status") == "FAILED", F.col("message").contains("no_such_column").cast("string"))
                             .otherwise(F.col("message")))


# -- scalar functions ----------------------------------------------------------------
def _instants(spark, sf):
    """Event times as they stand (UTC wall clock) and as TIMESTAMPs of the same instants, in whatever session zone."""
    e, start = table(spark, sf, "events"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return e.withColumn("at", F.timestamp_micros(F.timestamp_diff("MICROSECOND", start, F.col("ts"))))


def q_ist_text(spark, sf):
    return _instants(spark, sf).select("event_id", fx.zone_text(F.col("ts")).alias("ist_text"),
                                       fx.zone_text(F.col("at"), instant=True).alias("ist_text_of_instant"))


def q_epoch_ms(spark, sf):
    return _instants(spark, sf).select("event_id", fx.epoch_ms(F.col("ts")).alias("epoch_ms"),
                                       fx.epoch_ms(F.col("at"), instant=True).alias("epoch_ms_of_instant"))


QUERIES: dict[str, Query] = {
    "row_id": q_row_id,
    "clean_numbers": q_clean_numbers,
    "dedup": q_dedup,
    "first_wins": q_first_wins,
    "null_normalise": q_null_normalise,
    "type_map": q_type_map,
    "map_columns": q_map_columns,
    "sync_table": q_sync_table,
    "full_refresh": q_full_refresh,
    "csv_export": q_csv_export,
    "csv_scan": q_csv_scan,
    "view_export": q_view_export,
    "select_all": q_select_all,
    "inline_rows": q_inline_rows,
    "text_rows": q_text_rows,
    "sync_source_id": q_sync_source_id,
    "add_row": q_add_row,
    "mapping_scan": q_mapping_scan,
    "mapping_collect": q_mapping_collect,
    "mapping_json": q_mapping_json,
    "sql_source": q_sql_source,
    "param_query": q_param_query,
    "import_new_table": q_import_new_table,
    "import_append": q_import_append,
    "save_as": q_save_as,
    "create_table": q_create_table,
    "import_truncateadd": q_import_truncateadd,
    "import_updateadd": q_import_updateadd,
    "upsert": q_upsert,
    "insert_ignore": q_insert_ignore,
    "update_where": q_update_where,
    "delete_where": q_delete_where,
    "add_column": q_add_column,
    "rename_column": q_rename_column,
    "delete_column": q_delete_column,
    "hide_columns": q_hide_columns,
    "show_columns": q_show_columns,
    "apply_formulas": q_apply_formulas,
    "lookup": q_lookup,
    "remove_lookup": q_remove_lookup,
    "profile_table": q_profile_table,
    "profile_column": q_profile_column,
    "similar_report": q_similar_report,
    "load_audit": q_load_audit,
    "due_jobs": q_due_jobs,
    "update_job_state": q_update_job_state,
    "failure_alerts": q_failure_alerts,
    "sync_jobs": q_sync_jobs,
    "refetch": q_refetch,
    "ist_text": q_ist_text,
    "epoch_ms": q_epoch_ms,
}


def q_load_history(spark, sf):
    """Every load that the store recorded: a full refresh, twelve appends of a twelfth each, an insert-ignore of it all."""
    store, name = _store(spark), _name("orders_history")
    rows = sync_rows(orders_export(spark, sf), SyncSpec(**ORDERS_SPEC))
    store.full_refresh(name, rows)
    stored = store.read(name)
    for k in range(12):
        store.append(name, stored.filter(F.col("order_no").cast("bigint") % 12 == k))
    store.insert_ignore(name, rows, ["id"])
    first = store.load_history(name).first()
    found = store.load_details(name, first["load_id"])          # the oldest load is found by its id
    return store.load_history(name).select("mode", "rows_written", (F.col("load_id") == found["load_id"]).alias("is_first"))


QUERIES["load_history"] = q_load_history


# -- streaming --------------------------------------------------------------------------
def q_landing_sync(spark, sf):
    """Two export drops land in a folder; the stream runs after each and the target holds one row per id."""
    from tablesmith.streaming import landing_sync
    store, name = _store(spark), _name("orders_landed")
    landing, ckpt = work_path(spark, "landing"), work_path(spark, "streams")
    text = orders_export(spark, sf)
    spec = SyncSpec(ORDERS_MAPPING, name)
    drops = [text, text.filter(F.col("o_orderkey").cast("bigint") % 3 == 0)]  # a second, overlapping re-export
    for i, drop in enumerate(drops):
        csv_export(drop, f"{landing}/drop-{i}")
        landing_sync(spark, landing, EXPORT_COLUMNS, spec, store, checkpoint=ckpt, buckets=8).awaitTermination()
    return store.read(name)


QUERIES["landing_sync"] = q_landing_sync


# -- changes of stored tables ---------------------------------------------------------------
def _stored_orders(spark, sf, **layout):
    """Orders as a stored table of three parts, or bucketed."""
    store, name, o = _store(spark), _name("orders_stored"), table(spark, sf, "orders")
    if layout:
        store.import_new_table(name, o, **layout)
    else:
        store.import_new_table(name, o.filter("o_orderkey % 3 = 0"))
        store.append(name, o.filter("o_orderkey % 3 = 1"))
        store.append(name, o.filter("o_orderkey % 3 = 2"))
    return store, name


def q_update_where_stored(spark, sf):
    store, name = _stored_orders(spark, sf, bucket_keys=["o_orderkey"], buckets=16)
    done = store.update_where(name, {"o_orderpriority": "0-CRITICAL", "o_custkey": 0}, UPDATE_CRITERIA)
    return store.read(name).withColumn("n_updated", F.lit(done["updated_rows"]).cast("bigint"))


def q_delete_where_stored(spark, sf):
    store, name = _stored_orders(spark, sf)
    n = store.delete_where(name, "o_orderkey % 3 = 1 and o_orderstatus = 'F'")
    return store.read(name).withColumn("n_deleted", F.lit(n).cast("bigint"))


def q_add_row_stored(spark, sf):
    store, name = _stored_orders(spark, sf)
    done = store.add_rows(name, [{"o_orderkey": 1_000_000_001, "o_orderdate": "2024-01-02 00:00:00"}, {"o_orderkey": 1_000_000_002, "o_totalprice": "1.5"}])
    return store.read(name).withColumn("n_added", F.lit(done["added_rows"]).cast("bigint"))


def q_columns_stored(spark, sf):
    """A name is given away and taken anew, a column is dropped and comes back empty, one is hidden; no file is rewritten."""
    store, name, p = _store(spark), _name("parts_stored"), table(spark, sf, "part")
    store.import_new_table(name, p)
    store.rename_column(name, "p_name", "p_title")
    store.add_column(name, "p_name", "STRING")
    store.delete_column(name, "p_type")
    store.add_column(name, "p_type", "NUMBER")
    store.hide_columns(name, ["p_brand", "p_size"])
    store.append(name, p.filter("p_partkey % 10 = 0").select((F.col("p_partkey") + 1_000_000).alias("p_partkey"), F.upper("p_name").alias("p_name"),
                                                             "p_brand", F.col("p_size").cast("double").alias("p_type")))
    store.show_columns(name, ["p_brand"])
    return store.read(name)


def _changed_orders(spark, sf):
    """A later export: some orders are gone, some have another status."""
    o = orders_export(spark, sf)
    k = F.col("o_orderkey").cast("bigint")
    return o.filter(k % 11 != 0).withColumn("o_orderstatus", F.when(k % 10 == 3, F.lit("X")).otherwise(F.col("o_orderstatus")))


def q_refresh_difference(spark, sf):
    """A sync, the sync of a later export, and the same again: what was added, what was dropped, and that the last wrote nothing."""
    store, name = _store(spark), _name("orders_refreshed")
    store.create_table(name, "id string, order_no string, amount double, order_date string, priority string, status string", bucket_keys=["id"], buckets=16)
    spec = SyncSpec(ORDERS_MAPPING, name)
    loads = []
    for export in (orders_export, _changed_orders, _changed_orders):
        sync_table(export(spark, sf), spec, store, difference=True)
        loads.append(store.last_load(name))
    return store.read(name).withColumns({"n_added": F.lit(loads[1]["added"]), "n_removed": F.lit(loads[1]["removed"]),
                                         "n_written_again": F.lit(loads[2]["rows_written"]).cast("bigint")})


def q_load_details(spark, sf):
    """Loads by their ids: one that was waited for, and one that failed."""
    store, name, o = _store(spark), _name("orders_loads"), table(spark, sf, "orders")
    store.create_table(name, o.schema)
    good = store.start_load("append", name, o.filter("o_orderstatus = 'F'"))
    wrong = store.start_load("append", name, o.withColumn("no_such_column", F.lit(1)))
    rows = [("good", good.wait()), ("wrong", wrong.wait())]
    found = [(k, d["load_id"] == h.load_id, d["mode"], d["status"], "no_such_column" in (d["message"] or ""))
             for (k, d), h in zip(rows, (good, wrong))]
    return spark.createDataFrame(found, "which string, by_id boolean, mode string, status string, says_why boolean") \
        .withColumn("n_rows", F.lit(store.read(name).count()))


def q_save_as_shared(spark, sf):
    """A copy of the same parts, changed on its own, after the versions behind both were expired."""
    store, name = _stored_orders(spark, sf)
    store.save_as(name, name + "_copy")
    store.delete_where(name, "o_orderkey % 3 = 1")
    store.update_where(name + "_copy", {"o_orderstatus": "C"}, "o_orderkey % 3 = 2")
    for n in (name, name + "_copy"):
        store.expire_versions(n, keep=1)
    return store.read(name).withColumn("of", F.lit("source")).unionByName(store.read(name + "_copy").withColumn("of", F.lit("copy")))


# -- large CSV files -------------------------------------------------------------------------
def q_csv_scan_split(spark, sf):
    """The dirty export, with quoted line breaks, read in blocks."""
    return csv_scan(spark, csv_export(_dirty_export(spark, sf), work_path(spark, "exports", "orders_dirty")), EXPORT_COLUMNS, split=True)


def q_first_wins_file(spark, sf):
    """The first row of each customer in the order of the files: their latest order, as these were exported by falling key."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice").orderBy(F.col("o_orderkey").desc())
    scan = csv_scan(spark, csv_export(o, work_path(spark, "exports", "orders_sorted")), split=True, with_position=True)
    return ts.first_wins(scan, ["o_custkey"], "pos").select("o_custkey", "o_orderkey")


def q_auto_identify(spark, sf):
    """The dirty export in three files of different layout, each imported without saying which it has."""
    rows, found = _dirty_export(spark, sf), []
    k = F.col("o_orderkey").cast("bigint") % 3
    for i, dialect in enumerate((Dialect(";"), Dialect("\t"), Dialect("|", "'"))):
        path = work_path(spark, "exports", f"orders_layout_{i}")
        rows.filter(k == i).write.options(**dialect.options).csv(path)
        found.append(csv_scan(spark, path, EXPORT_COLUMNS, dialect=None))
    return found[0].unionByName(found[1]).unionByName(found[2])


SKETCHED = ["l_partkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus"]


def q_profile_sketches(spark, sf):
    """Sketches of four parts of lineitem, merged, and whether each figure read off them is within its stated bound.

    ``common`` lists the values that more than twice the error's share of all rows hold: the sketch must have them all.
    """
    li, quantiles = table(spark, sf, "lineitem"), (0.1, 0.5, 0.9)
    parts = [ts.table_sketches(li.filter(F.pmod("l_orderkey", F.lit(4)) == k), SKETCHED) for k in range(4)]
    report = ts.sketch_report(ts.merge_sketches(reduce(DataFrame.unionByName, parts)), quantiles=quantiles, top=1000)
    report = spark.createDataFrame(report.collect(), report.schema)         # one row per column
    cells = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("string").alias("value")) for c in SKETCHED])
    exact = li.select(F.inline(cells)).groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("n_exact"))
    n, error = F.col("n_non_null"), count_error()
    distinct = exact.groupBy("col_name").agg(F.count("value").alias("n_exact"))
    asked = report.select("col_name", "n_non_null", F.posexplode("quantiles").alias("i", "at"))
    share, value, at = F.element_at(F.array(*map(F.lit, quantiles)), F.col("i") + 1), F.col("value").cast("double"), F.col("at").cast("double")
    ranks = exact.join(F.broadcast(asked), "col_name").groupBy("col_name", "i", "n_non_null").agg(
        F.sum(F.when(value < at, F.col("n_exact")).otherwise(0)).alias("below"), F.sum(F.when(value <= at, F.col("n_exact")).otherwise(0)).alias("upto"))
    bound = 2 * rank_error()        # the bound holds at 99 %, twice of it always
    ranks = ranks.groupBy("col_name").agg(F.bool_and((F.col("below") <= (share + bound) * n) & (F.col("upto") >= (share - bound) * n)).alias("ranks_ok"))
    common = report.select("col_name", "n_non_null", F.inline("frequent")).join(exact, ["col_name", "value"]).groupBy("col_name").agg(
        F.bool_and((F.col("n") >= F.col("n_exact")) & (F.col("n") <= F.col("n_exact") + error * n)).alias("counts_ok"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("n_exact") > 2 * error * n, F.col("value")))), ",").alias("common"))
    return report.join(distinct, "col_name").join(ranks, "col_name", "left").join(common, "col_name", "left").select(
        "col_name", "n_rows", "n_non_null", (F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.08 * F.col("n_exact")).alias("distinct_ok"),
        F.coalesce("ranks_ok", F.lit(True)).alias("ranks_ok"), F.coalesce("counts_ok", F.lit(True)).alias("counts_ok"),
        F.coalesce("common", F.lit("")).alias("common"))


def q_profile_default(spark, sf):
    """The default profile of lineitem; its distinct counts, which are estimates, as whether they are within 15 % of the exact ones."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_shipdate", "l_returnflag")
    exact = ts.profile_table(li, exact=True).select("col_name", F.col("n_distinct").alias("n_exact"))
    return ts.profile_table(li).join(exact, "col_name").select(
        "col_name", "n_rows", "n_non_null", "min_value", "max_value",
        (F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.15 * F.col("n_exact")).alias("distinct_ok"))


QUERIES |= {"sync_jobs_shared": q_sync_jobs_shared, "update_where_stored": q_update_where_stored, "delete_where_stored": q_delete_where_stored,
            "add_row_stored": q_add_row_stored, "columns_stored": q_columns_stored, "refresh_difference": q_refresh_difference,
            "load_details": q_load_details, "save_as_shared": q_save_as_shared, "csv_scan_split": q_csv_scan_split,
            "first_wins_file": q_first_wins_file, "auto_identify": q_auto_identify,
            "profile_sketches": q_profile_sketches, "profile_default": q_profile_default}
