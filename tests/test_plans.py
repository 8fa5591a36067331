"""Plan shape: pushdown, pruning, no Python in the hot path, broadcast only when bounded."""

import pytest
from pyspark.sql import functions as F

import tablesmith as ts
from tablesmith.operators import sizing
from tablesmith.registry.spark import QUERIES
from tests.conftest import SF001

NO_WRITE = ["row_id", "clean_numbers", "dedup", "first_wins", "null_normalise", "type_map", "map_columns",
            "sync_table", "upsert", "update_where", "delete_where", "apply_formulas", "lookup", "profile_table",
            "profile_column", "similar_report", "load_audit", "ist_text", "epoch_ms", "inline_rows", "param_query"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", NO_WRITE)
def test_no_python_evaluation(spark, key):
    plan = _plan(QUERIES[key](spark, SF001))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in plan


def test_filter_pushed_and_columns_pruned(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    df = ts.delete_where(o, "o_orderstatus = 'F'").select("o_orderkey")
    plan = _plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    assert "Exchange" not in plan


def test_selections_reach_the_scan(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = _plan(ts.update_where(o.filter("o_orderstatus = 'F'"), {"o_orderpriority": "X"}, "o_totalprice > 1")
                 .select("o_orderkey", "o_orderpriority"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" \
        in plan


def test_small_batch_upsert_does_not_shuffle_target(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    out = ts.upsert(o, o.filter("o_orderkey % 100 = 0"), ["o_orderkey"], check=False)
    assert "BroadcastHashJoin" in _plan(out)


def test_broadcast_needs_a_proven_bound(spark):
    df = spark.range(50)
    assert "broadcast" in df.hint("broadcast")._jdf.queryExecution().logical().toString().lower()
    assert sizing.broadcast_if_small(df, 10) is df
    assert sizing.broadcast_if_small(df, 100) is not df


def test_first_wins_is_an_aggregate_not_a_window(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("id"), F.col("id").alias("pos"))
    plan = _plan(ts.first_wins(df, ["id"], "pos"))
    assert "Window" not in plan and "Aggregate" in plan


def test_small_batch_insert_ignore_does_not_shuffle_target(spark):
    from tablesmith.operators.merge import new_rows
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = _plan(new_rows(o, o.filter("o_orderkey < 50"), ["o_orderkey"]))
    assert "LeftSemi" in plan and "LeftAnti" in plan
    # the target's full rows are never exchanged; only the batch is reduced by key
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "o_custkey" not in line


def test_broadcast_bound_counts_bytes(spark):
    wide = spark.range(1000).select(F.repeat(F.lit("x"), 10_000).alias("s"))  # ~10 MB of text
    assert not sizing.fits_broadcast(wide, max_rows=10_000, max_bytes=1_000_000)
    assert sizing.fits_broadcast(wide, max_rows=10_000, max_bytes=100_000_000)
    stats = sizing.key_stats(wide.withColumn("k", F.monotonically_increasing_id()), ["k"])
    assert stats["rows"] == 1000 and stats["bytes"] >= 10_000_000


def test_building_a_sync_starts_no_job(spark):
    from tablesmith.plans.sync import SyncSpec, sync_rows
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    grouped = o.groupBy("o_custkey").agg(F.max("o_orderpriority").alias("p")).selectExpr("cast(o_custkey as string) as a", "p")
    tracker, group = spark.sparkContext.statusTracker(), "plan-only"
    spark.sparkContext.setJobGroup(group, group)
    try:
        sync_rows(grouped, SyncSpec([ts.ColumnMap("a", "a", "STRING")], "t"))
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_batch_partial_upsert_does_not_shuffle_target(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    batch = o.filter("o_orderkey < 50").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"))
    plan = _plan(ts.upsert(o, batch, ["o_orderkey"]))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    for line in plan.splitlines():  # neither the target's rows nor all its keys are exchanged
        if "Exchange hashpartitioning" in line:
            assert "o_custkey" not in line
    assert "SortMergeJoin" not in plan
