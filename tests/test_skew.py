"""A third of the rows on one key: results stay whole and right, hot keys are combined before the shuffle."""

import pytest
from pyspark.sql import functions as F

import tablesmith as ts
from tests.conftest import SF01


@pytest.fixture(scope="module")
def hot(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    # l_linenumber 1..7: rows with linenumber <= 2 (about a third) all share key 0
    return li.withColumn("k", F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_orderkey")))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_share(hot):
    n, h = hot.count(), hot.filter("k = 0").count()
    assert h / n > 0.25


def test_first_wins_on_hot_key_matches_brute_force(hot):
    df = hot.select(F.col("k").alias("id"), F.monotonically_increasing_id().alias("pos"), "l_partkey", "l_quantity")
    df = df.cache()
    got = {r["id"]: (r["pos"], r["l_partkey"]) for r in ts.first_wins(df, ["id"], "pos").collect()}
    pdf = df.toPandas().sort_values("pos").drop_duplicates("id")
    want = {int(r.id): (int(r.pos), int(r.l_partkey)) for r in pdf.itertuples()}
    assert got == want
    plan = _plan(ts.first_wins(df, ["id"], "pos"))
    assert "partial_min" in plan  # combined inside each task before the exchange
    df.unpersist()


def test_dedup_of_hot_duplicate_rows(hot):
    rows = hot.filter("k = 0").select("k")  # one value repeated ~20k times
    out = ts.dedup(ts.row_id(rows))
    assert out.count() == 1
    assert "partial_first" in _plan(out)


def test_profile_column_hot_value(hot):
    freq = {r["value"]: r["n"] for r in ts.profile_column(hot, "k").collect()}
    assert freq["0"] == hot.filter("k = 0").count()
    assert sum(freq.values()) == hot.count()


def test_lookup_with_hot_child_key_without_broadcast(spark, hot):
    parent = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_orderstatus")
    out = ts.lookup(hot, "k", parent, "o_orderkey", ["o_orderstatus"], broadcast_max_rows=None)
    assert out.count() == hot.count()
    assert out.filter("k = 0 and o_orderstatus is not null").count() == hot.filter("k = 0").count()
