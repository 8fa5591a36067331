"""Profiles from stored, merged sketches against exact figures."""

from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import tablesmith as ts
from tablesmith.operators.sketches import count_error, rank_error


def _parts(df, key, n, **sizes):
    return reduce(DataFrame.unionByName, [ts.table_sketches(df.filter(F.pmod(key, F.lit(n)) == k), **sizes) for k in range(n)])


def _skewed(spark, n=40_000):
    """A third of the rows hold one value; the rest are spread."""
    i = F.col("id")
    return spark.range(n).select("id", F.when(i % 3 == 0, 7).when(i % 3 == 1, i % 50).otherwise(i).alias("v"),
                                 F.when(i % 5 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (i % 1000).cast("int"))).alias("d"))


@pytest.mark.parametrize("tracked, ranks", [(3072, 400), (96, 64)])
@pytest.mark.parametrize("parts", [1, 6])
def test_bounds_hold_merged_or_not(spark, parts, tracked, ranks):
    df = _skewed(spark)
    report = {r["col_name"]: r for r in ts.sketch_report(ts.merge_sketches(_parts(df, "id", parts, tracked=tracked, ranks=ranks)), top=min(500, tracked)).collect()}
    rows = df.collect()
    for c in df.columns:
        values = [r[c] for r in rows if r[c] is not None]
        exact, n, r = Counter(map(str, values)), len(values), report[c]
        assert (r["n_rows"], r["n_non_null"], r["min_value"], r["max_value"]) == (len(rows), n, str(min(values)), str(max(values)))
        assert abs(r["n_distinct"] - len(exact)) <= 0.08 * len(exact)
        error = count_error(tracked) * n
        found = {x["value"]: x["n"] for x in r["frequent"]}
        assert all(exact[v] <= k <= exact[v] + error for v, k in found.items())
        assert {v for v, k in exact.items() if k > 2 * error} <= set(found)
        for q, at in zip((0.25, 0.5, 0.75), r["quantiles"]):
            less = sum(str(v) < at if c == "d" else v < float(at) for v in values)
            most = sum(str(v) <= at if c == "d" else v <= float(at) for v in values)
            assert less <= (q + 2 * rank_error(ranks)) * n and most >= (q - 2 * rank_error(ranks)) * n


def test_stored_sketches_merge_without_their_rows(spark, tmp_path):
    df = _skewed(spark, 3000)
    for k in range(3):
        ts.table_sketches(df.filter(F.col("id") % 3 == k)).write.mode("append").parquet(str(tmp_path / "sketches"))
    merged = ts.merge_sketches(spark.read.parquet(str(tmp_path / "sketches")))
    whole = {r["col_name"]: r for r in ts.sketch_report(ts.table_sketches(df)).collect()}
    for r in ts.sketch_report(merged).collect():
        assert all(r[k] == whole[r["col_name"]][k] for k in ("n_rows", "n_non_null", "min_value", "max_value"))
    with pytest.raises(Exception, match="sizes"):
        ts.merge_sketches(ts.table_sketches(df).unionByName(ts.table_sketches(df, tracked=96))).collect()


def test_empty_null_nan_and_clashing_names(spark):
    df = spark.sql("select cast(null as int) a, array(1) b, cast('nan' as double) c, true `d.e`, 'x' n_rows, cast('1.50' as decimal(9,2)) columns, "
                   "timestamp_ntz'2024-01-01 01:02:03' t union all select null, null, null, null, null, null, null")
    got = {r["col_name"]: r for r in ts.sketch_report(ts.table_sketches(df)).collect()}
    assert list(got) == df.columns
    assert got["a"]["quantiles"] == [None] * 3 and got["a"]["frequent"] == [] and got["a"]["n_non_null"] == 0
    assert got["b"]["quantiles"] is None and got["b"]["frequent"][0]["value"] == "[1]"
    assert got["c"]["quantiles"] == [None] * 3 and got["c"]["n_distinct"] == 1
    assert got["n_rows"]["frequent"] == [("x", 1)] and got["columns"]["min_value"] == "1.50"
    assert got["t"]["quantiles"] == ["2024-01-01 01:02:03"] * 3
    empty = ts.sketch_report(ts.merge_sketches(ts.table_sketches(df.limit(0)))).collect()
    assert len(empty) == 7 and all(r["n_rows"] == 0 and r["frequent"] == [] for r in empty)
    assert ts.merge_sketches(ts.table_sketches(df).limit(0)).collect() == []


def test_one_pass_without_rows_shuffled(spark):
    plan = ts.table_sketches(_skewed(spark, 100))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan       # partial rows only
