"""Every registered check against its independent DuckDB statement at sf0.01."""

import pytest

import __spark_entry__ as entry
from tablesmith.registry.oracle import ORACLE
from tablesmith.registry.spark import QUERIES
from tests.conftest import ROOT, SF01
from tools.check_oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("left", ["nothing", "pipeline", "empty folder"])
def test_entry_without_the_optional_package(tmp_path, left):
    """The library and its entry work where the training-data operators are deleted; a broken import is not hidden."""
    import shutil
    import subprocess
    import sys
    shutil.copytree(f"{ROOT}/tablesmith", tmp_path / "tablesmith", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if left == "pipeline":
        (tmp_path / "corpus_pipeline.py").write_text("from tablesmith.llm import queries\n")
    elif left == "empty folder":
        (tmp_path / "tablesmith" / "llm").mkdir()
        (tmp_path / "corpus_pipeline.py").write_text("from tablesmith.llm import queries\n")
    say = [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"]
    out = subprocess.run(say, cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})
    assert out.stdout.strip() == str(len(QUERIES)), out.stderr
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    out = subprocess.run(say, cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})
    assert "no_such_module" in out.stderr and out.returncode


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, key):
    r = compare(spark, SF01, key, QUERIES[key], ORACLE[key], con)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "order_no", "amount", "order_date", "priority", "status"]
    assert df.count() > 0


#: Orders beyond a million: the key that a load adds for order 0 is that of another order, and both are in the batch.
KEYS = (0, 5, 10, 100, 300, 1_000_000, 1_000_005, 1_000_100, 2_000_000)


def _matches_beyond_a_million_orders(spark, tmp_path, key):
    import duckdb
    con = duckdb.connect()
    con.execute(f"create table orders as select k::bigint as o_orderkey, k % 7 as o_custkey, 'F' as o_orderstatus, k / 4 as o_totalprice, "
                f"timestamp '1995-01-01' as o_orderdate, '1-URGENT' as o_orderpriority from unnest({list(KEYS)}) t(k)")
    con.execute(f"copy orders to '{tmp_path}/orders.parquet' (format parquet)")
    r = compare(spark, str(tmp_path), key, QUERIES[key], ORACLE[key], con)
    assert r["status"] == "ok", r
    assert r["spark_rows"] == len(KEYS) + 6     # three added keys are there already, three are new


def test_import_updateadd_beyond_a_million_orders(spark, tmp_path):
    _matches_beyond_a_million_orders(spark, tmp_path, "import_updateadd")


def test_upsert_beyond_a_million_orders(spark, tmp_path):
    _matches_beyond_a_million_orders(spark, tmp_path, "upsert")
