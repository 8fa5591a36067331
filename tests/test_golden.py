"""Golden dirty rows (FIXTURES.md §4)."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import tablesmith as ts
from tablesmith.functions.tokens import NA_TOKENS
from tablesmith.operators.mapping import MappingError
from tablesmith.plans.sync import SyncSpec, sync_rows
from tablesmith.session import work_path
from tablesmith.sources.files import inline_rows


def _one(spark, *cells, names=None):
    names = names or [f"c{i}" for i in range(len(cells))]
    return spark.createDataFrame([tuple(cells)], ", ".join(f"{n} string" for n in names))


def test_thousands_separator(spark):
    df = ts.type_map(_one(spark, "1,234.50", names=["amt"]), [("amt", "amount", "NUMBER")])
    assert df.first()["amt"] == 1234.5


def test_missing_tokens_are_null_and_hash_as_nan(spark):
    rows = [(t,) for t in NA_TOKENS] + [("x",)]
    df = ts.null_tokens(spark.createDataFrame(rows, "v string"))
    assert df.filter(F.col("v").isNull()).count() == len(NA_TOKENS)
    ids = {r["id"] for r in ts.row_id(df).collect()}
    assert len(ids) == 2  # every missing token hashes like the others
    nan_id = ts.row_id(spark.createDataFrame([("nan",)], "v string")).first()["id"]
    assert nan_id in ids


@pytest.mark.parametrize("bad", ["$5", "(5)", "1.2.3"])
def test_bad_number_raises_by_default_and_nulls_when_asked(spark, bad):
    df = _one(spark, bad, names=["amt"])
    with pytest.raises(Exception):
        ts.clean_numbers(df, ["amt"]).collect()
    assert ts.clean_numbers(df, ["amt"], on_error="null").first()["amt"] is None


def test_leading_zero_string_kept(spark):
    assert ts.type_map(_one(spark, "007", names=["code"]), [("code", "code_out", "STRING")]).first()["code"] == "007"


def test_boolean_spellings(spark):
    df = spark.createDataFrame([("True",), ("false",), ("yes",), ("TRUE",)], "b string")
    out = [r["b"] for r in ts.type_map(df, [("b", "flag", "BOOLEAN")]).collect()]
    assert out == ["true", "false", "yes", "true"]


def test_date_text_unchanged(spark):
    assert ts.type_map(_one(spark, "2024-01-02", names=["d"]), [("d", "day", "DATE")]).first()["d"] == "2024-01-02"


def test_quoting_and_line_break_in_one_cell(spark):
    text = 'a,b\n"a ""b"", c","line1\nline2"\nplain,NA\n'
    df = inline_rows(spark, text, work_dir=work_path(spark, "inline"), auto_identify=False)
    rows = sorted(df.collect(), key=lambda r: r["a"])
    assert [tuple(r) for r in rows] == [('a "b", c', "line1\nline2"), ("plain", None)]


def test_concatenation_collision(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    assert ts.row_id(df).select("id").distinct().count() == 1
    assert ts.row_id(df, sep="\x1f").select("id").distinct().count() == 2


def test_duplicate_row_loads_once(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "x")], "k string, v string")
    out = sync_rows(df, SyncSpec([("k", "key", "STRING"), ("v", "val", "STRING")], "t"))
    assert out.count() == 1


@pytest.mark.parametrize("mapping", [
    [("a", "id", "STRING")],
    [("a", "Amt", "NUMBER"), ("b", "amt", "NUMBER")],
    [("zzz", "x", "STRING")],
    [],
])
def test_rejected_mappings(spark, mapping):
    df = _one(spark, "1", "2", names=["a", "b"])
    with pytest.raises(MappingError):
        ts.map_columns(ts.row_id(df), mapping)


def test_null_criteria_leaves_row(spark):
    df = spark.createDataFrame([(1, "P"), (2, "F"), (3, "O")], "k int, s string")
    crit = "nullif(s, 'P') = 'F'"
    upd = {r["k"]: r["s"] for r in ts.update_where(df, {"s": "X"}, crit).collect()}
    assert upd == {1: "P", 2: "X", 3: "O"}
    assert sorted(r["k"] for r in ts.delete_where(df, crit).collect()) == [1, 3]


def test_criteria_none_means_all_rows(spark):
    df = spark.createDataFrame([(1, "P"), (2, "F")], "k int, s string")
    assert {r["s"] for r in ts.update_where(df, {"s": "X"}, None).collect()} == {"X"}
    assert ts.delete_where(df, None).count() == 0


def test_row_counts_reported_by_observation(spark):
    df = spark.range(100).withColumn("even", F.col("id") % 2 == 0)
    obs = Observation("del")
    kept = ts.delete_where(df, "even", observation=obs).count()
    assert kept + obs.get["deleted_rows"] == 100


def test_bad_number_raises_even_without_ansi(spark):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = _one(spark, "1.2.3", names=["amt"])
        with pytest.raises(Exception, match="not a number"):
            ts.clean_numbers(df, ["amt"]).collect()
        assert ts.clean_numbers(_one(spark, "1,5", names=["amt"]), ["amt"]).first()["amt"] == 15.0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


def test_typed_import_rejects_malformed_values(spark):
    from tablesmith.sources.files import read_file
    path = work_path(spark, "typed")
    spark.createDataFrame([("a,b\n1,x\n2,3\n",)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception):
        read_file(spark, path, "csv", auto_identify=False, schema="a int, b int").collect()


def test_awkward_names_survive_sync_and_store(spark, store):
    import uuid

    from tablesmith.plans.sync import sync_table
    df = spark.createDataFrame([("1", "2,5", "x"), ("1", "2,5", "x")], "`a.b` string, `c d` string, `e``f` string")
    name = f"t_names_{uuid.uuid4().hex[:6]}"
    spec = SyncSpec([("a.b", "key.no", "STRING"), ("c d", "amount due", "NUMBER"), ("e`f", "we`ird", "STRING")], name)
    res = sync_table(df, spec, store)
    out = store.read(name)
    assert out.columns == ["id", "key.no", "amount due", "we`ird"] and res.rows_loaded == 1
    assert tuple(out.first())[1:] == ("1", 25.0, "x")


def test_decimal_numbers_keep_digits(spark):
    from decimal import Decimal
    df = _one(spark, "12,345,678,901,234,567.125", names=["amt"])
    out = ts.type_map(df, [("amt", "amount", "NUMBER")], number_type="decimal(38,3)").first()["amt"]
    assert out == Decimal("12345678901234567.125")
