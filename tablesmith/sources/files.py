"""File sources. Exports are scanned as text so nothing is guessed from the data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions import expressions as fx
from tablesmith.functions.tokens import NA_TOKENS
from tablesmith.operators.clean import null_tokens
from tablesmith.operators.mapping import MAPPING_DDL
from tablesmith.operators.sizing import broadcast_if_small
from tablesmith.session import staged
from tablesmith.sources.dialects import Dialect, identify

POS = "pos"

# RFC 4180 quoting: a quote inside a quoted cell is doubled.
CSV_OPTIONS = Dialect().options


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_reader(reader, *, multi_line: bool = True, strict: bool = True, recursive: bool = False, dialect: Dialect = Dialect()):
    """The options every CSV source shares: quoting, strictness (malformed records fail, and every file's header is checked)."""
    return reader.options(**dialect.options).option("multiLine", str(multi_line).lower()).option("enforceSchema", "false") \
        .option("mode", "FAILFAST" if strict else "PERMISSIVE").option("recursiveFileLookup", str(recursive).lower())


def _first_header(spark: SparkSession, path, recursive: bool, dialect: Dialect) -> list[str]:
    return spark.read.options(**dialect.options).option("inferSchema", "false") \
        .option("recursiveFileLookup", str(recursive).lower()).csv(path).columns


def csv_scan(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, *,
             na_tokens: Iterable[str] | None = NA_TOKENS, multi_line: bool = True, with_position: bool = False,
             strict: bool = True, recursive: bool = False, split: bool = False,
             dialect: Dialect | None = Dialect()) -> DataFrame:
    """Exported CSV (header row) as text columns, missing-value tokens -> null.

    ``columns`` fixes the expected header; otherwise the header of the first
    file names the columns, all as text. Either way every file must have that
    header, in that order, or the scan fails. ``multi_line`` keeps quoted line
    breaks inside one cell (each file is then read by one task; exports come as
    many part files); without it large files are split. ``split`` does both:
    files are cut into blocks and records put together across line breaks and
    cuts (see ``csv_records``), for files too large for one task.
    ``with_position`` adds ``pos`` = (file path, start of the block, row in the
    block) for first-wins loads: the order of the file, however it is split.
    ``strict`` fails on malformed records instead of nulling them.
    ``recursive`` reads files in sub-folders too (folder names never become columns).
    ``dialect`` names another delimiter or quote; with None they are identified
    first, from all records (``dialects.identify``).
    """
    path = path if isinstance(path, str) else list(path)
    dialect = dialect or identify(spark, path, recursive=recursive)
    names = list(columns) if columns is not None else _first_header(spark, path, recursive, dialect)
    if split and multi_line:
        df = _parsed_records(csv_records(spark, path, recursive=recursive, quote=dialect.quote), names, strict, dialect)
        df = df if with_position else df.drop(POS)
    else:
        df = csv_reader(spark.read, multi_line=multi_line, strict=strict, recursive=recursive, dialect=dialect) \
            .schema(_text_schema(names)).csv(path)
        if with_position:
            df = df.withColumn(POS, F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"),
                                             F.monotonically_increasing_id().alias("row")))
    return null_tokens(df, [c for c in df.columns if c != POS], na_tokens) if na_tokens is not None else df


def csv_records(spark: SparkSession, path: str | Sequence[str], *, recursive: bool = False, quote: str = '"') -> DataFrame:
    """The records of CSV files as text, also of files read in blocks by many tasks: file, block, row, header, record.

    A line begins a record when an even number of quotes stands before it in its
    file. So quotes are counted per block first (one number a block), added up
    over the blocks before, and then line by line inside each block: lines of one
    record share the row of the line that began it. What a cut leaves of a record
    are pieces, at most two a block; a running count of beginnings over a file's
    pieces tells which belong together. Only quotes as RFC 4180 has them are
    understood (doubled inside a quoted cell, none in other cells).

    Lines are brought together by block, so nothing larger than a block, or than
    one record, meets in a task. As in a whole-file read, empty lines between
    records are left out, and in a file whose first line ends with CR LF a line
    break inside a cell becomes LF. The first record of each file is marked as its
    header.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower()).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value",
        (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.min(F.struct("row", F.col("value").endswith("\r").alias("crlf")))
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), first.alias("first"))
    blocks, _ = staged(blocks.select("file", "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before"),
                                     F.first("first.crlf").over(Window.partitionBy("file").orderBy("block")).alias("crlf")))
    in_block = Window.partitionBy("file", "block").orderBy("row")
    above, so_far = in_block.rowsBetween(Window.unboundedPreceding, -1), in_block.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.join(broadcast_if_small(blocks), ["file", "block"])
    begins = (F.col("before") + F.coalesce(F.sum("quotes").over(above), F.lit(0))) % 2 == 0
    lines = lines.withColumn("begins", begins).withColumn("begun", F.max(F.when(F.col("begins"), F.col("row"))).over(so_far)) \
        .withColumn("header", (F.col("block") == 0) & (F.row_number().over(in_block) == 1))
    # ``begun`` is null for what the block before began.
    pieces = lines.groupBy("file", "block", "begun").agg(
        F.sort_array(F.collect_list(F.struct("row", "value"))).alias("lines"), F.sum("quotes").alias("quotes"), F.max("header").alias("header"), F.max("crlf").alias("crlf")) \
        .withColumn("text", F.array_join(F.col("lines.value"), "\n"))
    whole = F.col("begun").isNotNull() & (F.col("quotes") % 2 == 0)
    parts = pieces.filter(~whole).withColumn("nth", F.sum(F.col("begun").isNotNull().cast("long")).over(
        Window.partitionBy("file").orderBy("block", F.col("begun").asc_nulls_first())))
    joined = parts.groupBy("file", "nth").agg(
        F.sort_array(F.collect_list(F.struct("block", F.coalesce("begun", F.lit(-1)).alias("begun"), "text"))).alias("parts"),
        F.max("header").alias("header"), F.max("crlf").alias("crlf")).select(
        "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["begun"].alias("row"), "header", "crlf",
        F.array_join(F.col("parts.text"), "\n").alias("record"))
    records = pieces.filter(whole).select("file", "block", F.col("begun").alias("row"), "header", "crlf", F.col("text").alias("record")) \
        .unionByName(joined)
    record = F.when(F.col("record").endswith("\r"), F.expr("substr(record, 1, length(record) - 1)")).otherwise(F.col("record"))
    record = F.when(F.col("crlf"), F.replace(record, F.lit("\r\n"), F.lit("\n"))).otherwise(record)
    return records.withColumn("record", record).filter(F.col("record") != "").drop("crlf")


def _parsed_records(records: DataFrame, names: Sequence[str], strict: bool, dialect: Dialect) -> DataFrame:
    """Records as text columns with their position; every file's header must be ``names``."""
    options = {k: v for k, v in dialect.options.items() if k != "header"} | {"mode": "FAILFAST" if strict else "PERMISSIVE", "multiLine": "true"}
    fields = [f"c{i}" for i in range(len(names))]
    row = F.from_csv("record", ", ".join(f"{f} string" for f in fields), options)
    parsed = records.select("header", row.alias("r"), F.struct("file", "block", "row").alias("at"))
    same = reduce(lambda a, b: a & b, [F.col(f"r.{f}").eqNullSafe(F.lit(n)) for f, n in zip(fields, names)], F.lit(True))
    wrong = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema: "), F.col("at.file"))).cast("boolean")
    kept = F.when(~F.col("header"), F.lit(True)).otherwise(F.when(same, F.lit(False)).otherwise(wrong))
    return parsed.filter(kept).select(*[F.col(f"r.{f}").alias(n) for f, n in zip(fields, names)], F.col("at").alias(POS))


#: Types that detection tries, in this order; text otherwise.
_DETECTED = ("int", "bigint", "double", "boolean", "date", "timestamp")


def _detected(df: DataFrame) -> DataFrame:
    """Text columns cast to the first type that all their values have (one aggregate over the table)."""
    def bad(c: Column, t: str) -> Column:
        if t == "double":
            return fx.bad_number(c) | c.contains(",")
        return c.isNotNull() & c.try_cast(t).isNull()

    if not df.columns:
        return df
    tests = [F.max(bad(fx.col(c), t)).alias(f"b{i}_{t}") for i, c in enumerate(df.columns) for t in _DETECTED]
    found = df.agg(*tests).first()
    types = [next((t for t in _DETECTED if found[f"b{i}_{t}"] is False), "string") for i in range(len(df.columns))]
    return df.select(*[fx.col(c).cast(t).alias(c) for c, t in zip(df.columns, types)])


def _typed(c: Column, t: T.DataType, options: dict) -> Column:
    """Text to a declared type; a cell that does not parse fails the load."""
    if isinstance(t, T.StringType):
        return c
    if isinstance(t, T.NumericType):
        return fx.to_number(c, t.simpleString())
    if isinstance(t, T.TimestampNTZType) and "timestampNTZFormat" in options:
        value = F.try_to_timestamp(c, F.lit(options["timestampNTZFormat"])).cast("timestamp_ntz")
    elif isinstance(t, T.TimestampType) and "timestampFormat" in options:
        value = F.try_to_timestamp(c, F.lit(options["timestampFormat"]))
    elif isinstance(t, T.DateType) and "dateFormat" in options:
        value = F.try_to_timestamp(c, F.lit(options["dateFormat"])).cast("date")
    else:
        value = c.try_cast(t)
    return F.when(c.isNotNull() & value.isNull(), F.raise_error(F.concat(
        F.lit(f"CAST_INVALID_INPUT: not a {t.simpleString()}: '"), c, F.lit("'")))).otherwise(value)


def read_file(spark: SparkSession, path: str, file_type: str = "csv", *, auto_identify: bool = True,
              schema: str | T.StructType | None = None, options: dict | None = None, multi_line: bool = True) -> DataFrame:
    """A file to import: csv, json or parquet; malformed records fail, in csv missing-value tokens are null.

    csv: ``auto_identify`` finds delimiter and quote (``dialects.identify``), else
    they are comma and double quote; ``sep`` and ``quote`` in ``options`` hold over
    both. The cells are scanned as text; with ``schema`` they are then parsed to
    its types, else with ``auto_identify`` to the types that all values have,
    else they stay text.
    """
    ft, opts = file_type.lower(), dict(options or {})
    if ft == "csv":
        declared = None
        if schema is not None:
            declared = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        given = {k: opts[k] for k in ("sep", "quote") if k in opts}
        dialect = identify(spark, path) if auto_identify and len(given) < 2 else Dialect()
        df = csv_scan(spark, path, declared.names if declared else None, multi_line=multi_line, dialect=replace(dialect, **given))
        if declared is not None:
            return df.select(*[_typed(fx.col(f.name), f.dataType, opts).alias(f.name) for f in declared.fields])
        return _detected(df) if auto_identify else df
    if ft == "json":
        r = spark.read.option("mode", "FAILFAST").options(**opts)
        return (r.schema(schema) if schema is not None else r).json(path)
    if ft == "parquet":
        return spark.read.options(**opts).parquet(path)
    raise ValueError(f"unsupported file type {file_type!r}; use csv, json or parquet")


def mapping_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Schema CSV (``source_key, destination_key, data_type`` + any other columns) as rows.

    Header names are kept as they are; ``position`` is the row order in
    the file, for mapping order. All files have one header (else the scan fails).
    """
    df = csv_scan(spark, path, na_tokens=None, recursive=True)
    need = [f.split()[0] for f in MAPPING_DDL.split(", ")]
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"schema CSV lacks column(s) {missing}")
    return df.withColumn("position", F.monotonically_increasing_id())


def parse_text_rows(lines: DataFrame, text_col: str, schema: str | T.StructType, file_type: str = "csv",
                    options: dict | None = None) -> DataFrame:
    """A column of raw CSV/JSON records -> typed rows (one record per cell); malformed records and cells fail."""
    opts = {k: v for k, v in CSV_OPTIONS.items() if k != "header"} if file_type == "csv" else {}
    opts = {"mode": "FAILFAST", **opts, **(options or {})}
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"{fx.quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    if file_type == "csv":
        parsed = F.from_csv(fx.col(text_col), ddl, opts)
    elif file_type == "json":
        parsed = F.from_json(fx.col(text_col), schema, opts)
    else:
        raise ValueError(f"unsupported file type {file_type!r}; use csv or json")
    return lines.select(parsed.alias("_r")).select("_r.*")


def inline_rows(spark: SparkSession, data: str, *, work_dir: str, file_type: str = "csv",
                schema: str | T.StructType | None = None, auto_identify: bool = True) -> DataFrame:
    """Raw text given in the call (a CSV/JSON document) as a DataFrame.

    The text is written once to ``work_dir`` in the shared folder and read
    with the same readers as an import file, so quoting and line breaks
    inside cells follow the file rules.
    """
    spark.createDataFrame([(data,)], "value string").coalesce(1).write.mode("errorifexists").text(work_dir)
    return read_file(spark, work_dir, file_type, auto_identify=auto_identify, schema=schema)
