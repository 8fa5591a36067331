"""Which delimiter and which quote a CSV export uses, judged over whole files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Candidates, preferred in this order where they fit equally well.
DELIMITERS = (",", ";", "\t", "|")
QUOTES = ('"', "'")


@dataclass(frozen=True)
class Dialect:
    """Delimiter and quote of a CSV file; a quote inside a quoted cell is doubled."""

    sep: str = ","
    quote: str = '"'

    @property
    def options(self) -> dict[str, str]:
        return {"header": "true", "sep": self.sep, "quote": self.quote, "escape": self.quote}


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _cells(record: Column, sep: str, quote: str) -> Column:
    """Number of cells of a whole record: delimiters outside quotes are those in every other piece between quotes."""
    pieces = F.split(record, quote)
    return _count(F.array_join(F.filter(pieces, lambda x, i: i % 2 == 0), ""), sep) + 1


def _edge(value: Column, sep: str, quote: str) -> Column:
    """A quote stands where a cell begins or ends: lines of quoted cells have one there, apostrophes in words do not."""
    with_edges = F.concat(F.lit(sep), F.regexp_replace(value, "\r$", ""), F.lit(sep))
    return with_edges.contains(sep + quote) | with_edges.contains(quote + sep)


def identify(spark: SparkSession, path: str | Sequence[str], *, recursive: bool = False) -> Dialect:
    """The delimiter (comma, semicolon, tab, bar) and quote (double, single) of files that share a header.

    Every record is judged. A candidate fits a record that it cuts into as many
    cells as the header, delimiters inside quotes not counted. Candidates that cut
    the header and fit at least half of all records come first: a few malformed
    records do not turn a file into one column, the scan names them instead. Among
    them the one that fits a larger share of its records wins, then the one with more cells, then the
    one whose quote stands at a cell's edge in more lines, then the earlier one of
    ``DELIMITERS``, double quote before single. Where no candidate cuts the header
    the file has one column, and the delimiter is one that leaves its records whole;
    a file without any delimiter, or an empty one, is comma and double quote. Blank
    records do not count.

    The single quote is a candidate only when at least half of the lines that hold
    one have it at a cell's edge. Two scans without a shuffle decide while no line
    leaves a quote open; only for quotes that do span lines are the records put
    together first (``csv_records``).
    """
    from tablesmith.sources.files import csv_records

    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower()).text(path)
    value = F.col("value")
    tests = []
    for q, quote in enumerate(QUOTES):
        tests += [F.count_if(value.contains(quote)).alias(f"has{q}"), F.count_if(_count(value, quote) % 2 == 1).alias(f"open{q}"),
                  F.count_if(value.contains(quote) & _any([_edge(value, d, quote) for d in DELIMITERS])).alias(f"any{q}")]
        tests += [F.count_if(_edge(value, d, quote)).alias(f"edge{q}_{i}") for i, d in enumerate(DELIMITERS)]
    seen = lines.agg(*tests).first()
    found = []
    for q, quote in enumerate(QUOTES):
        if q and (not seen[f"has{q}"] or 2 * seen[f"any{q}"] < seen[f"has{q}"]):
            continue
        records = csv_records(spark, path, recursive=recursive, quote=quote).select("record") if seen[f"open{q}"] \
            else lines.select(F.regexp_replace("value", "\r$", "").alias("record"))
        headers = [len(spark.read.options(**Dialect(d, quote).options).option("recursiveFileLookup", str(recursive).lower())
                       .csv(path).columns) for d in DELIMITERS]
        fits = _fits(records, quote, headers)
        for i, d in enumerate(DELIMITERS):
            share = Fraction(fits[f"fit{i}"], fits["n"] or 1)
            found.append(((headers[i] > 1 and 2 * share >= bool(fits["n"]), share, headers[i], seen[f"edge{q}_{i}"], -i, -q), Dialect(d, quote)))
    return max(found, key=lambda x: x[0])[1]


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _fits(records: DataFrame, quote: str, headers: Sequence[int]):
    """How many records there are, and how many of them each delimiter cuts into as many cells as the header."""
    record = F.col("record")
    return records.filter(record != "").agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(_cells(record, d, quote) == n).alias(f"fit{i}") for i, (d, n) in enumerate(zip(DELIMITERS, headers))]).first()
