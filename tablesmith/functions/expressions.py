"""Built-in column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablesmith.functions.tokens import (ALERT_FORMAT, ALERT_ZONE, FALSE_SPELLINGS, NA_TOKENS, NULL_HASH_TOKEN,
                                         TRUE_SPELLINGS)


def col(name: str) -> Column:
    """Column by exact name, safe for dots, spaces and back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def quote(name: str) -> str:
    """Back-quoted identifier for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def fresh(name: str, *used: Iterable[str]) -> str:
    """``name``, with underscores in front until no column of ``used`` is called so (names compare without case)."""
    taken = {c.lower() for columns in used for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def hash_text(c: Column, null_token: str = NULL_HASH_TOKEN) -> Column:
    """Text a cell contributes to a row id: its string form, or ``null_token`` when missing."""
    return F.coalesce(c.cast("string"), F.lit(null_token))


def row_hash(columns: Sequence[str], sep: str = "", null_token: str = NULL_HASH_TOKEN) -> Column:
    """SHA-256 hex of the cells' text joined by ``sep`` (default: no separator)."""
    if not columns:
        raise ValueError("row_hash needs at least one column")
    return F.sha2(F.concat_ws(sep, *[hash_text(col(c), null_token) for c in columns]), 256)


def na_to_null(c: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Null for a missing-value token, the cell otherwise."""
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def nan_to_null(c: Column) -> Column:
    """Null for a floating NaN, the value otherwise."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def number_text(c: Column) -> Column:
    """Number text with thousands separators removed."""
    return F.replace(c.cast("string"), F.lit(","), F.lit(""))


# The number texts that load, after commas and surrounding white space are gone.
NUMBER_PATTERN = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"
_FLOATS = ("double", "float")


def _parsed(text: Column, dtype: str) -> Column:
    """The value of a text that is a number, null for any other text (``12D``, ``0x1p3``, ...) and for NaN."""
    value = F.when(text.rlike(NUMBER_PATTERN), text).try_cast(dtype)
    return nan_to_null(value) if dtype in _FLOATS else value


def is_number(text: Column, dtype: str = "double") -> Column:
    """Whether cleaned text stands for a number of this type (NaN does: it loads as null)."""
    fits = F.when(text.rlike(NUMBER_PATTERN), text).try_cast(dtype).isNotNull()
    return fits | text.rlike(r"^[+-]?(?i:nan)$")


def to_number(c: Column, dtype: str = "double", on_error: str = "raise") -> Column:
    """Parse number text (``1,234.50`` -> 1234.5; NaN -> null).

    ``on_error="raise"`` fails the query on text that is no number,
    ``"null"`` turns it into null.
    """
    text = F.trim(number_text(c))
    parsed = _parsed(text, dtype)
    if on_error == "raise":  # explicit, so it holds whatever spark.sql.ansi.enabled says
        return F.when(text.isNotNull() & ~is_number(text, dtype),
                      F.raise_error(F.concat(F.lit("CAST_INVALID_INPUT: not a number: '"), text, F.lit("'")))
                      ).otherwise(parsed)
    if on_error == "null":
        return parsed
    raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")


def bad_number(c: Column, dtype: str = "double") -> Column:
    """True where a cell has text that does not parse as a number."""
    return c.isNotNull() & ~F.coalesce(is_number(F.trim(number_text(c)), dtype), F.lit(False))


def boolean_text(c: Column) -> Column:
    """Boolean spellings stored as ``true``/``false``; other text kept."""
    return (F.when(c.isin(list(TRUE_SPELLINGS)), F.lit("true"))
            .when(c.isin(list(FALSE_SPELLINGS)), F.lit("false"))
            .otherwise(c))


def utc_clock(ts: Column, instant: bool = False) -> Column:
    """UTC wall-clock time (timestamp_ntz): of a TIMESTAMP (``instant``) whatever the session zone, or as it stands."""
    ntz = ts.cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ntz) if instant else ntz


def zone_text(ts: Column, zone: str = ALERT_ZONE, fmt: str = ALERT_FORMAT, *, instant: bool = False) -> Column:
    """A UTC wall-clock time (or, with ``instant``, a TIMESTAMP) rendered in ``zone`` as ``fmt`` text."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock(ts, instant)), fmt)


def epoch_ms(ts: Column, *, instant: bool = False) -> Column:
    """Epoch milliseconds of a UTC wall-clock time (or, with ``instant``, a TIMESTAMP), truncated to whole seconds."""
    if instant:
        return F.floor(F.unix_millis(ts) / 1000).cast("bigint") * F.lit(1000)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", start, F.date_trunc("second", ts.cast("timestamp_ntz")).cast("timestamp_ntz")) * F.lit(1000)


def is_instant(df, name: str) -> bool:
    """Whether a column is a TIMESTAMP (an instant, shown in the session's zone) and not a wall-clock time."""
    return df.schema[name].dataType.typeName() == "timestamp"


def utc_from_epoch_ms(ms: Column) -> Column:
    """UTC wall-clock time stamp (timestamp_ntz) of epoch milliseconds, whatever the session zone."""
    return F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def now_epoch_ms() -> Column:
    """Current epoch milliseconds in whole seconds (job ``updated_at``)."""
    return F.unix_timestamp() * F.lit(1000)
