"""Scalar column expressions: null tokens, coercion, dates, JSON images.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Text cells that mean "missing" in a CSV file. These are the default NA
# tokens of the pandas CSV reader, kept verbatim so a file means the same
# thing here as in a pandas-based loader.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Text accepted as a boolean when classifying a text column.
BOOL_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")
# A plain decimal number with optional sign, fraction and exponent, or an
# infinity. Anything else (currency signs, thousands separators, hex,
# underscores, type suffixes like 5d, nan) is not a number.
NUMBER_PATTERN = (r"^\s*[+-]?((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?\s*$"
                  r"|^\s*[+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$")
# Accepted datetime layouts, tried in this order; the first that parses wins.
DATETIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
)
# More layouts a job may name. Fractions have one to six digits; an offset
# (``Z``, ``+02:00``) turns the wall clock into UTC.
ALL_FORMATS = (
    *DATETIME_FORMATS,
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "MM/dd/yyyy HH:mm",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "dd.MM.yyyy HH:mm:ss",
    "dd.MM.yyyy",
    "dd/MM/yyyy",
    "yyyyMMdd",
)
# Layout of the timestamp prefix given to archived files.
# Text used to fill missing values in text columns.
UNKNOWN_TEXT = "Unknown"
# ---------------------------------------------------------------------------


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: str | Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """F1 on text input: a cell holding one of ``tokens`` becomes null."""
    c = col_of(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def is_number_text(c: str | Column) -> Column:
    return col_of(c).rlike(NUMBER_PATTERN)


def parse_number(c: str | Column, to: str = "double") -> Column:
    """Text → number, unparseable → null (never an error).

    ``try_cast`` alone accepts Java literals such as ``5d`` and the text
    ``nan``; the pattern guard rejects those, so NaN never enters the data.
    """
    c = col_of(c)
    return F.when(is_number_text(c), F.trim(c).try_cast(to))


def nan_to_null(c: str | Column) -> Column:
    """Normalize NaN to null for float columns (NaN sorts above every number
    in Spark, which would let it pass range checks)."""
    c = col_of(c)
    return F.when(~F.isnan(c), c)


def layout_shape(fmt: str) -> str:
    """A permissive regex every text that ``fmt`` can parse matches (digit
    fields may be longer or shorter, letters are literal). Used to skip
    layouts that cannot apply: a failed parse costs an exception inside
    the JVM, a failed regex does not."""
    out, i = ["^[+-]?"], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        if ch == "'":                       # quoted literal
            k = fmt.index("'", i + 1)
            out.append(re.escape(fmt[i + 1:k]))
            i = k + 1
            continue
        if ch == "X":                       # offset
            out.append(r"(Z|[+-]\d{2}:?\d{2})")
        elif ch.isalpha() and fmt.isalnum():
            out.append(rf"\d{{{j - i}}}")   # nothing between the fields
        elif ch.isalpha():
            out.append(r"\d+")
        else:
            out.append(re.escape(fmt[i:j]))
        i = j
    return "".join(out) + "$"


def parse_datetime(c: str | Column,
                   formats: Sequence[str] = DATETIME_FORMATS) -> Column:
    """Text → timestamp_ntz using an ordered list of layouts (the
    first that parses wins); text matching none of them → null. Each layout
    is attempted only on text of its shape."""
    return F.coalesce(F.lit(None).cast("timestamp_ntz"), *[
        parse_layout(c, f) for f in formats])


def parse_layout(c: str | Column, fmt: str) -> Column:
    """Text of one layout → timestamp_ntz, any other text → null."""
    c = col_of(c)
    return F.when(c.rlike(layout_shape(fmt)), F.try_to_timestamp(
        c, F.lit(fmt)).cast("timestamp_ntz"))


def to_text(c: str | Column) -> Column:
    """Any value → text; a null stays null (not the text 'nan')."""
    return col_of(c).cast("string")


# Layout of timestamps in row images: up to six digits of a second.
IMAGE_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def json_image(cols: Iterable[str | Column]) -> Column:
    """a row image as JSON text; null fields are kept (as ``null``) and
    timestamps are written as ``yyyy-MM-dd HH:mm:ss`` with the fraction of a
    second they have; decimals are written with all their digits."""
    return F.to_json(F.struct(*[col_of(c) for c in cols]),
                     {"ignoreNullFields": "false",
                      "timestampNTZFormat": IMAGE_TIME,
                      "timestampFormat": IMAGE_TIME})


def ts_literal(ts: _dt.datetime | _dt.date | str) -> Column:
    """A timestamp_ntz literal (the ``as_of`` instant of a run)."""
    if isinstance(ts, str):
        return F.lit(ts).cast("timestamp_ntz")
    if not isinstance(ts, _dt.datetime):
        ts = _dt.datetime(ts.year, ts.month, ts.day)
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def as_datetime(ts: _dt.datetime | _dt.date | str) -> _dt.datetime:
    if isinstance(ts, str):
        return _dt.datetime.fromisoformat(ts)
    if not isinstance(ts, _dt.datetime):
        return _dt.datetime(ts.year, ts.month, ts.day)
    return ts


def days_before(as_of, days: int) -> Column:
    """``CURRENT_DATE - INTERVAL n days`` against an explicit
    ``as_of``: midnight of the as_of date minus ``days`` (inclusive bound)."""
    d = as_datetime(as_of).date() - _dt.timedelta(days=days)
    return ts_literal(d)


def day_of(c: str | Column) -> Column:
    """F8: ``DATE(ts)``."""
    return F.to_date(col_of(c))


def month_of(c: str | Column) -> Column:
    """``DATE_TRUNC('month', ts)::DATE``."""
    return F.trunc(col_of(c), "month")


def elapsed_seconds(start: str | Column, end: str | Column) -> Column:
    """whole seconds from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", col_of(start), col_of(end))


def severity_of(count: str | Column, threshold: int = 100) -> Column:
    """More than ``threshold`` affected rows is CRITICAL, else WARNING."""
    return F.when(col_of(count) > threshold, F.lit("CRITICAL")).otherwise(
        F.lit("WARNING"))
