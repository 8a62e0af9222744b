"""Cleaning expressions: pure Column -> Column, all JVM-side.

Spark 4 runs with ANSI mode on, where ``to_date``, narrowing casts and
string->number casts raise on bad input; the raw files carry blanks,
malformed dates and over-wide integers, so every conversion here is a
``try_`` form that yields null and lets the caller count/quarantine it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The raw date text format and the claim-date fill value.
RAW_DATE_FORMAT = "yyyyMMdd"
DEFAULT_CLAIM_DATE = _dt.date(2008, 1, 1)
MISSING_CODE = "nan"
# Cell texts that the source's reader took as missing.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                 "NULL", "NaN", "None", "n/a", "nan", "null")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def try_cast(c, to: str) -> Column:
    """ANSI-safe cast: a value that does not convert becomes null."""
    return _c(c).try_cast(to)


def given(c) -> Column:
    """A cell holds a value: it is neither null nor one of the missing texts."""
    col = _c(c)
    return col.isNotNull() & ~F.trim(col.cast("string")).isin(*MISSING_TEXTS)


def _value(c) -> Column:
    return F.when(given(c), _c(c))


def parse_yyyymmdd(c) -> Column:
    """FN1: ``yyyyMMdd`` text (or an integer) to DATE; blank / malformed -> null."""
    s = F.trim(_c(c).cast("string"))
    return F.try_to_date(F.nullif(s, F.lit("")), RAW_DATE_FORMAT)


def fill_null_date(c, default: _dt.date = DEFAULT_CLAIM_DATE) -> Column:
    """FN2: replace a null date with a fixed date."""
    return F.coalesce(_c(c), F.lit(default))


def to_double(c) -> Column:
    """Text or number -> double; a missing or non-numeric text -> null."""
    return try_cast(_value(c), "double")


def cast_smallint(c) -> Column:
    """FN4: narrow to SMALLINT; out-of-range or non-integral text -> null (quarantined)."""
    return try_cast(try_cast(_value(c), "bigint"), "smallint")


def cast_int(c) -> Column:
    return try_cast(try_cast(_value(c), "bigint"), "int")


def cast_long(c) -> Column:
    return try_cast(_value(c), "bigint")


def fill_zero_short(c, width: str = "smallint") -> Column:
    """FN3: missing -> 0, then truncate toward zero into a narrow integer.

    A value that is no number or does not fit the width becomes null
    (quarantined), not 0.
    """
    return F.when(~given(c), F.lit(0).cast(width)).otherwise(try_cast(to_double(c), width))


def normalise_npi(c) -> Column:
    """FN6: numeric provider id (possibly float text) -> integral string; missing -> null."""
    number = try_cast(to_double(c), "bigint")
    return F.nullif(number.cast("string"), F.lit("-1"))


def cast_string(c) -> Column:
    """FN5: text column kept as text; a blank cell is null."""
    return F.nullif(_c(c).cast("string"), F.lit(""))


def code_present(c) -> Column:
    """FI2: a clinical code is present: not null and not the 'nan' marker."""
    col = _c(c)
    return col.isNotNull() & (col != F.lit(MISSING_CODE))


def count_present(c) -> Column:
    """AG3: number of rows whose code is present (``count(when(p, True))``)."""
    return F.count(F.when(code_present(c), F.lit(True)))
