"""Projection helpers (PR2, PR5, PR6)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.functions.clean import try_cast
from pyspark.sql import types as T


def select_slice(df: DataFrame, start: int, stop: int | None = None) -> DataFrame:
    """PR5: columns by position, like ``frame.iloc[:, start:stop]``."""
    return df.select(*df.columns[start:stop])


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    """PR5 (preferred): columns whose name matches a regular expression."""
    rx = re.compile(pattern)
    return df.select(*[c for c in df.columns if rx.fullmatch(c)])


def cast_by_type(df: DataFrame, int64_to: str | None = "smallint",
                 float_to_string: tuple[int, int | None] | None = None) -> DataFrame:
    """PR6: one select that narrows every 64-bit integer column and turns the
    floating columns inside a positional slice into text.

    Narrowing is a ``try_cast``: a value that does not fit becomes null (and is
    counted by the caller) instead of wrapping around.
    """
    fl = set()
    if float_to_string is not None:
        a, b = float_to_string
        fl = {f.name for f in df.schema.fields[a:b]
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if int64_to and isinstance(f.dataType, T.LongType):
            out.append(try_cast(c, int64_to).alias(f.name))
        elif f.name in fl:
            out.append(c.cast("string").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)

