"""Aggregation helpers: side-by-side panes, trend lines, default measures.

A dashboard shelf with several dimensions joined by '+' draws one
independent pane per dimension: that is one grouping per column, not one
grouping over all of them.  We answer all panes in ONE scan by unpivoting
the pane columns into (pane, key) pairs and grouping once; sums and counts
are combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.median import grouped_median


def unpivot_panes(df: DataFrame, pane_cols: list[str], measure: str,
                  pane_name: str = "condition", key_name: str = "flag") -> DataFrame:
    """(measure, c1..ck) -> (pane, key, measure), one row per pane per input row."""
    key_type = df.schema[pane_cols[0]].dataType.simpleString()
    return df.unpivot(
        ids=[measure],
        values=[F.col(c).cast(key_type).alias(c) for c in pane_cols],
        variableColumnName=pane_name, valueColumnName=key_name)


def sum_by_panes(df: DataFrame, pane_cols: list[str], measure: str, alias: str,
                 pane_name: str = "condition", key_name: str = "flag") -> DataFrame:
    long = unpivot_panes(df, pane_cols, measure, pane_name, key_name)
    return long.groupBy(pane_name, key_name).agg(F.sum(measure).alias(alias))


def median_by_panes(df: DataFrame, pane_cols: list[str], measure: str, alias: str,
                    pane_name: str = "condition", key_name: str = "flag", **kw) -> DataFrame:
    long = unpivot_panes(df, pane_cols, measure, pane_name, key_name)
    return grouped_median(long, [pane_name, key_name], measure, alias, **kw)


def trend_line(marks: DataFrame, x: str, y: str) -> DataFrame:
    """AG12: least-squares line with intercept over already-aggregated marks."""
    return marks.agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
        F.regr_count(F.col(y), F.col(x)).alias("n_marks"),
    )


def default_measures(df: DataFrame) -> DataFrame:
    """AG13: the default aggregate by role: numbers are summed, everything else counted."""
    aggs: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            aggs.append(F.sum(f.name).alias(f"sum_{f.name}"))
        else:
            aggs.append(F.count(f.name).alias(f"count_{f.name}"))
    return df.agg(*aggs)


def record_count(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """AG11: 'Number of Records' = a constant 1 summed (per group if keys are given)."""
    agg = F.sum(F.lit(1)).cast("long").alias("number_of_records")
    return df.groupBy(*keys).agg(agg) if keys else df.agg(agg)


def approx_distinct_columns(df: DataFrame, rsd: float = 0.05) -> DataFrame:
    """AG14: approximate distinct count of every column in one pass (HLL++)."""
    row = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in df.columns])
    return row.unpivot(ids=[], values=df.columns, variableColumnName="column",
                       valueColumnName="approx_distinct")
