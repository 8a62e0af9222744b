"""Dashboard query pack (JB9) over the scored table.

Each worksheet is one aggregate query: a dimension on one shelf, an
aggregate of ``prediction`` on the other.  Side-by-side condition panes are
answered in one scan (see ``operators.aggregate``).  Every function takes
the scored DataFrame, so it runs the same on the warehouse table, a
snapshot, or a freshly scored frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.functions.dates import rounded_age_ceil, rounded_age_floor
from claimlake.operators.aggregate import record_count, sum_by_panes, trend_line, unpivot_panes
from claimlake.operators.median import grouped_median
from claimlake.operators.radix import radix_median
from claimlake.schemas import DASHBOARD_CONDITIONS

CONDITIONS = [c for c, _ in DASHBOARD_CONDITIONS]


def condition_label(c) -> F.Column:
    """FN16: condition column name -> axis title (literal map, no join)."""
    pairs = []
    for code, label in DASHBOARD_CONDITIONS:
        pairs += [F.lit(code), F.lit(label)]
    return F.create_map(*pairs)[c]


def sum_cost_by_age(acp: DataFrame, measure: str = "prediction") -> DataFrame:
    """AG5: SUM(prediction) by FLOOR(age)."""
    return (acp.groupBy(rounded_age_floor("AGE_YRS").alias("rounded_age"))
            .agg(F.sum(measure).alias("sum_prediction")))


def _median(df: DataFrame, keys: list[str], measure: str, method: str = "bracket", **kw) -> DataFrame:
    """``method``: "bracket", one lazy plan (rows move once), or "radix", two passes of
    which the first runs at once (no row moves); the same values."""
    if method == "radix":
        return radix_median(df, keys, measure, "median_prediction")
    return grouped_median(df, keys, measure, "median_prediction", **kw)


def median_cost_by_age(acp: DataFrame, measure: str = "prediction", **kw) -> DataFrame:
    """AG6: MEDIAN(prediction) by CEILING(age)."""
    df = acp.select(rounded_age_ceil("AGE_YRS").alias("rounded_age"), measure)
    return _median(df, ["rounded_age"], measure, **kw)


def median_cost_by(acp: DataFrame, dim: str, measure: str = "prediction", **kw) -> DataFrame:
    """AG7 / AG8: MEDIAN(prediction) by RACE or STATE."""
    return _median(acp.select(dim, measure), [dim], measure, **kw)


def median_cost_by_condition(acp: DataFrame, measure: str = "prediction",
                             conditions: list[str] = CONDITIONS, **kw) -> DataFrame:
    """AG9: MEDIAN(prediction) per value of each condition flag, one pane per flag."""
    long = unpivot_panes(acp.select(measure, *conditions), conditions, measure)
    m = _median(long, ["condition", "flag"], measure, **kw)
    return m.withColumn("label", condition_label(F.col("condition")))


def sum_cost_by_condition(acp: DataFrame, measure: str = "prediction",
                          conditions: list[str] = CONDITIONS) -> DataFrame:
    """AG10: SUM(prediction) per value of each condition flag, one pane per flag."""
    s = sum_by_panes(acp.select(measure, *conditions), conditions, measure, "sum_prediction")
    return s.withColumn("label", condition_label(F.col("condition")))


def trend_cost_by_age(acp: DataFrame, how: str = "floor", measure: str = "prediction", **kw) -> DataFrame:
    """AG12: linear trend over the age marks of AG5 (sum) or AG6 (median)."""
    if how == "floor":
        marks = sum_cost_by_age(acp, measure).withColumnRenamed("sum_prediction", "y")
    else:
        marks = median_cost_by_age(acp, measure, **kw).withColumnRenamed("median_prediction", "y")
    return trend_line(marks, "rounded_age", "y")


def records_by(acp: DataFrame, dim: str) -> DataFrame:
    """AG11 on a worksheet: Number of Records per dimension value."""
    return record_count(acp, [dim])
