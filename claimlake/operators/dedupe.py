"""Sort and keep-top de-duplication (SO1, SO2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_desc(df: DataFrame, by: str, *tiebreak: str) -> DataFrame:
    """SO1: global sort, descending (range-partitioned by Spark)."""
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc() for t in tiebreak])


def keep_top(df: DataFrame, keys: list[str], by: str, tiebreak: list[str]) -> DataFrame:
    """SO2: per key subset keep the row with the highest ``by``.

    Ties on ``by`` keep the row that is smallest on ``tiebreak`` (a declared,
    repeatable order; any orderable types).  A null ``by`` loses to any value.
    Written as a min over a struct ordered (by is null, -by, tiebreak...): the
    aggregate combines map-side, so a key holding a third of all rows is reduced
    to one row per task before the shuffle.  Since a struct is no fixed-width
    buffer, Spark runs it as a sort aggregate: rows are sorted by the keys inside
    each task, before and after the shuffle.  A hash aggregate of the score
    alone would need a join of all rows with its result, which shuffles every row of a hot
    key.  Null keys form their own group, as in a drop-duplicates.
    """
    others = [c for c in df.columns if c not in keys and c not in tiebreak and c != by]
    order = [F.col(by).isNull().alias("_null"), (-F.col(by)).alias("_neg")]
    order += [F.col(t).alias(f"_tb{i}") for i, t in enumerate(tiebreak)]
    packed = F.struct(*order, F.col(by).alias("_by"), *[F.col(c) for c in others])
    top = df.groupBy(*keys).agg(F.min(packed).alias("_top"))
    picked = [F.col("_top._by").alias(by)]
    picked += [F.col(f"_top._tb{i}").alias(t) for i, t in enumerate(tiebreak)]
    picked += [F.col("_top")[c].alias(c) for c in others]
    return top.select(*keys, *picked).select(*df.columns)
