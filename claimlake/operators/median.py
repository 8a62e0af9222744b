"""Exact grouped median by one plan at every size.

Spark's ``median`` keeps every distinct value of a group in one task, and the
dashboard groups (race: 4 values, state: 52, condition flag: 2) each hold a
large share of all rows.  Instead:

* a bracket for each group: two approximate percentiles just below and above
  the middle (a bounded sketch, combined map-side).  The sketch's rank error is
  smaller than the bracket's distance from the middle, so both middle ranks lie
  inside it, at every group size;
* an exact count: values below and above the bracket only as counts, values
  inside as a histogram, again combined map-side.  A running count over the
  few values inside picks the one or two middle values.

Nothing is sampled or dropped, no job runs while the plan is built, and no task
holds more of a group than its bracket (about 8 / ``accuracy`` of its values).
Two middle values are averaged as ``percentile(v, 0.5)`` does it, half of the
one plus half of the other; nulls are ignored and a group with no values gets
null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000


def grouped_median(df: DataFrame, keys: list[str], value: str, alias: str,
                   accuracy: int = ACCURACY, approx_accuracy: int | None = None) -> DataFrame:
    """Median of ``value`` per group; exact whatever ``accuracy`` is (10 or more):
    it only sets the width of the bracket.

    ``approx_accuracy`` set: one pass with ``percentile_approx`` (bounded
    sketch per group, rank error about 1/accuracy) instead of the exact value.
    """
    if approx_accuracy:
        return df.groupBy(*keys).agg(
            F.percentile_approx(value, 0.5, approx_accuracy).cast("double").alias(alias))
    rows = df.select(F.struct(*[F.col(k) for k in keys]).alias("_g"), F.col(value).alias("_v"))
    number = F.col("_v").cast("double")  # keeps the order, so the bracket holds for longs and decimals too
    half = 4.0 / accuracy
    brackets = rows.groupBy("_g").agg(
        F.percentile_approx(number, [max(0.0, 0.5 - half), min(1.0, 0.5 + half)], accuracy).alias("_p"))
    low, high = F.col("_p")[0], F.col("_p")[1]
    side = F.when(number < low, -1).when(number <= high, 0).otherwise(1)
    placed = rows.join(brackets, "_g").select("_g", "_v", side.alias("_s"))
    counts = (placed.groupBy("_g", "_s", F.when(F.col("_s") == 0, F.col("_v")).alias("_x"))
              .agg(F.count("_v").alias("_c")))
    group = Window.partitionBy("_g")
    run = group.orderBy("_s", "_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("_g", "_s", "_x", "_c", F.sum("_c").over(run).alias("_to"), F.sum("_c").over(group).alias("_n"))

    def at(rank: str):
        r = F.expr(rank)
        return F.max(F.when((F.col("_to") - F.col("_c") <= r) & (r < F.col("_to")), F.col("_x"))).cast("double")

    mids = ranked.groupBy("_g").agg(at("(_n - 1) div 2").alias("_lo"), at("_n div 2").alias("_hi"))
    middle = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_lo") * 0.5 + F.col("_hi") * 0.5)
    return mids.select(*[F.col("_g")[k].alias(k) for k in keys], middle.alias(alias))
