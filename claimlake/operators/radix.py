"""Exact grouped median by radix selection: rows never move.

Every value is mapped to a long of the same order.  A pass counts, for each group, the values
by the next digit of that long; counts combine map-side, so what is shuffled are
bins, 65,536 a group at most, not rows.  The bin that holds the middle rank is refined by the next pass,
which reads only rows of that bin: the chosen bins (two a group at most) go to
every task as a broadcast, after their number has been checked.  As soon as no
chosen bin holds more than ``small`` values, the rest of the long is counted at
once.  On usual data that is two passes.

Beyond ``MAX_GROUPS`` groups the bins are no longer small, and groups are: then
rows are shuffled by group, by :func:`claimlake.operators.median.grouped_median`.

Two middle values are averaged as ``percentile(v, 0.5)`` does it, half of the one
plus half of the other; nulls are ignored, NaN is larger than any number, zero has
one sign, and a group without values gets null.  All passes but the last run when the function is
called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators.median import grouped_median
from claimlake.session import scratch_path

DIGITS = (48, 32, 16, 0)
#: Groups whose bins may be broadcast (some 100 bytes each), and values of a bin that are counted one by one.
MAX_GROUPS, SMALL = 100_000, 1 << 20
_ONE = 1 << 52


def _power(e: Column) -> Column:
    return F.pow(F.lit(2.0), e)


def _from_bits(bits: Column) -> Column:
    e, mantissa = F.shiftright(bits, 52).cast("int"), bits.bitwiseAND(F.lit(_ONE - 1)).cast("double")
    tiny = bits.cast("double") * 2.0 ** -537 * 2.0 ** -537
    return (F.when(bits > 2047 * _ONE, float("nan")).when(bits == 2047 * _ONE, float("inf"))
            .when(bits < _ONE, tiny).otherwise((mantissa / float(_ONE) + 1.0) * _power(e - 1023)))


def has_order_key(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.DoubleType, T.FloatType)) or (isinstance(kind, T.DecimalType) and kind.precision <= 18)


def keyed(rows: DataFrame, kind: T.DataType) -> DataFrame:
    """``rows`` (_g, _v) -> (_g, _k): a long with the order of the value.

    For a double: its bits (exponent and mantissa as stored), negative for a
    negative one, by exact arithmetic, as scaling by powers of two loses nothing;
    in steps, so that each part is worked out once."""
    v = F.col("_v")
    if isinstance(kind, T.IntegralType):
        return rows.select("_g", v.cast("long").alias("_k"))
    if isinstance(kind, T.DecimalType):
        return rows.select("_g", (v.cast(T.DecimalType(38, kind.scale)) * 10 ** kind.scale).cast("long").alias("_k"))
    a, guess, e = F.col("_a"), F.col("_guess"), F.col("_e")
    steps = rows.select("_g", v.cast("double").alias("_v")).select("_g", "_v", F.abs("_v").alias("_a"))
    usual = (a >= 2.0 ** -1022) & (a < float("inf"))
    steps = steps.select("_g", "_v", "_a", F.when(usual, F.floor(F.log2(a)).cast("int")).otherwise(0).alias("_guess"))
    steps = steps.select("_g", "_v", "_a", (guess + F.when(_power(guess + 1) <= a, 1).when(_power(guess) > a, -1).otherwise(0)).alias("_e"))
    normal = (e + 1023).cast("long") * _ONE + ((a / _power(e) - 1.0) * float(_ONE)).cast("long")
    tiny = (a * 2.0 ** 537 * 2.0 ** 537).cast("long")
    bits = (F.when(F.isnan(a), 2047 * _ONE + 1).when(a == float("inf"), 2047 * _ONE)
            .when(a < 2.0 ** -1022, tiny).otherwise(normal))
    steps = steps.select("_g", "_v", bits.alias("_bits"))
    return steps.select("_g", F.when(v.isNull(), None).when(v < 0, -F.col("_bits")).otherwise(F.col("_bits")).alias("_k"))


def from_order_key(key: Column, kind: T.DataType) -> Column:
    """The value of an order key, as a double."""
    if isinstance(kind, T.IntegralType):
        return key.cast("double")
    if isinstance(kind, T.DecimalType):
        return (key.cast(T.DecimalType(38, kind.scale)) / F.lit(10 ** kind.scale).cast(T.DecimalType(19, 0))).cast(kind).cast("double")
    return F.when(key < 0, -_from_bits(-key)).otherwise(_from_bits(key))


def _kept(df: DataFrame, tag: str) -> DataFrame:
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_counts(rows: DataFrame) -> DataFrame:
    """``rows`` (_g, _k) -> values by group and first digit; a group without values has a null digit."""
    return rows.groupBy("_g", F.shiftright("_k", DIGITS[0]).alias("_b")).agg(F.count("_k").alias("_c"))


def next_counts(rows: DataFrame, chosen: DataFrame, above: int, shift: int) -> DataFrame:
    """Values of the chosen bins (_g, _p, _lo, _hi) by the digits down to ``shift``."""
    inside = rows.withColumn("_p", F.shiftright("_k", above)).join(F.broadcast(chosen), ["_g", "_p"])
    return (inside.groupBy("_g", "_p", F.shiftright("_k", shift).alias("_b"))
            .agg(F.count(F.lit(1)).alias("_c"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi")))


def _chosen(counts: DataFrame, part: list[str], low: Column, high: Column) -> DataFrame:
    """The bins of ``counts`` that hold the ranks ``low`` and ``high`` of their part, with
    the ranks inside them; a group without values keeps its row, without ranks."""
    whole, run = Window.partitionBy(*part), Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    c = counts.withColumn("_n", F.sum("_c").over(whole)).withColumn("_to", F.sum("_c").over(run))
    before = F.col("_to") - F.col("_c")
    c = c.select("*", low.alias("_l"), high.alias("_h"))
    lo, hi = (F.when((before <= r) & (r < F.col("_to")), r - before) for r in (F.col("_l"), F.col("_h")))
    return (c.select("_g", F.col("_b").alias("_p"), lo.alias("_lo"), hi.alias("_hi"), "_c", "_n")
            .where("_lo IS NOT NULL OR _hi IS NOT NULL OR _n = 0").drop("_n"))


def radix_median(df: DataFrame, keys: list[str], value: str, alias: str, max_groups: int = MAX_GROUPS, small: int = SMALL) -> DataFrame:
    """Median of ``value`` per group of ``keys``."""
    kind = df.schema[value].dataType
    if not has_order_key(kind):
        return grouped_median(df, keys, value, alias)
    rows = keyed(df.select(F.struct(*[F.col(k) for k in keys]).alias("_g"), F.col(value).alias("_v")), kind)
    chosen = _chosen(first_counts(rows), ["_g"], F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2))
    groups, k = None, 0
    while k < len(DIGITS) - 1:
        chosen, above = _kept(chosen, "median-bins"), DIGITS[k]
        groups = chosen.select("_g").distinct() if groups is None else groups
        largest, n = chosen.agg(F.max("_c"), F.count("_lo")).first()
        if n > max_groups:
            return grouped_median(df, keys, value, alias)
        k = len(DIGITS) - 1 if (largest or 0) <= small else k + 1
        found = next_counts(rows, chosen.select("_g", "_p", "_lo", "_hi"), above, DIGITS[k])
        chosen = _chosen(found, ["_g", "_p"], F.col("_lo"), F.col("_hi"))
    number = from_order_key(F.col("_p"), kind)
    mids = chosen.groupBy("_g").agg(F.max(F.when(F.col("_lo").isNotNull(), number)).alias("_lo"),
                                    F.max(F.when(F.col("_hi").isNotNull(), number)).alias("_hi"))
    middle = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_lo") * 0.5 + F.col("_hi") * 0.5)
    out = groups.join(mids, "_g", "left")
    return out.select(*[F.col("_g")[c].alias(c) for c in keys], middle.alias(alias))
