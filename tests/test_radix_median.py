"""Medians by radix selection: values, order keys, and a plan that moves no rows."""
import decimal
import math
import random
import re
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.operators import radix


def _doubles():
    rng = random.Random(3)
    out = [0.0, -0.0, 5e-324, 2.2250738585072009e-308, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, 1.0, 0.1, 2.0 ** -1022, 2.0 ** -537]
    out += [2.0 ** e for e in range(-1074, 1024)] + [math.nextafter(2.0 ** e, d) for e in range(-1070, 1024) for d in (0.0, math.inf)]
    out += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(4000)]
    out = [x for x in out if x == x]
    return out + [-x for x in out]


def test_order_keys_are_the_bits_of_a_double(spark):
    values = _doubles()
    df = spark.createDataFrame([(v,) for v in values], "_v double").withColumn("_g", F.col("_v"))
    keys = radix.keyed(df, T.DoubleType())
    rows = keys.select(F.col("_g").alias("v"), F.col("_k").alias("k"), radix.from_order_key(F.col("_k"), T.DoubleType()).alias("back")).collect()
    for r in rows:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.k == (-bits if r.v < 0 else bits), r
        assert r.back == r.v
    ordered = sorted(rows, key=lambda r: r.v)
    assert all(a.k <= b.k for a, b in zip(ordered, ordered[1:], strict=False))


@pytest.mark.parametrize("small", [1, 50, 1 << 20])
def test_radix_median_equals_the_built_in(spark, small):
    rng = random.Random(small)
    rows = [(g, rng.choice([None, 0.0, -0.0, math.inf, -math.inf, 1e308, -1e308, 5e-324]) if rng.random() < 0.3 else rng.gauss(0, 10 ** rng.randint(-9, 9)))
            for g in [None, "a", "b", "c"] for _ in range(rng.randint(1, 400))] + [("hot", 7.25)] * 3000 + [("hot", rng.random()) for _ in range(2999)] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    def shown(m):  # zero has one sign
        return repr(m if m is None else m + 0.0)

    want = {r.k: shown(r.m) for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert {r.k: shown(r.m) for r in radix.radix_median(df, ["k"], "v", "m", small=small).collect()} == want


def test_radix_median_of_other_types(spark):
    rng = random.Random(8)
    rows = [(rng.randint(0, 2), rng.choice([2 ** 62, -2 ** 62, 2 ** 62 + 1, 0, 3]), rng.randint(-5, 5), decimal.Decimal(rng.randint(-10 ** 17, 10 ** 17)).scaleb(-4),
             float(rng.randint(0, 9)) / 3) for _ in range(301)]
    df = spark.createDataFrame(rows, "k int, l long, s int, d decimal(18,4), f float")
    for c in "lsdf":
        want = {r.k: r.m for r in df.groupBy("k").agg(F.median(F.col(c)).cast("double").alias("m")).collect()}
        got = {r.k: r.m for r in radix.radix_median(df, ["k"], c, "m", small=5).collect()}
        assert got == pytest.approx(want, rel=1e-12), c
    assert radix.radix_median(df.limit(0), ["k"], "l", "m").count() == 0
    wide = df.select("k", F.col("d").cast("decimal(30,4)").alias("w"))  # no 64-bit key: the bracketed plan
    assert radix.radix_median(wide, ["k"], "w", "m").count() == 3


def test_many_groups_fall_back_to_the_row_shuffle(spark):
    df = spark.range(400).selectExpr("id % 40 AS k", "cast(id AS double) AS v")
    want = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert {r.k: r.m for r in radix.radix_median(df, ["k"], "v", "m", max_groups=10).collect()} == want


def _inputs_of_exchanges(df):
    """The operator under each Exchange of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [re.sub(r"^[\s:+\-*()\d]*", "", x) for x in plan.splitlines()]
    return [lines[k + 1] for k, x in enumerate(lines) if x.startswith("Exchange")]


def test_no_exchange_carries_rows(spark, tmp_dir):
    spark.range(1000).selectExpr("id % 4 AS g", "cast(id AS double) AS v").write.parquet(tmp_dir + "/t")
    df = spark.read.parquet(tmp_dir + "/t")
    rows = radix.keyed(df.select(F.struct("g").alias("_g"), F.col("v").alias("_v")), T.DoubleType())
    chosen = spark.createDataFrame([], "_g struct<g:bigint>, _p long, _lo long, _hi long")
    for counted in (radix.first_counts(rows), radix.next_counts(rows, chosen, 48, 32)):
        below = _inputs_of_exchanges(counted)
        assert below and all(x.startswith("HashAggregate") for x in below), below


def test_most_values_are_read_twice_only(spark):
    df = spark.range(20_000).selectExpr("id % 2 AS g", "cast(id % 997 AS double) / 7 AS v")
    spark.sparkContext.setJobGroup("radix", "passes")
    radix.radix_median(df, ["g"], "v", "m").collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("radix")) < 30
