"""Cleaning expressions on the raw-file edge cases (FIXTURES section 9)."""
import datetime as dt

from pyspark.sql import functions as F

from claimlake.functions import clean
from claimlake.functions.dates import age_years, rounded_age_ceil, rounded_age_floor
from claimlake.functions.text import path_basename, path_restem, split_token, text_in_parens


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_parse_yyyymmdd(spark):
    got = one(spark, [("20080701",), ("",), (None,), ("2008XX01",), (" 20100131 ",)], "s string",
              clean.parse_yyyymmdd("s"))
    assert got == [dt.date(2008, 7, 1), None, None, None, dt.date(2010, 1, 31)]


def test_parse_from_integer(spark):
    assert one(spark, [(19230501,)], "s long", clean.parse_yyyymmdd("s")) == [dt.date(1923, 5, 1)]


def test_fill_null_date(spark):
    got = one(spark, [(None,), (dt.date(2009, 3, 1),)], "d date", clean.fill_null_date("d"))
    assert got == [dt.date(2008, 1, 1), dt.date(2009, 3, 1)]


def test_cast_smallint_quarantines_overflow(spark):
    got = one(spark, [("1",), ("70000",), ("-32768",), ("abc",), (None,)], "s string", clean.cast_smallint("s"))
    assert got == [1, None, -32768, None, None]


def test_fill_zero_short_truncates(spark):
    got = one(spark, [("30.9",), ("",), (None,), ("-2.5",), ("99999",)], "s string", clean.fill_zero_short("s"))
    assert got == [30, 0, 0, -2, None]


def test_normalise_npi(spark):
    got = one(spark, [("1234567890.0",), ("",), (None,), ("8.5000255E7",)], "s string", clean.normalise_npi("s"))
    assert got == ["1234567890", None, None, "85000255"]


def test_code_present(spark):
    got = one(spark, [("4280",), ("nan",), (None,), ("V5789",)], "s string", clean.code_present("s"))
    assert got == [True, False, False, True]


def test_count_present(spark):
    df = spark.createDataFrame([("4280",), ("nan",), (None,), ("V5789",)], "s string")
    assert df.agg(clean.count_present("s")).first()[0] == 2


def test_age_and_rounding(spark):
    df = spark.createDataFrame([(dt.date(1950, 1, 1), dt.date(2008, 6, 30))], "b date, d date")
    r = df.select(age_years("d", "b").alias("a")).select(
        "a", rounded_age_floor("a").alias("f"), rounded_age_ceil("a").alias("c")).first()
    days = (dt.date(2008, 6, 30) - dt.date(1950, 1, 1)).days
    assert r["a"] == days / 365.0
    assert (r["f"], r["c"]) == (int(days // 365), int(days // 365) + 1)


def test_age_matches_epoch_seconds_in_utc(spark):
    df = spark.createDataFrame([(dt.date(1931, 2, 28), dt.date(2010, 12, 31))], "b date, d date")
    r = df.select(age_years("d", "b").alias("a"),
                  ((F.unix_timestamp(F.col("d").cast("timestamp")) - F.unix_timestamp(F.col("b").cast("timestamp")))
                   / 60 / 60 / 24 / 365).alias("e")).first()
    assert r["a"] == r["e"]


def test_split_token_bounds(spark):
    rows = [("DE1.0 Sample 1 2008 Beneficiary Summary File",), ("Inpatient Claims",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(split_token("t", 4).alias("a"), split_token("t", -3).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("Beneficiary", "Beneficiary"), (None, None), (None, None)]


def test_text_in_parens(spark):
    got = one(spark, [(" (ZIP)",), (" (ZIP, 4MB)",), ("no parens",), ("(open",), (None,)], "s string",
              text_in_parens("s"))
    assert got == ["ZIP", "ZIP, 4MB", None, "open", None]


def test_paths(spark):
    df = spark.createDataFrame([("/files/a/DE1_0_2008_Sample_1.zip",)], "p string")
    r = df.select(path_basename("p").alias("b"), path_restem(path_basename("p"), ".parquet").alias("r")).first()
    assert (r.b, r.r) == ("DE1_0_2008_Sample_1.zip", "DE1_0_2008_Sample_1.parquet")
