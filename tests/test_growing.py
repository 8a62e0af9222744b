"""Snapshots, stored sketches and refits: what a growing lake need not read again."""
import os
import shutil

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from claimlake.operators import sketches
from claimlake.plans import refit as R
from claimlake.plans.catalogue import features
from claimlake.plans.snapshots import bucketed_snapshot, join_snapshots
from tests.conftest import SF_ORACLE


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def db(spark, tmp_dir):
    spark.sql(f"CREATE DATABASE snap LOCATION '{tmp_dir}/snap.db'")
    yield "snap"
    spark.sql("DROP DATABASE snap CASCADE")


# snapshots ----------------------------------------------------------------------------

def test_snapshots_join_without_an_exchange(spark, tmp_dir, db):
    left = bucketed_snapshot(spark.range(3000).selectExpr("cast(id AS string) AS k", "id * 2 AS v"), f"{db}.l", tmp_dir, "k", 6)
    right = bucketed_snapshot(spark.range(9000).selectExpr("cast(id % 3000 AS string) AS j", "id AS w"), f"{db}.r", tmp_dir, "j", 6)
    joined = join_snapshots(left, right, "k", "j")
    assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
    assert joined.count() == 9000 and joined.where("v <> 2 * cast(k AS bigint)").count() == 0


def test_a_look_up_opens_one_bucket_and_skips_row_groups(spark, tmp_dir, db):
    rows = spark.range(200_000).selectExpr("id AS k", "sha2(cast(id AS string), 256) AS code", "id % 97 AS x")
    t = bucketed_snapshot(rows, f"{db}.t", tmp_dir, "k", 4, ["code"], {"code": 10_000}, row_group_bytes=1 << 20)
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{tmp_dir}/t") for f in names if f.endswith(".parquet")]
    assert len(files) == 4  # a task a bucket
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert sum(m.num_row_groups for m in groups) > 8
    for m in groups:
        bounds = [(m.row_group(g).column(0).statistics.min, m.row_group(g).column(0).statistics.max) for g in range(m.num_row_groups)]
        assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:], strict=False))  # sorted: a key is in one row group
    code = rows.where("k = 777").first().code

    def scanned(df):
        """Rows that leave the scan, by its metric."""
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        return leaves.apply(0).metrics().apply("numOutputRows").value()

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned(t.where(F.col("code") == code)) < 60_000  # by the Bloom filters: sha2 values have no order
        assert scanned(t.where(F.col("code") == "no such code")) < 20_000
        assert scanned(t.where("k = 12345")) < 50_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r.x for r in t.where(F.col("code") == code).collect()] == [777 % 97]
    stats = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {db}.t k").collect()}
    assert stats["min"] == "0" and stats["max"] == "199999"


def test_a_snapshot_is_replaced(spark, tmp_dir, db):
    bucketed_snapshot(spark.range(10), f"{db}.s", tmp_dir, "id", 2)
    again = bucketed_snapshot(spark.range(5), f"{db}.s", tmp_dir, "id", 3)
    assert sorted(r.id for r in again.collect()) == list(range(5))


# sketches -----------------------------------------------------------------------------

def test_united_sketches_equal_one_pass_and_read_no_old_rows(spark, tmp_dir):
    df = spark.range(60_000).selectExpr("id", "id % 7 AS few", "if(id % 5 = 0, null, id % 30000) AS some", "cast(id / 3 AS string) AS t")
    path, first = f"{tmp_dir}/sk", f"{tmp_dir}/first"
    df.where("id < 25000").write.parquet(first)
    sketches.store(sketches.column_sketches(spark.read.parquet(first)).withColumn("load", F.lit("1")), path)
    shutil.rmtree(first)  # the second load does without the first one's rows
    for _ in range(2):  # a load stored twice counts once
        sketches.store(sketches.column_sketches(df.where("id >= 25000")).withColumn("load", F.lit("2")), path)
    got = {r.column: (r.approx_distinct, r.rows, r.nulls) for r in sketches.distinct_counts(spark, path).collect()}
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    for c, n in exact.items():
        assert abs(got[c][0] - n) <= 4 * sketches.standard_error() * n + 1, c
    assert got["few"][0] == 7 and {v[1] for v in got.values()} == {60_000} and got["some"][2] == 12_000


def test_sketches_by_landed_file_follow_a_new_issue(spark, tmp_dir):
    from claimlake.plans.ingest import ingest
    from claimlake.sources.archives import list_archives
    from tests.test_landed import TABLE, _drop
    landing, lake, path = f"{tmp_dir}/landing", f"{tmp_dir}/lake", f"{tmp_dir}/sketches"

    def load(files):
        res = ingest(spark, files, TABLE, lake)
        sketches.store_archive_sketches(spark, res.path, path, list_archives(spark, files), ["PDE_ID", "TOT_RX_CST_AMT"])
        return {r.column: r.approx_distinct for r in sketches.distinct_counts(spark, path).collect()}

    a, b = _drop(landing, "a", range(100)), _drop(landing, "b", range(50, 250))
    assert load([a]) == {"PDE_ID": 100, "TOT_RX_CST_AMT": 1}
    assert load([b]) == {"PDE_ID": 250, "TOT_RX_CST_AMT": 1}
    _drop(landing, "a", range(10), 2.0)
    assert load([a]) == {"PDE_ID": 210, "TOT_RX_CST_AMT": 2}


# refits -------------------------------------------------------------------------------

def test_three_loads_equal_the_full_fit(spark, tmp_dir):
    from claimlake.plans.model import run
    base = f"{tmp_dir}/f"
    features(spark, SF_ORACLE).write.parquet(base)
    f = spark.read.parquet(base)
    part = F.pmod(F.xxhash64("PATIENT_ID"), F.lit(3))
    for k in (0, 1, 2, 1):  # one load twice
        R.add_load(f.where(part == k), f"{tmp_dir}/sums", f"l{k}")
    R.add_load(f, f"{tmp_dir}/all", "all")
    got, whole = R.refit(spark, f"{tmp_dir}/sums"), R.refit(spark, f"{tmp_dir}/all")
    scale = np.abs(whole.coefficients).max()
    assert np.abs(got.coefficients - whole.coefficients).max() <= 1e-9 * scale and got.labels == whole.labels
    assert got.rows == whole.rows and got.intercept == pytest.approx(whole.intercept, rel=1e-9)
    m = run(f)
    assert got.rows["train"] == m.train.count()
    assert np.allclose(got.coefficients, m.model.coefficients.toArray(), rtol=1e-6, atol=1e-6 * scale)
    assert got.intercept == pytest.approx(m.model.intercept, rel=1e-6)
    assert got.r2["train"] == pytest.approx(m.r2("train"), abs=1e-9) and got.r2["test"] == pytest.approx(m.r2("test"), abs=1e-6)


def test_a_load_that_reorders_the_labels(spark, tmp_dir):
    """The number of a label is its rank over all loads, with missing labels last."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(900):
        load = 0 if k < 300 else 1
        label = None if k % 23 == 0 else str(rng.choice(["x", "y", "z"], p=[0.7, 0.2, 0.1] if load == 0 else [0.1, 0.2, 0.7]))
        rows.append((str(k), float(rng.integers(20, 90)), label, float(rng.normal()), None if k % 41 == 0 else float(rng.normal(100, 9)), load))
    df = spark.createDataFrame(rows, "PATIENT_ID string, AGE_YRS double, G string, N double, ANNUAL_COST double, load int")
    how = {"categoricals": ["G"], "feature_cols": ["AGE_YRS", "G_index", "N"]}
    for k in (0, 1):
        R.add_load(df.where(F.col("load") == k), f"{tmp_dir}/s", str(k), **how)
    got = R.refit(spark, f"{tmp_dir}/s", **how)
    from claimlake.plans.model import run
    m = run(df.drop("load"), categoricals=["G"], feature_cols=["AGE_YRS", "G_index", "N"])
    assert np.allclose(got.coefficients, m.model.coefficients.toArray(), rtol=1e-8, atol=1e-8) and len(got.labels["G"]) == 3
    assert got.r2["test"] == pytest.approx(m.r2("test"), abs=1e-9)


def test_a_constant_input_gets_no_weight(spark, tmp_dir):
    df = spark.range(200).selectExpr("cast(id AS string) AS PATIENT_ID", "cast(id % 50 AS double) AS AGE_YRS", "7.0D AS K", "cast(3 * (id % 50) + 1 AS double) AS ANNUAL_COST")
    R.add_load(df, f"{tmp_dir}/s", "0", categoricals=[], feature_cols=["AGE_YRS", "K"])
    got = R.refit(spark, f"{tmp_dir}/s", [], ["AGE_YRS", "K"])
    assert np.allclose(got.coefficients, [3.0, 0.0]) and got.intercept == pytest.approx(1.0) and got.r2["train"] == pytest.approx(1.0)


# joins on heavy keys --------------------------------------------------------------------

def test_a_key_with_a_third_of_both_sides_is_spread(spark):
    from claimlake.operators.joins import heavy_keys, natural_join, natural_join_split
    left = spark.range(3000).selectExpr("if(id % 3 = 0, -1, id) AS k", "if(id % 3 = 0, null, id % 5) AS j", "id AS a")
    right = spark.range(2400).selectExpr("if(id % 3 = 0, -1, id) AS k", "if(id % 3 = 0, null, id % 5) AS j", "id AS b")
    assert list(heavy_keys(left, ["k", "j"], 500).values()) == [1000]
    plain, split = natural_join(left, right), natural_join_split(left, right, block_rows=100)
    assert split.columns == plain.columns and split.count() == plain.count() > 800_000
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        def largest(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        assert largest(plain) >= 800_000 and largest(split) < 200_000
    finally:
        for k, v in (("adaptive.enabled", "true"), ("autoBroadcastJoinThreshold", str(10 << 20)), ("shuffle.partitions", "8")):
            spark.conf.set(f"spark.sql.{k}", v)
    assert natural_join_split(left, right, block_rows=10_000).count() == plain.count()
    with pytest.raises(ValueError):
        natural_join_split(left, right.withColumnRenamed("k", "x").drop("j"))
