"""Landed archives and run logs of growing tables: no task gets a fixed share of the rows."""
import glob
import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from claimlake.plans import catalogue_io as C
from claimlake.plans import ingest as I
from claimlake.plans import warehouse, zip_fixture
from claimlake.sources import archives as A


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(path):
    with zipfile.ZipFile(path) as zf:
        return zf.read(zf.namelist()[0]).decode("latin-1").splitlines()


@pytest.fixture
def drug_events(spark, tmp_dir):
    """A folder with 700 lineitem rows, some values null."""
    n = F.col("id")
    (spark.range(700).select(
        n.alias("l_orderkey"), (n % 50).alias("l_partkey"), (n % 7).alias("l_suppkey"),
        F.when(n % 11 != 0, n % 7 + 1).cast("int").alias("l_linenumber"), (n % 50).cast("double").alias("l_quantity"),
        (n * 1.5).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"), F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), F.when(n % 13 != 0, F.expr("timestamp_ntz'1992-01-01' + make_interval(0, 0, 0, int(id * 3)) ")).alias("l_shipdate"))
     .write.parquet(f"{tmp_dir}/lineitem.parquet"))
    return tmp_dir


def test_run_log_rows_are_written_without_a_shuffle(spark, drug_events, monkeypatch):
    plans, real = [], warehouse.logged_write
    monkeypatch.setattr(warehouse, "logged_write", lambda df, *a, **k: (plans.append(_plan(df)), real(df, *a, **k))[1])
    (row,) = C.q_run_log_rows(spark, drug_events).collect()
    assert (row.job, row.files, row.rows, row.dated) == ("drug_events", 2, 700, True)
    assert "Exchange" not in plans[0]


def test_archives_are_made_of_bounded_parts(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(zip_fixture, "PART_ROWS", 50)
    df = spark.range(1000).select(F.col("id"), F.concat(F.lit("é "), "id").alias("v")).repartition(3)
    assert zip_fixture.write_zip_csv(df, tmp_dir, "s", files=3) == 3
    parts = [len(gzip.open(p).readlines()) - 1 for p in glob.glob(f"{tmp_dir}/_csv/part-*")]
    assert sum(parts) == 1000 and max(parts) <= 50
    texts = [_lines(f"{tmp_dir}/s_{k}.zip") for k in (1, 2, 3)]
    assert all(t[0] == "id,v" and "id,v" not in t[1:] for t in texts)
    assert max(map(len, texts)) - min(map(len, texts)) <= 60
    assert sorted(x for t in texts for x in t[1:]) == sorted(f"{i},é {i}" for i in range(1000))


@pytest.mark.parametrize("rows, files, made", [(0, 3, 1), (2, 3, 2), (3, 3, 3), (17, 8, 8)])
def test_archives_of_few_rows(spark, tmp_dir, rows, files, made):
    df = spark.range(0, rows, 1, 2).select(F.col("id").cast("string"))
    assert zip_fixture.write_zip_csv(df, tmp_dir, "s", files=files) == made
    assert sorted(x for p in glob.glob(f"{tmp_dir}/s_*.zip") for x in _lines(p)[1:]) == sorted(map(str, range(rows)))


def test_file_counts_rows_gives_no_task_an_archive(spark, drug_events, monkeypatch):
    n, dealt, frame, paths = F.col("id"), [], type(spark.range(0)), {}
    (spark.range(500).select(n.alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"), (n % 25).cast("int").alias("c_nationkey"),
                             F.when(n % 9 != 0, n * 1.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"))
     .write.parquet(f"{drug_events}/customer.parquet"))
    repartition, scan, counts = frame.repartition, I.scan_zip_csv, I.file_counts
    monkeypatch.setattr(A, "CHUNK_BLOCKS", 1)
    monkeypatch.setattr(A, "TASK_BYTES", 2000)
    monkeypatch.setattr(frame, "repartition", lambda self, *a: (dealt.append(a), repartition(self, *a))[1])
    monkeypatch.setattr(I, "scan_zip_csv", lambda *a, **k: scan(*a, **k, block_bytes=1000))
    monkeypatch.setattr(I, "file_counts", lambda s, p: (paths.update(p), counts(s, p))[1])
    rows = C.q_ingest_file_counts_rows(spark, drug_events).collect()
    assert sorted(map(tuple, rows)) == [("beneficiary_summary", 3, True, 500), ("prescription_drug_events", 3, True, 700)]
    assert len(dealt) == 2 and all(a[1:] == ("_source_file", "_chunk") for a in dealt)  # the archives are made without a shuffle
    for path, total in zip(paths.values(), (500, 700), strict=True):
        task = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
        assert max(r["count"] for r in spark.read.parquet(path).groupBy(task).count().collect()) < total / 3


def test_more_archives_for_more_rows(spark, tmp_dir):
    df = spark.range(1000).select(F.col("id").cast("string"))
    assert zip_fixture.write_zip_csv(df, tmp_dir, "s", files=2, max_rows=100) == 10
    assert max(len(_lines(p)) for p in glob.glob(f"{tmp_dir}/s_*.zip")) <= 150


@pytest.mark.parametrize("query", [C.q_ingest_same_name, C.q_ingest_incremental_claims_source, C.q_ingest_reissued])
def test_landing_queries_cut_archives_by_rows(spark, drug_events, monkeypatch, query):
    made, real = [], zip_fixture.write_zip_csv
    monkeypatch.setattr(zip_fixture, "ARCHIVE_ROWS", 60)
    monkeypatch.setattr(zip_fixture, "write_zip_csv", lambda *a, **k: made.append(real(*a, **k)) or made[-1])
    rows = query(spark, drug_events)
    assert rows.count() == 700 and rows.where("PDE_ID < 0").isEmpty()
    assert max(made) > 3


def test_typed_rows_are_not_shuffled(spark, tmp_dir):
    df = spark.range(0, 400, 1, 4).select("id", F.lit("/a/x.zip").alias("_source_file"))
    I.write_archives(df, f"{tmp_dir}/out")
    (folder,) = glob.glob(f"{tmp_dir}/out/_archive=*")
    assert len(glob.glob(f"{folder}/part-*.parquet")) == 4  # one a task: written where they are
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 400


def test_ingest_shuffles_the_text_once_by_archive(spark, tmp_dir, monkeypatch):
    landing, shuffles, frame = f"{tmp_dir}/landing", [], type(spark.range(0))
    real = frame.repartition
    zip_fixture.write_zip_csv(C.raw_frame(spark.range(300).select(F.col("id").alias("PDE_ID")), I.S.DRUG_EVENTS), landing, "s", files=5)
    monkeypatch.setattr(frame, "repartition", lambda self, n, *a: (shuffles.append(self.columns), real(self, n, *a))[1])
    res = I.ingest(spark, landing, "prescription_drug_events", f"{tmp_dir}/lake")
    assert res.rows == 300 and len(shuffles) == 1 and "block" in shuffles[0]
    folders = glob.glob(f"{res.path}/_archive=*")
    assert [len(glob.glob(f"{f}/part-*.parquet")) for f in folders] == [1] * 5  # a small archive is one file


def test_a_large_archive_is_dealt_in_chunks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(A, "CHUNK_BLOCKS", 2)
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    zip_fixture.write_zip_csv(df, tmp_dir, "s", files=1)
    lines = A.archive_records(A.list_archives(spark, tmp_dir), ["id"], block_bytes=1000, by_file=True)
    assert "hashpartitioning(_source_file" in _plan(lines) and "_chunk" in _plan(lines)
    assert sorted(int(r.line) for r in lines.select("line").collect()) == list(range(5000))


def test_a_stream_is_spread_by_the_partitions_of_its_shuffles(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert A.spread(spark.range(100).toDF("x")).rdd.getNumPartitions() == max(37, spark.sparkContext.defaultParallelism)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_tasks_of_an_ingest_grow_with_the_text(spark):
    least = spark.sparkContext.defaultParallelism
    tasks = [A._tasks(spark.createDataFrame([("/a/x.zip", n << 20), ("/a/y.csv", 1 << 20)], "path string, length long")) for n in (1, 800, 8000)]
    assert tasks == [least, 101, 1001]
