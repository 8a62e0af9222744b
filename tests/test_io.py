"""Archives, CSV encodings, ingest quarantine, warehouse loads, streaming."""
import datetime as dt
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake import schemas as S
from claimlake.plans.ingest import ingest, quarantine, read_ingested
from claimlake.plans.warehouse import append, create_schema, full_refresh
from claimlake.sources.archives import CSV_GLOB, scan_zip_csv
from claimlake.sources.files import scan_csv
from claimlake.streaming.incremental import run_incremental

RAW2 = T.StructType([T.StructField("A", T.StringType()), T.StructField("B", T.StringType())])


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as zf:
        for name, text in members:
            zf.writestr(name, text.encode("iso-8859-1"))


def test_zip_first_member_only_and_header_only(spark, tmp_dir):
    _zip(os.path.join(tmp_dir, "one.zip"), [("one.csv", "A,B\n1,x\n2,\n")])
    _zip(os.path.join(tmp_dir, "two.zip"), [("first.csv", "B,A\ny,3\n"), ("second.csv", "A,B\n9,z\n")])
    _zip(os.path.join(tmp_dir, "empty.zip"), [("empty.csv", "A,B\n")])
    got = sorted((r.A, r.B, r._member) for r in scan_zip_csv(spark, tmp_dir, RAW2).collect())
    assert got == [("1", "x", "one.csv"), ("2", None, "one.csv"), ("3", "y", "first.csv")]


def test_zip_non_ascii_latin1(spark, tmp_dir):
    _zip(os.path.join(tmp_dir, "l.zip"), [("l.csv", "A,B\n1,Muñoz\n")])
    assert scan_zip_csv(spark, tmp_dir, RAW2).first().B == "Muñoz"


def test_corrupt_zip_fails_visibly(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "bad.zip"), "wb") as f:
        f.write(b"this is not a zip archive")
    with pytest.raises(Exception):
        scan_zip_csv(spark, tmp_dir, RAW2).collect()


def test_scan_csv_latin1_and_corrupt_rows(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.csv")
    with open(p, "wb") as f:
        f.write("id,name,day\n1,José,20080101\n2,Ann,2008XX01\n".encode("iso-8859-1"))
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("day", T.DateType())])
    rows = sorted(scan_csv(spark, p, schema, keep_corrupt=True).collect(), key=lambda r: r.id)
    assert rows[0].name == "José" and rows[0].day == dt.date(2008, 1, 1) and rows[0]._corrupt_record is None
    assert rows[1].day is None and rows[1]._corrupt_record is not None


def _raw_inpatient_zip(tmp_dir):
    cols = [n for n, _ in S.INPATIENT]
    vals = [
        {"DESYNPUF_ID": "A1", "CLM_ID": "10", "SEGMENT": "1", "CLM_FROM_DT": "", "AT_PHYSN_NPI": "1234567890.0",
         "CLM_UTLZTN_DAY_CNT": "", "ICD9_DGNS_CD_1": "4280", "ICD9_PRCDR_CD_1": "nan"},
        {"DESYNPUF_ID": "A1", "CLM_ID": "11", "SEGMENT": "70000", "CLM_FROM_DT": "2008XX01",
         "CLM_UTLZTN_DAY_CNT": "30.9", "ICD9_DGNS_CD_1": "V5789"},
    ]
    lines = [",".join(cols)] + [",".join(v.get(c, "") for c in cols) for v in vals]
    _zip(os.path.join(tmp_dir, "DE1_0_2008_to_2010_Inpatient_Claims_Sample_1.zip"),
         [("DE1_0_2008_to_2010_Inpatient_Claims_Sample_1.csv", "\n".join(lines) + "\n")])


def test_ingest_types_and_quarantines_without_dropping(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    _raw_inpatient_zip(src)
    res = ingest(spark, src, "inpatient_claims", os.path.join(tmp_dir, "lake"))
    assert (res.rows, res.rejected_rows) == (2, 1)
    rows = {r.CLM_ID: r for r in read_ingested(spark, res.path, "inpatient_claims").collect()}
    assert rows[10].CLM_FROM_DT is None and rows[10].AT_PHYSN_NPI == "1234567890"
    assert rows[10].CLM_UTLZTN_DAY_CNT == 0 and rows[10].ICD9_PRCDR_CD_1 == "nan"
    assert rows[11].SEGMENT is None and rows[11].CLM_UTLZTN_DAY_CNT == 30 and rows[11].AT_PHYSN_NPI is None
    q = quarantine(spark, res.path).collect()
    assert len(q) == 1 and sorted(q[0]._rejected) == ["CLM_FROM_DT", "SEGMENT"]


def test_full_refresh_replaces_and_append_matches_by_name(spark, tmp_dir):
    db = "claims_test_refresh"
    create_schema(spark, db, tmp_dir, ["prescription_drug_events"])
    t = f"{db}.prescription_drug_events"
    first = spark.createDataFrame([("a", 1, 5.0)], "DESYNPUF_ID string, PDE_ID long, TOT_RX_CST_AMT double")
    second = spark.createDataFrame([("b", 2, 6.0), ("c", 3, 7.0)], "DESYNPUF_ID string, PDE_ID long, TOT_RX_CST_AMT double")
    full_refresh(spark, t, first)
    full_refresh(spark, t, second)
    assert sorted(r.DESYNPUF_ID for r in spark.table(t).collect()) == ["b", "c"]
    full_refresh(spark, t, second)
    assert spark.table(t).count() == 2  # a repeated refresh equals the first
    reordered = spark.createDataFrame([(9.0, 4, "d")], "TOT_RX_CST_AMT double, PDE_ID long, DESYNPUF_ID string")
    append(spark, t, reordered)
    r = spark.table(t).where("PDE_ID = 4").first()
    assert (r.DESYNPUF_ID, r.TOT_RX_CST_AMT) == ("d", 9.0)


def test_incremental_equals_batch_and_reruns_add_nothing(spark, tmp_dir):
    schema = "id long, v string"
    landing, target, ck = (os.path.join(tmp_dir, x) for x in ("landing", "target", "ck"))
    spark.range(0, 100).select("id", F.col("id").cast("string").alias("v")).write.mode("append").parquet(landing)
    st = T._parse_datatype_string(schema)
    assert run_incremental(spark, landing, st, target, ck)["rows"] == 100
    assert run_incremental(spark, landing, st, target, ck)["rows"] == 0
    spark.range(100, 105).select("id", F.col("id").cast("string").alias("v")).write.mode("append").parquet(landing)
    assert run_incremental(spark, landing, st, target, ck)["rows"] == 5
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(105))


def test_incremental_archive_ingest(spark, tmp_dir):
    from claimlake.streaming.incremental import run_archive_ingest
    landing, target, ck = (os.path.join(tmp_dir, x) for x in ("landing", "target", "ck"))
    os.makedirs(landing)
    cols = [n for n, _ in S.DRUG_EVENTS]

    def drop(name, ids):
        lines = [",".join(cols)] + [f"P{i},{i},2009010{i % 9 + 1},{i},{i}.9,{i % 30},0.5,{i}.25" for i in ids]
        _zip(os.path.join(landing, f"{name}.zip"), [(f"{name}.csv", "\n".join(lines) + "\n")])

    drop("DE1_0_2008_to_2010_Prescription_Drug_Events_Sample_1", range(0, 50))
    run_archive_ingest(spark, landing, "prescription_drug_events", target, ck)
    run_archive_ingest(spark, landing, "prescription_drug_events", target, ck)  # nothing new
    drop("DE1_0_2008_to_2010_Prescription_Drug_Events_Sample_2", range(50, 80))
    run_archive_ingest(spark, landing, "prescription_drug_events", target, ck)
    rows = spark.read.schema(S.table_struct("prescription_drug_events")).parquet(target).collect()
    assert sorted(r.PDE_ID for r in rows) == list(range(80))
    r7 = next(r for r in rows if r.PDE_ID == 7)
    assert (r7.SRVC_DT, r7.QTY_DSPNSD_NUM, r7.TOT_RX_CST_AMT) == (dt.date(2009, 1, 8), 7, 7.25)


def test_old_versions_are_dropped_but_current_kept(spark, tmp_dir):
    from claimlake.plans.warehouse import drop_old_versions
    db = "claims_test_versions"
    create_schema(spark, db, tmp_dir, ["prescription_drug_events"])
    t = f"{db}.prescription_drug_events"
    for i in range(4):
        full_refresh(spark, t, spark.createDataFrame([(f"id{i}", i)], "DESYNPUF_ID string, PDE_ID long"))
    deleted = drop_old_versions(spark, t, keep_previous=1)
    assert len(deleted) >= 2  # two old loads (and the initial folder if it was created)
    base = os.path.join(tmp_dir, f"{db}.db", "prescription_drug_events")
    assert len([d for d in os.listdir(base) if d.startswith("v-")]) == 2  # current + one previous
    assert [r.DESYNPUF_ID for r in spark.table(t).collect()] == ["id3"]


def test_plain_csv_ingest_equals_archive_ingest(spark, tmp_dir):
    from claimlake.plans import catalogue_io as C
    from claimlake.plans.zip_fixture import write_zip_csv
    from tests.conftest import SF_SMALL
    raw = C._raw_drug_events(spark, SF_SMALL)
    csv_dir, zip_dir = os.path.join(tmp_dir, "csv"), os.path.join(tmp_dir, "zip")
    raw.write.option("header", True).option("encoding", "ISO-8859-1").option("dateFormat", "yyyyMMdd").csv(csv_dir)
    write_zip_csv(raw, zip_dir, "DE1_0_Prescription_Drug_Events_Sample", files=2)
    a = ingest(spark, csv_dir, "prescription_drug_events", os.path.join(tmp_dir, "lake_csv"), glob=CSV_GLOB)
    b = ingest(spark, zip_dir, "prescription_drug_events", os.path.join(tmp_dir, "lake_zip"))
    assert a.rows == b.rows == 6000
    ra = read_ingested(spark, a.path, "prescription_drug_events")
    rb = read_ingested(spark, b.path, "prescription_drug_events")
    assert ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0


def test_plain_csv_header_mismatch_fails(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad.csv")
    with open(p, "w") as f:
        f.write("WRONG,PDE_ID\nx,1\n")
    with pytest.raises(Exception):
        ingest(spark, tmp_dir, "prescription_drug_events", os.path.join(tmp_dir, "lake"), glob=CSV_GLOB)


def test_stray_quote_costs_its_own_record(spark, tmp_dir):
    text = 'A,B\n1,x\n2,"y\n3,z\n4,w\n5,"q, r"\n6,"say ""hi"""\n'
    _zip(os.path.join(tmp_dir, "q.ZIP"), [("q.csv", text)])
    rows = {r.A: r for r in scan_zip_csv(spark, tmp_dir, RAW2).collect()}
    assert len(rows) == 6 and [k for k, r in rows.items() if r._corrupt_record is not None] == ["2"]
    assert (rows["1"].B, rows["3"].B, rows["5"].B, rows["6"].B) == ("x", "z", "q, r", 'say "hi"')


def test_headers_in_any_case_and_order_and_wrong_lengths(spark, tmp_dir):
    _zip(os.path.join(tmp_dir, "a.zip"), [("a.csv", "a,b\r\n1,x\r\n2\r\n3,y,z,w\r\n")])
    _zip(os.path.join(tmp_dir, "b.zip"), [("b.csv", "\u00ef\u00bb\u00bfB,Extra,A\nx,0,4\ny,5\n\nz,0,6,7\n\"v,0\",8,9\n")])
    rows = scan_zip_csv(spark, tmp_dir, RAW2).collect()
    good = sorted((r.A, r.B) for r in rows if r._corrupt_record is None)
    assert good == [("1", "x"), ("4", "x"), ("9", "v,0")] and len(rows) == 7
    _zip(os.path.join(tmp_dir, "c.zip"), [("c.csv", "A,C\n1,x\n")])
    with pytest.raises(Exception, match="columns missing"):
        scan_zip_csv(spark, tmp_dir, RAW2).collect()


@pytest.mark.parametrize("block,span", [(1 << 20, 128 << 20), (7, 11), (5, 3), (64, 1)])
def test_plain_files_in_byte_ranges(spark, tmp_dir, block, span):
    lines = [f"{i},{'v' * (i % 13)}" for i in range(60)]
    with open(os.path.join(tmp_dir, "p.csv"), "w") as f:
        f.write("A,B\n" + "\n".join(lines))  # no line end at the end of the file
    with open(os.path.join(tmp_dir, "none.csv"), "w"):
        pass
    got = scan_zip_csv(spark, tmp_dir, RAW2, glob=CSV_GLOB, block_bytes=block, range_bytes=span).collect()
    assert sorted((r.A, r.B or "") for r in got) == sorted(tuple(x.split(",")) for x in lines)


def test_rerun_and_retry_replace_an_archive(spark, tmp_dir):
    landing, lake = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    os.makedirs(landing)
    cols = [n for n, _ in S.DRUG_EVENTS]

    def drop(name, ids, cost):
        lines = [",".join(cols)] + [f"P{i},{i},20090101,{i},70000,{i % 30},0.5,{cost}" for i in ids]
        _zip(os.path.join(landing, f"{name}.ZIP"), [(f"{name}.csv", "\n".join(lines) + "\n")])

    drop("a", range(0, 6), 1.0)
    drop("b", range(6, 9), 1.0)
    res = ingest(spark, landing, "prescription_drug_events", lake)
    assert (res.rows, res.rejected_rows) == (9, 0)
    drop("a", range(0, 4), 2.0)
    os.remove(os.path.join(landing, "b.ZIP"))
    ingest(spark, landing, "prescription_drug_events", lake)
    ingest(spark, landing, "prescription_drug_events", lake)
    rows = read_ingested(spark, res.path, "prescription_drug_events").collect()
    assert sorted((r.PDE_ID, r.TOT_RX_CST_AMT) for r in rows) == [(i, 2.0) for i in range(4)] + [(i, 1.0) for i in (6, 7, 8)]
    assert {r.QTY_DSPNSD_NUM for r in rows} == {70000}  # kept at the width of the column


def test_broken_lines_are_counted(spark, tmp_dir):
    cols = [n for n, _ in S.DRUG_EVENTS]
    lines = [",".join(cols).lower(), "P1,1,20090101,1,30,30,0.5,1.0", 'P2,2,"20090101,1,30,30,0.5,1.0', "P3,3,20090101", "P4,4,20090101,1,NA,nan,0.5,1e400,9,9"]
    _zip(os.path.join(tmp_dir, "x.zip"), [("x.csv", "\n".join(lines) + "\n")])
    res = ingest(spark, tmp_dir, "prescription_drug_events", os.path.join(tmp_dir, "lake"))
    assert (res.rows, res.rejected_rows) == (4, 3)
    assert all("_corrupt_record" in r._rejected for r in quarantine(spark, res.path).collect())


def test_stream_counts_every_batch_and_refuses_foreign_targets(spark, tmp_dir):
    landing, target, ck = (os.path.join(tmp_dir, x) for x in ("landing", "target", "ck"))
    spark.range(230).repartition(115).write.option("maxRecordsPerFile", 2).parquet(landing)
    files = len([f for f in os.listdir(landing) if f.endswith(".parquet")])
    got = run_incremental(spark, landing, T._parse_datatype_string("id long"), target, ck, max_files_per_trigger=1)
    assert got == {"batches": files, "rows": 230} and files > 100
    spark.range(10).write.parquet(os.path.join(tmp_dir, "batch"))
    with pytest.raises(ValueError, match="no stream wrote"):
        run_incremental(spark, landing, T._parse_datatype_string("id long"), os.path.join(tmp_dir, "batch"), ck + "2")


def test_row_index_beyond_32_bits_survives_the_csv(spark, tmp_dir):
    from claimlake.sources.files import scan_csv_typed
    assert dict(S.PREDICTIONS_CSV)["F1"] == "long"
    path = os.path.join(tmp_dir, "i")
    spark.range(3_000_000_000, 3_000_000_002).withColumnRenamed("id", "F1").write.option("header", True).csv(path)
    assert sorted(r.F1 for r in scan_csv_typed(spark, path, T._parse_datatype_string("F1 long")).collect()) == [3_000_000_000, 3_000_000_001]
