"""End-to-end: archives -> lake -> model -> warehouse -> dashboards, on derived fixtures."""
import os

from pyspark.sql import functions as F

from claimlake import schemas as S
from claimlake.plans import catalogue_io as C
from claimlake.plans.jobs import dashboard_pack, ingest_all, model_job, profile_job, warehouse_job
from claimlake.plans.zip_fixture import write_zip_csv
from tests.conftest import SF_SMALL


def test_end_to_end(spark, tmp_dir):
    landing, lake = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    write_zip_csv(C._raw_beneficiary(spark, SF_SMALL), landing, C.ARCHIVE_STEMS["beneficiary_summary"], files=2)
    write_zip_csv(C._raw_claims(spark, SF_SMALL, S.INPATIENT), landing, C.ARCHIVE_STEMS["inpatient_claims"], files=2)
    write_zip_csv(C._raw_claims(spark, SF_SMALL, S.OUTPATIENT), landing, C.ARCHIVE_STEMS["outpatient_claims"], files=2)
    write_zip_csv(C._raw_drug_events(spark, SF_SMALL), landing, C.ARCHIVE_STEMS["prescription_drug_events"], files=2)
    log = os.path.join(tmp_dir, "runlog")

    got = ingest_all(spark, landing, lake, log)
    assert {t: v["rows"] for t, v in got.items()} == {
        "beneficiary_summary": 150, "inpatient_claims": 1500, "outpatient_claims": 1500,
        "prescription_drug_events": 6000}
    assert all(v["archives"] == 2 for v in got.values())

    preds = os.path.join(tmp_dir, "preds")
    summary = model_job(spark, lake, preds, log_path=log)
    assert 0 < summary["scored_rows"] < 150 and len(summary["coefficients"]) == 18

    counts = warehouse_job(spark, "claims_e2e", os.path.join(tmp_dir, "wh"), lake, preds)
    assert counts["beneficiary_summary"] == 150 and counts["annual_cost_predictions"] == summary["scored_rows"]

    scored = spark.table("claims_e2e.annual_cost_predictions")
    pack = dashboard_pack(scored)
    states = pack["median_cost_by_state"].collect()
    assert sum(1 for _ in states) == scored.select("STATE").distinct().count()
    cond = pack["sum_cost_by_condition"]
    total = scored.agg(F.sum("prediction")).first()[0]
    for row in cond.groupBy("condition").agg(F.sum("sum_prediction").alias("s")).collect():
        assert abs(row.s - total) < 1e-6 * max(1.0, abs(total))  # each pane partitions all rows
    assert spark.read.parquet(log).count() == 2


def test_profile_job(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ben_csv")
    C._raw_beneficiary(spark, SF_SMALL).write.option("header", True).csv(path)
    out = profile_job(spark, path)
    distinct = {r.column_name: r.n_distinct for r in out["distinct"].collect()}
    assert distinct["DESYNPUF_ID"] == 150 and distinct["BENE_SEX_IDENT_CD"] == 2
    assert out["group_mean"].where("column_name = 'BENE_SEX_IDENT_CD'").count() == 2


def test_command_line_dashboards(spark, tmp_dir):
    from claimlake.__main__ import main, parser
    args = parser().parse_args(["ingest", "--landing", "a", "--lake", "b"])
    assert (args.job, args.landing, args.lake, args.log) == ("ingest", "a", "b", None)
    preds = os.path.join(tmp_dir, "p")
    C.acp(spark, SF_SMALL).write.parquet(preds)
    out = os.path.join(tmp_dir, "dash")
    assert main(["dashboards", "--predictions", preds, "--out", out]) == 0
    assert spark.read.parquet(os.path.join(out, "median_cost_by_state")).count() > 0


def test_earlier_model_job_writes_indexed_csv(spark, tmp_dir):
    from claimlake.plans.jobs import model_job_v1
    landing, lake = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    write_zip_csv(C._raw_beneficiary(spark, SF_SMALL), landing, C.ARCHIVE_STEMS["beneficiary_summary"], files=1)
    write_zip_csv(C._raw_claims(spark, SF_SMALL, S.INPATIENT), landing, C.ARCHIVE_STEMS["inpatient_claims"], files=1)
    ingest_all(spark, landing, lake)
    out = os.path.join(tmp_dir, "v1.csv")
    summary = model_job_v1(spark, lake, out)
    df = spark.read.option("header", True).csv(out)
    assert df.columns[0] == "F1" and df.columns[-2:] == ["features", "prediction"]
    assert sorted(int(r.F1) for r in df.select("F1").collect()) == list(range(summary["rows"]))
    # the earlier model measured every age at 2008-01-01
    assert df.where("CAST(AGE_YRS AS DOUBLE) > 100").count() == 0


def test_suggest_shuffle_partitions(spark, tmp_dir):
    from claimlake.session import suggest_shuffle_partitions
    path = os.path.join(tmp_dir, "blob")
    os.makedirs(path)
    with open(os.path.join(path, "f.bin"), "wb") as f:
        f.write(b"x" * (3 * 1024 * 1024))
    assert suggest_shuffle_partitions(spark, [path]) == spark.sparkContext.defaultParallelism
    assert suggest_shuffle_partitions(spark, [path], target_mb=1, expansion=3.0) == max(
        spark.sparkContext.defaultParallelism, 9)


def test_route_landed_files(spark, tmp_dir):
    import zipfile

    from claimlake.plans.jobs import route_landed_files
    names = ["DE1_0_2008_to_2010_Inpatient_Claims_Sample_1.zip", "DE1_0_2009_Beneficiary_Summary_File_Sample_2.zip",
             "DE1_0_2008_to_2010_Prescription_Drug_Events_Sample_3.zip", "mystery_file.zip", "notes.csv"]
    for n in names:
        if n.endswith(".zip"):
            with zipfile.ZipFile(os.path.join(tmp_dir, n), "w") as zf:
                zf.writestr("a.csv", "A\n1\n")
        else:
            with open(os.path.join(tmp_dir, n), "w") as f:
                f.write("A\n1\n")
    got = {r.file_name: r.table for r in route_landed_files(spark, tmp_dir).collect()}
    assert got == {names[0]: "inpatient_claims", names[1]: "beneficiary_summary",
                   names[2]: "prescription_drug_events", names[3]: None, names[4]: None}
    cat = spark.createDataFrame([("mystery_file.zip", "outpatient"), (names[0], "beneficiary")],
                                "file_name string, table_kind string")
    got = {r.file_name: r.table for r in route_landed_files(spark, tmp_dir, cat).collect()}
    assert got["mystery_file.zip"] == "outpatient_claims" and got[names[0]] == "beneficiary_summary"


def test_generic_archive_is_routed_by_its_member_and_unrouted_files_are_reported(spark, tmp_dir):
    import zipfile
    landing, lake, log = (os.path.join(tmp_dir, x) for x in ("landing", "lake", "log"))
    os.makedirs(landing)
    cols = [n for n, _ in S.DRUG_EVENTS]
    with zipfile.ZipFile(os.path.join(landing, "download.ZIP"), "w") as zf:
        zf.writestr("DE1_0_2008_to_2010_Prescription_Drug_Events_Sample_1.csv", ",".join(cols) + "\nP1,1,20090101,1,30,30,0.5,1.0\n")
    with zipfile.ZipFile(os.path.join(landing, "other.zip"), "w") as zf:
        zf.writestr("readme.csv", "A\n1\n")
    got = ingest_all(spark, landing, lake, log)
    assert got["prescription_drug_events"]["rows"] == 1 and got["_unrouted"]["archives"] == 1
    assert spark.read.parquet(got["_unrouted"]["path"]).where("table is null").first().file_name == "other.zip"
    assert {r.job: r.files for r in spark.read.parquet(log).collect()} == {"ingest": 1, "ingest_unrouted": 1}
    again = ingest_all(spark, landing, lake)
    assert again["prescription_drug_events"]["rows"] == 1
    assert spark.read.parquet(got["prescription_drug_events"]["path"]).count() == 1
