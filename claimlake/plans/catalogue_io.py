"""Named queries for sources, sinks, warehouse loads, ingest and streaming.

Every query derives its input files from the driver tables with Spark
(written under the session's shared checkpoint folder), runs the operator,
and returns what a reader would see afterwards.  Registered into the same
``QUERIES`` / ``ORACLES`` maps as ``catalogue``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake import schemas as S
from claimlake.plans import standins as si
from claimlake.plans.catalogue import ORACLES, SCORED_SQL, acp, register, scored_keys
from claimlake.session import scratch_path

V = si.with_views
_DUCK = {"string": "VARCHAR", "date": "DATE", "short": "SMALLINT", "int": "INTEGER",
         "long": "BIGINT", "double": "DOUBLE"}


def ddl_sql(layout, exprs: dict, source: str) -> str:
    """SELECT of every column of ``layout``: given expression or a typed NULL."""
    cols = [f"CAST({exprs[n]} AS {_DUCK[t]}) AS {n}" if n in exprs else f"CAST(NULL AS {_DUCK[t]}) AS {n}"
            for n, t in layout]
    return f"SELECT {', '.join(cols)} FROM {source}"


def raw_frame(df: DataFrame, layout) -> DataFrame:
    """All columns of ``layout`` in order; columns ``df`` lacks are blank (null)."""
    have = set(df.columns)
    return df.select(*[F.col(n) if n in have else F.lit(None).cast("string").alias(n) for n, _ in layout])


# ------------------------------------------------------------------ scans
@register("scan_csv", "SELECT * FROM customer")
def q_scan_csv(spark, sf):
    from claimlake.sources.files import RAW_ENCODING, scan_csv
    c = si.read_table(spark, sf, "customer")
    path = scratch_path(spark, "scan_csv")
    c.write.option("header", True).option("encoding", RAW_ENCODING).csv(path)
    return scan_csv(spark, path, c.schema)


@register("scan_csv_untyped", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
  FROM customer""")
def q_scan_csv_untyped(spark, sf):
    from claimlake.sources.files import scan_csv_untyped
    path = scratch_path(spark, "scan_csv_untyped")
    si.read_table(spark, sf, "customer").write.option("header", True).csv(path)
    return scan_csv_untyped(spark, path)


@register("scan_csv_typed", "SELECT * FROM orders")
def q_scan_csv_typed(spark, sf):
    from claimlake.sources.files import scan_csv_typed
    o = si.read_table(spark, sf, "orders")
    path = scratch_path(spark, "scan_csv_typed")
    o.write.option("header", True).csv(path)
    return scan_csv_typed(spark, path, o.schema)


@register("scan_zip_csv", "SELECT * FROM customer")
def q_scan_zip_csv(spark, sf):
    """SC3: customer rows zipped as several single-member archives, scanned back and typed."""
    from pyspark.sql import types as T

    from claimlake.functions.clean import try_cast
    from claimlake.plans.zip_fixture import write_zip_csv
    from claimlake.sources.archives import scan_zip_csv
    c = si.read_table(spark, sf, "customer")
    root = scratch_path(spark, "scan_zip_csv")
    write_zip_csv(c, root, "customer", files=spark.sparkContext.defaultParallelism)
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in c.schema.fields])
    raw = scan_zip_csv(spark, root, raw_schema)
    return raw.select(*[try_cast(f.name, f.dataType.simpleString()).alias(f.name) for f in c.schema.fields])


@register("scan_zip_csv_source", "SELECT * FROM customer")
def q_scan_zip_csv_source(spark, sf):
    """SC3 through the data source ``claim_records``."""
    from claimlake.functions.clean import try_cast
    from claimlake.plans.zip_fixture import write_zip_csv
    from claimlake.sources.landed import read_records
    c = si.read_table(spark, sf, "customer")
    root = scratch_path(spark, "scan_zip_csv_source")
    write_zip_csv(c, root, "customer", files=spark.sparkContext.defaultParallelism)
    raw = read_records(spark, root, c.columns)
    return raw.select(*[try_cast(f.name, f.dataType.simpleString()).alias(f.name) for f in c.schema.fields])


#: Customers with line feeds, quotes and commas inside two values.
QUOTED_SQL = """SELECT c_custkey, c_name || chr(10) || 'and "co", ' || c_custkey AS c_name, c_nationkey, c_acctbal,
  CASE WHEN c_custkey % 3 = 0 THEN '"' || chr(10) || c_mktsegment || chr(10) || chr(10) || ',' ELSE c_mktsegment END AS c_mktsegment FROM customer"""


def _quoted_customers(spark, sf):
    c = si.read_table(spark, sf, "customer")
    return c.select("c_custkey", F.concat("c_name", F.lit('\nand "co", '), F.col("c_custkey").cast("string")).alias("c_name"), "c_nationkey", "c_acctbal",
                    F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('"\n'), "c_mktsegment", F.lit("\n\n,"))).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


@register("scan_csv_multiline", QUOTED_SQL)
def q_scan_csv_multiline(spark, sf):
    """SC1: quoted line feeds, in files read by ranges of a few kilobytes."""
    from claimlake.sources.files import RAW_ENCODING, scan_csv
    c = _quoted_customers(spark, sf)
    path = scratch_path(spark, "scan_csv_multiline")
    c.write.option("header", True).option("encoding", RAW_ENCODING).option("escape", '"').csv(path)
    return scan_csv(spark, path, c.schema, multiline=True, range_bytes=7_001, block_bytes=997)


@register("scan_zip_csv_multiline", QUOTED_SQL)
def q_scan_zip_csv_multiline(spark, sf):
    """SC3: quoted line feeds inside archives."""
    from claimlake.functions.clean import try_cast
    from claimlake.plans.zip_fixture import write_zip_csv
    from claimlake.sources.archives import scan_zip_csv
    c = _quoted_customers(spark, sf)
    root = scratch_path(spark, "scan_zip_csv_multiline")
    write_zip_csv(c, root, "customer", files=3, escape='"')
    raw = scan_zip_csv(spark, root, S.raw_struct([(f.name, "string") for f in c.schema.fields]), multiline=True)
    return raw.select(*[try_cast(f.name, f.dataType.simpleString()).alias(f.name) for f in c.schema.fields])


@register("scan_parquet", "SELECT * FROM orders")
def q_scan_parquet(spark, sf):
    from claimlake.sources.files import scan_parquet
    return scan_parquet(spark, f"{sf}/orders.parquet")


@register("scan_parquet_multi", "SELECT * FROM orders")
def q_scan_parquet_multi(spark, sf):
    """SC4: a dataset written as many part files, listed, then read as one."""
    from claimlake.sources.files import scan_parquet_multi, source_file_inventory
    o = si.read_table(spark, sf, "orders")
    root = scratch_path(spark, "scan_parquet_multi")
    o.repartition(6).write.option("maxRecordsPerFile", 1000).parquet(root)
    # the listing is file metadata (bounded by the file count), not data
    paths = [r["path"] for r in source_file_inventory(spark, root, "*.parquet").select("path").collect()]
    return scan_parquet_multi(spark, paths, o.schema)


@register("source_file_inventory")
def q_source_file_inventory(spark, sf):
    from claimlake.sources.files import source_file_inventory
    return source_file_inventory(spark, sf, "*.parquet")


@register("source_file_rows", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS listed FROM {t}" for t in ("region", "nation", "customer", "orders", "lineitem", "events")))
def q_source_file_rows(spark, sf):
    """SC6: the listed files of each table with the rows that they hold."""
    from claimlake.sources.files import source_file_inventory
    listed = source_file_inventory(spark, sf, "*.parquet").select(F.col("path"), F.col("length"))
    out = None
    for t in ("region", "nation", "customer", "orders", "lineitem", "events"):
        rows = (spark.read.parquet(f"{sf}/{t}.parquet").groupBy(F.col("_metadata.file_path").alias("path"))
                .agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(t)))
        out = rows if out is None else out.unionByName(rows)
    name = F.substring_index("path", "/", -1)
    listed = listed.groupBy(name.alias("file")).agg(F.max("length").alias("length"))
    joined = out.withColumn("file", name).join(listed, "file", "left")
    return joined.groupBy("table_name").agg(F.sum("n").alias("n_rows"), F.min(F.col("length") > 0).alias("listed"))


@register("snapshot_extract", V("SELECT * FROM acp", "acp"))
def q_snapshot_extract(spark, sf):
    from claimlake.plans.warehouse import snapshot
    return snapshot(acp(spark, sf), scratch_path(spark, "snapshot"))


@register("snapshot_join", ORACLES["join_beneficiary_claims"])
def q_snapshot_join(spark, sf):
    """SC9, JO1: beneficiaries and claims as bucketed snapshots, joined bucket by bucket."""
    from claimlake.plans.snapshots import bucketed_snapshot, join_snapshots
    root = scratch_path(spark, "snapshots")
    db = f"snapshots_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}.db'")
    ben = si.ben(spark, sf).select(F.col("DESYNPUF_ID").alias("PATIENT_ID"), F.col("BENRES_IP").alias("ANNUAL_COST"))
    inp = si.inp(spark, sf).select("DESYNPUF_ID", "CLM_ID", "CLM_PMT_AMT")
    left = bucketed_snapshot(ben, f"{db}.ben", root, "PATIENT_ID", 8)
    right = bucketed_snapshot(inp, f"{db}.inp", root, "DESYNPUF_ID", 8, ["CLM_ID"])
    return join_snapshots(left, right, "PATIENT_ID", "DESYNPUF_ID")


# ------------------------------------------------------------------ sinks
PDE_TABLE_SQL = V(ddl_sql(S.DRUG_EVENTS, {n: n for n, _ in S.DRUG_EVENTS}, "pde"), "pde")


@register("sink_parquet_chunked", V("SELECT * FROM pde", "pde"))
def q_sink_parquet_chunked(spark, sf):
    from claimlake.plans.ingest import write_chunked_parquet
    path = scratch_path(spark, "chunked")
    write_chunked_parquet(si.pde(spark, sf), path, 1_000)
    return spark.read.parquet(path)


@register("sink_parquet_chunked_limit", V("SELECT count(*) AS n_rows, true AS within_limit, true AS limit_reached FROM pde", "pde"))
def q_sink_parquet_chunked_limit(spark, sf):
    """SK1: no file holds more rows than the limit, and the limit is reached."""
    from claimlake.plans.ingest import write_chunked_parquet
    path = scratch_path(spark, "chunked")
    write_chunked_parquet(si.pde(spark, sf), path, 1_000)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count()
    return files.agg(F.sum("count").alias("n_rows"), (F.max("count") <= 1_000).alias("within_limit"), (F.max("count") == 1_000).alias("limit_reached"))


@register("sink_predictions")
def q_sink_predictions(spark, sf):
    from claimlake.plans.catalogue import features
    from claimlake.plans.model import annual_cost_predictions
    from claimlake.plans.warehouse import write_predictions
    path = scratch_path(spark, "predictions")
    write_predictions(annual_cost_predictions(features(spark, sf)), path)
    return spark.read.parquet(path)


@register("sink_predictions_rows", SCORED_SQL)
def q_sink_predictions_rows(spark, sf):
    """SK2: the scored table as read back from its Parquet files."""
    return scored_keys(q_sink_predictions(spark, sf))


CSV_INDEXED_EXPRS = {n: n for n, _ in S.PREDICTIONS_CSV if n not in (
    "F1", "GENDER_index", "RACE_index", "STATE_index", "features")}
CSV_INDEXED_EXPRS["F1"] = "row_number() OVER (ORDER BY prediction DESC, PATIENT_ID) - 1"


@register("sink_csv_indexed", V(ddl_sql(S.PREDICTIONS_CSV, CSV_INDEXED_EXPRS, "acp"), "acp"))
def q_sink_csv_indexed(spark, sf):
    """SK3 + SC8: scored rows as CSV with a leading row index, read back typed."""
    from claimlake.plans.warehouse import write_csv_indexed
    from claimlake.sources.files import scan_csv_typed
    path = scratch_path(spark, "csv_indexed")
    body = raw_frame(acp(spark, sf), [c for c in S.PREDICTIONS_CSV if c[0] != "F1"])
    write_csv_indexed(body, path, [F.col("prediction").desc(), F.col("PATIENT_ID")], "F1")
    return scan_csv_typed(spark, path, S.struct(S.PREDICTIONS_CSV))


# -------------------------------------------------------------- warehouse
def _warehouse_sources(spark, sf) -> dict:
    return {
        "beneficiary_summary": si.ben(spark, sf),
        "inpatient_claims": si.inp(spark, sf),
        "outpatient_claims": si.inp(spark, sf),
        "prescription_drug_events": si.pde(spark, sf),
        "annual_cost_predictions": acp(spark, sf),
    }


def _db(spark, tables):
    from claimlake.plans.warehouse import create_schema
    db = f"claims_{uuid.uuid4().hex[:8]}"
    create_schema(spark, db, scratch_path(spark, "warehouse"), tables)
    return db


_SPARK_TYPE_NAMES = {"string": "string", "date": "date", "short": "smallint", "int": "int",
                     "long": "bigint", "double": "double"}
_TABLE_SOURCES_SQL = {"beneficiary_summary": "ben", "inpatient_claims": "inp", "outpatient_claims": "inp",
                      "prescription_drug_events": "pde", "annual_cost_predictions": "acp"}


def _table_ddl_sql() -> str:
    parts = []
    for t, layout in S.TABLES.items():
        for name, kind in layout:
            parts.append(f"SELECT '{t}' AS table_name, '{name}' AS col_name, '{_SPARK_TYPE_NAMES[kind]}' AS data_type, "
                         f"(SELECT count(*) FROM {_TABLE_SOURCES_SQL[t]}) AS table_rows")
    return V(" UNION ALL ".join(parts), "ben", "inp", "pde", "acp")


@register("table_ddl", _table_ddl_sql())
def q_table_ddl(spark, sf):
    """SK6: the five tables as created from the DDL, each filled once; columns with row counts."""
    from claimlake.plans.warehouse import full_refresh
    db = _db(spark, None)
    out = None
    for t, df in _warehouse_sources(spark, sf).items():
        full_refresh(spark, f"{db}.{t}", df, t)
        rows = spark.table(f"{db}.{t}").count()
        d = spark.sql(f"DESCRIBE TABLE {db}.{t}").select(
            F.lit(t).alias("table_name"), "col_name", "data_type", F.lit(rows).cast("long").alias("table_rows"))
        out = d if out is None else out.unionByName(d)
    return out


@register("scan_table", PDE_TABLE_SQL)
def q_scan_table(spark, sf):
    from claimlake.plans.warehouse import full_refresh
    db = _db(spark, ["prescription_drug_events"])
    full_refresh(spark, f"{db}.prescription_drug_events", si.pde(spark, sf))
    return spark.table(f"{db}.prescription_drug_events")


@register("table_full_refresh", PDE_TABLE_SQL)
def q_table_full_refresh(spark, sf):
    """SK4: two loads; the second replaces the first (no duplicates, no empty window)."""
    from claimlake.plans.warehouse import full_refresh
    db = _db(spark, ["prescription_drug_events"])
    t = f"{db}.prescription_drug_events"
    full_refresh(spark, t, si.pde(spark, sf).where("PDE_ID % 3 = 0").withColumn("PDE_ID", F.col("PDE_ID") + 1))
    full_refresh(spark, t, si.pde(spark, sf))
    return spark.table(t)


@register("table_append", PDE_TABLE_SQL)
def q_table_append(spark, sf):
    """SK5: the table filled by two appends (rows shipped before 1995, then the rest)."""
    from claimlake.plans.warehouse import append
    db = _db(spark, ["prescription_drug_events"])
    t = f"{db}.prescription_drug_events"
    p = si.pde(spark, sf)
    cut = F.col("SRVC_DT") < F.lit(dt.date(1995, 1, 1))
    append(spark, t, p.where(cut))
    append(spark, t, p.where(~cut | F.col("SRVC_DT").isNull()))
    return spark.table(t)


@register("union_branches", V("SELECT * FROM inp", "inp"))
def q_union_branches(spark, sf):
    """SE2: named-link and archive-fallback branches appended into one dataset."""
    from claimlake.plans.warehouse import union_branches
    i = si.inp(spark, sf)
    named = i.where(F.col("ICD9_PRCDR_CD_1") == "F")
    fallback = i.where(~(F.col("ICD9_PRCDR_CD_1") == "F") | F.col("ICD9_PRCDR_CD_1").isNull())
    return union_branches(named, fallback)


@register("run_log")
def q_run_log(spark, sf):
    from claimlake.plans.warehouse import logged_write
    root = scratch_path(spark, "run_log")
    return logged_write(si.pde(spark, sf), f"{root}/data", "drug_events", f"{root}/log", files=1)


@register("run_log_rows", V("SELECT 'drug_events' AS job, 2 AS files, count(*) AS rows, true AS dated FROM pde", "pde"))
def q_run_log_rows(spark, sf):
    """SK7, FN17: the stable columns of a run-log row; the id holds the date and the job."""
    from claimlake.plans.warehouse import logged_write, union_branches
    root, p = scratch_path(spark, "run_log"), si.pde(spark, sf)
    odd = F.coalesce(F.col("DAYS_SUPLY_NUM") % 2 == 1, F.lit(False))
    drops = [p.where(odd), p.where(~odd)]  # two files processed by one run; each task writes what it reads
    log = logged_write(union_branches(*drops), f"{root}/data", "drug_events", f"{root}/log", files=len(drops))
    return log.select("job", "files", "rows", F.col("run_id").rlike("^[0-9]{2}/[0-9]{2}/[0-9]{2}/drug_events/").alias("dated"))


# ------------------------------------------------------------------ ingest
def _raw_beneficiary(spark, sf):
    b = si.ben(spark, sf)
    k = F.col("DESYNPUF_ID").cast("long")
    b = (b.withColumn("BENE_DEATH_DT", F.when(k % 9 == 0, F.date_add("BENE_BIRTH_DT", 30000)))
          .withColumn("BENE_COUNTY_CD", (k * 37).cast("int"))
          .withColumn("BENE_ESRD_IND", F.when(k % 4 == 0, F.lit("Y")).otherwise(F.lit("0"))))
    return raw_frame(b, S.BENEFICIARY)


BEN_EXPECTED = {n: n for n in ["DESYNPUF_ID", "BENE_BIRTH_DT", "BENE_SEX_IDENT_CD", "BENE_RACE_CD",
                               "SP_STATE_CODE", *S.CONDITION_FLAGS, "MEDREIMB_IP", "BENRES_IP"]}
BEN_EXPECTED.update({
    "BENE_DEATH_DT": "CASE WHEN CAST(DESYNPUF_ID AS BIGINT) % 9 = 0 THEN BENE_BIRTH_DT + 30000 END",
    "BENE_COUNTY_CD": "TRY_CAST(CAST(DESYNPUF_ID AS BIGINT) * 37 AS SMALLINT)",
    "BENE_ESRD_IND": "CASE WHEN CAST(DESYNPUF_ID AS BIGINT) % 4 = 0 THEN 'Y' ELSE '0' END",
})


def _raw_claims(spark, sf, layout):
    i = si.inp(spark, sf)
    k = F.col("CLM_ID")
    i = (i.withColumn("SEGMENT", F.lit(1))
          .withColumn("CLM_THRU_DT", F.date_add("CLM_FROM_DT", 3))
          .withColumn("AT_PHYSN_NPI", F.when(k % 3 != 0, F.col("DESYNPUF_ID").cast("double") * F.lit(1000003.0)))
          .withColumn("CLM_UTLZTN_DAY_CNT", F.when(k % 4 != 0, (k % 30) + F.lit(0.9)))
          .withColumn("CLM_ADMSN_DT", F.when(k % 11 == 0, F.lit("2008XX01")).otherwise(F.lit("20080101"))))
    return raw_frame(i, layout)


CLAIM_EXPECTED = {n: n for n in ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_PMT_AMT", "ICD9_DGNS_CD_1",
                                 "ICD9_PRCDR_CD_1", "HCPCS_CD_1"]}
CLAIM_EXPECTED.update({
    "SEGMENT": "1",
    "CLM_THRU_DT": "CLM_FROM_DT + 3",
    "AT_PHYSN_NPI": "CASE WHEN CLM_ID % 3 <> 0 THEN CAST(CAST(CAST(DESYNPUF_ID AS DOUBLE) * 1000003.0 AS BIGINT) AS VARCHAR) END",
    "CLM_UTLZTN_DAY_CNT": "CASE WHEN CLM_ID % 4 = 0 THEN 0 ELSE CLM_ID % 30 END",
    "CLM_ADMSN_DT": "CASE WHEN CLM_ID % 11 = 0 THEN NULL ELSE DATE '2008-01-01' END",
})


def _raw_drug_events(spark, sf):
    p = si.pde(spark, sf)
    p = p.withColumn("QTY_DSPNSD_NUM", F.when(F.col("DAYS_SUPLY_NUM") != 1, F.col("QTY_DSPNSD_NUM") + F.lit(0.9)))
    return raw_frame(p, S.DRUG_EVENTS)


PDE_EXPECTED = {n: n for n, _ in S.DRUG_EVENTS}
PDE_EXPECTED["QTY_DSPNSD_NUM"] = "CASE WHEN DAYS_SUPLY_NUM = 1 THEN 0 ELSE CAST(trunc(QTY_DSPNSD_NUM + 0.9) AS INTEGER) END"

# Archive names in the source's naming pattern.
ARCHIVE_STEMS = {
    "beneficiary_summary": "DE1_0_2008_Beneficiary_Summary_File_Sample",
    "inpatient_claims": "DE1_0_2008_to_2010_Inpatient_Claims_Sample",
    "outpatient_claims": "DE1_0_2008_to_2010_Outpatient_Claims_Sample",
    "prescription_drug_events": "DE1_0_2008_to_2010_Prescription_Drug_Events_Sample",
}


#: Landing folders made ahead by the bench, by table.
PREPARED: dict[str, str] = {}


def _landing(spark, raw: DataFrame, table: str, files: int | None = None) -> str:
    from claimlake.plans.zip_fixture import write_zip_csv
    if table in PREPARED and files is None:
        return PREPARED[table]
    root = f"{scratch_path(spark, f'landing_{table}')}"
    write_zip_csv(raw, root, ARCHIVE_STEMS[table], files=files or spark.sparkContext.defaultParallelism)
    return root


def prepare_landing(spark, sf: str) -> None:
    """Make the archives of the timed ingest queries, for the bench."""
    made = {"inpatient_claims": _landing(spark, _raw_claims(spark, sf, S.INPATIENT), "inpatient_claims"),
            "prescription_drug_events": _landing(spark, _raw_drug_events(spark, sf), "prescription_drug_events")}
    PREPARED.update(made)


def _ingest_roundtrip(spark, raw: DataFrame, table: str, files: int | None = None, times: int = 1):
    from claimlake.plans.ingest import ingest, read_ingested
    root, landing = scratch_path(spark, f"ingest_{table}"), _landing(spark, raw, table, files)
    for _ in range(times):
        res = ingest(spark, landing, table, f"{root}/lake")
    return res, read_ingested(spark, res.path, table)


@register("ingest_beneficiary", V(ddl_sql(S.BENEFICIARY, BEN_EXPECTED, "ben"), "ben"))
def q_ingest_beneficiary(spark, sf):
    return _ingest_roundtrip(spark, _raw_beneficiary(spark, sf), "beneficiary_summary")[1]


@register("ingest_inpatient", V(ddl_sql(S.INPATIENT, CLAIM_EXPECTED, "inp"), "inp"))
def q_ingest_inpatient(spark, sf):
    return _ingest_roundtrip(spark, _raw_claims(spark, sf, S.INPATIENT), "inpatient_claims")[1]


@register("ingest_outpatient", V(ddl_sql(S.OUTPATIENT, CLAIM_EXPECTED, "inp"), "inp"))
def q_ingest_outpatient(spark, sf):
    return _ingest_roundtrip(spark, _raw_claims(spark, sf, S.OUTPATIENT), "outpatient_claims")[1]


@register("ingest_drug_events", V(ddl_sql(S.DRUG_EVENTS, PDE_EXPECTED, "pde"), "pde"))
def q_ingest_drug_events(spark, sf):
    return _ingest_roundtrip(spark, _raw_drug_events(spark, sf), "prescription_drug_events")[1]


@register("ingest_file_counts")
def q_ingest_file_counts(spark, sf):
    from claimlake.plans.ingest import file_counts
    a, _ = _ingest_roundtrip(spark, _raw_beneficiary(spark, sf), "beneficiary_summary")
    b, _ = _ingest_roundtrip(spark, _raw_drug_events(spark, sf), "prescription_drug_events")
    return file_counts(spark, {a.table: a.path, b.table: b.path})


@register("ingest_file_counts_rows", V("""SELECT 'beneficiary_summary' AS table_name, 3 AS source_archives, true AS files, count(*) AS rows FROM ben
UNION ALL SELECT 'prescription_drug_events', 3, true, count(*) FROM pde""", "ben", "pde"))
def q_ingest_file_counts_rows(spark, sf):
    """SK8 with three archives a table: at least one output file for each."""
    from claimlake.plans.ingest import file_counts
    a, _ = _ingest_roundtrip(spark, _raw_beneficiary(spark, sf), "beneficiary_summary", files=3)
    b, _ = _ingest_roundtrip(spark, _raw_drug_events(spark, sf), "prescription_drug_events", files=3)
    counts = file_counts(spark, {a.table: a.path, b.table: b.path})
    return counts.select("table_name", "source_archives", (F.col("parquet_files") >= 3).alias("files"), "rows")


@register("ingest_rerun", ORACLES["ingest_drug_events"])
def q_ingest_rerun(spark, sf):
    """JB4 run three times on one landing folder: every row once."""
    return _ingest_roundtrip(spark, _raw_drug_events(spark, sf), "prescription_drug_events", times=3)[1]


@register("ingest_same_name", ORACLES["ingest_drug_events"])
def q_ingest_same_name(spark, sf):
    """JB4: files of the same names in three folders, two ingested by one call and one by another, then all again: every row once."""
    from claimlake.plans.ingest import ingest, read_ingested
    from claimlake.plans.zip_fixture import ARCHIVE_ROWS, write_zip_csv
    root = scratch_path(spark, "same_name")
    raw, year = _raw_drug_events(spark, sf), F.coalesce(F.year("SRVC_DT"), F.lit(0))
    stem = ARCHIVE_STEMS["prescription_drug_events"]
    for folder, part in (("a/1", year < 1994), ("a/2", (year >= 1994) & (year < 1996)), ("b", year >= 1996)):
        write_zip_csv(raw.where(part), f"{root}/landing/{folder}", stem, files=2, max_rows=ARCHIVE_ROWS)
    for source in (f"{root}/landing/a", f"{root}/landing/b", f"{root}/landing"):
        res = ingest(spark, source, "prescription_drug_events", f"{root}/lake")
    return read_ingested(spark, res.path, "prescription_drug_events")


@register("ingest_bad_records", V("""SELECT count(*) AS n_rows, count(*) FILTER (PDE_ID % 50 = 0) AS n_rejected,
  CAST(sum(PDE_ID) FILTER (PDE_ID % 50 <> 0) AS BIGINT) AS sum_good FROM pde""", "pde"))
def q_ingest_bad_records(spark, sf):
    """SC3: one line in fifty has a stray quote; it is counted and costs no other line."""
    from claimlake.plans.ingest import ingest
    from claimlake.sources.archives import CSV_GLOB
    from claimlake.sources.files import RAW_ENCODING
    root = scratch_path(spark, "bad_records")
    raw = _raw_drug_events(spark, sf).withColumn(
        "DESYNPUF_ID", F.when(F.col("PDE_ID") % 50 == 0, F.concat(F.lit('"'), "DESYNPUF_ID")).otherwise(F.col("DESYNPUF_ID")))
    (raw.write.option("header", True).option("encoding", RAW_ENCODING).option("dateFormat", "yyyyMMdd").option("quote", "")
     .csv(f"{root}/landing"))
    res = ingest(spark, f"{root}/landing", "prescription_drug_events", f"{root}/lake", CSV_GLOB)
    bad = F.size("_rejected") > 0
    return spark.read.parquet(res.path).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_rejected"),
                                            F.sum(F.when(~bad, F.col("PDE_ID"))).alias("sum_good"))


# --------------------------------------------------------------- streaming
@register("ingest_incremental", "SELECT * FROM events")
def q_ingest_incremental(spark, sf):
    """ST1: events land in two drops; two incremental runs ingest each file once."""
    from claimlake.streaming.incremental import run_incremental
    ev = si.read_table(spark, sf, "events")
    root = scratch_path(spark, "incremental")
    bounds = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    mid = bounds["lo"] + (bounds["hi"] - bounds["lo"]) / 2
    early = F.col("ts") < F.lit(mid)
    ev.where(early).write.mode("append").parquet(f"{root}/landing")
    args = (f"{root}/landing", ev.schema, f"{root}/target", f"{root}/checkpoint")
    run_incremental(spark, *args)
    ev.where(~early | F.col("ts").isNull()).write.mode("append").parquet(f"{root}/landing")
    run_incremental(spark, *args)
    run_incremental(spark, *args)  # nothing new: adds no rows
    return spark.read.schema(ev.schema).parquet(f"{root}/target")


@register("warehouse_refresh", V("""SELECT 'beneficiary_summary' AS table_name, count(*) AS n_rows FROM ben
UNION ALL SELECT 'inpatient_claims', count(*) FROM inp
UNION ALL SELECT 'outpatient_claims', count(*) FROM inp
UNION ALL SELECT 'prescription_drug_events', count(*) FROM pde
UNION ALL SELECT 'annual_cost_predictions', count(*) FROM acp""", "ben", "inp", "pde", "acp"))
def q_warehouse_refresh(spark, sf):
    """JB8: full refresh of all five warehouse tables, then their row counts."""
    from claimlake.plans.warehouse import create_schema, full_refresh
    db = f"claims_{uuid.uuid4().hex[:8]}"
    create_schema(spark, db, scratch_path(spark, "warehouse"))
    out = None
    for t, df in _warehouse_sources(spark, sf).items():
        full_refresh(spark, f"{db}.{t}", df, t)
        c = spark.table(f"{db}.{t}").groupBy().agg(F.count(F.lit(1)).alias("n_rows")) \
            .select(F.lit(t).alias("table_name"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


@register("ingest_incremental_claims", V(ddl_sql(S.DRUG_EVENTS, PDE_EXPECTED, "pde"), "pde"))
def q_ingest_incremental_claims(spark, sf):
    """ST1 on raw archives: drug-event archives land in two drops; each is ingested once."""
    from claimlake.plans.zip_fixture import write_zip_csv
    from claimlake.streaming.incremental import run_archive_ingest
    raw = _raw_drug_events(spark, sf)
    root = scratch_path(spark, "incremental_claims")
    early = F.col("SRVC_DT") < F.lit(dt.date(1995, 1, 1))
    stem = ARCHIVE_STEMS["prescription_drug_events"]
    args = (f"{root}/landing", "prescription_drug_events", f"{root}/target", f"{root}/checkpoint")
    n = spark.sparkContext.defaultParallelism
    write_zip_csv(raw.where(early), f"{root}/landing", f"{stem}_A", files=n)
    run_archive_ingest(spark, *args)
    write_zip_csv(raw.where(~early | F.col("SRVC_DT").isNull()), f"{root}/landing", f"{stem}_B", files=n)
    run_archive_ingest(spark, *args)
    return spark.read.schema(S.table_struct("prescription_drug_events")).parquet(f"{root}/target")


@register("ingest_incremental_claims_source", ORACLES["ingest_incremental_claims"])
def q_ingest_incremental_claims_source(spark, sf):
    """ST1 on raw archives through the data source ``claim_records``, in two drops."""
    from claimlake.plans.zip_fixture import ARCHIVE_ROWS, write_zip_csv
    from claimlake.streaming.incremental import run_record_ingest
    raw = _raw_drug_events(spark, sf)
    root = scratch_path(spark, "incremental_source")
    early = F.col("SRVC_DT") < F.lit(dt.date(1995, 1, 1))
    stem = ARCHIVE_STEMS["prescription_drug_events"]
    args = (f"{root}/landing", "prescription_drug_events", f"{root}/target", f"{root}/checkpoint")
    write_zip_csv(raw.where(early), f"{root}/landing", f"{stem}_A", files=3, max_rows=ARCHIVE_ROWS)
    run_record_ingest(spark, *args)
    write_zip_csv(raw.where(~early | F.col("SRVC_DT").isNull()), f"{root}/landing", f"{stem}_B", files=3, max_rows=ARCHIVE_ROWS)
    run_record_ingest(spark, *args)
    return spark.read.schema(S.table_struct("prescription_drug_events")).parquet(f"{root}/target")


@register("ingest_reissued", ORACLES["ingest_drug_events"])
def q_ingest_reissued(spark, sf):
    """ST1: archives are dropped, issued again under the same names with other rows, and joined by further ones."""
    from claimlake.plans.ingest import TABLE_PREFIXES, read_ingested
    from claimlake.plans.zip_fixture import ARCHIVE_ROWS, write_zip_csv
    from claimlake.streaming.reissued import run_reissued_ingest
    raw = _raw_drug_events(spark, sf)
    root, table = scratch_path(spark, "reissued"), "prescription_drug_events"
    early = F.col("SRVC_DT") < F.lit(dt.date(1995, 1, 1))
    stem = ARCHIVE_STEMS[table]
    args = (f"{root}/landing", table, f"{root}/lake", f"{root}/checkpoint")
    write_zip_csv(raw.where(early).withColumn("PDE_ID", -F.col("PDE_ID")), f"{root}/landing", f"{stem}_A", files=3, max_rows=ARCHIVE_ROWS)
    run_reissued_ingest(spark, *args)
    write_zip_csv(raw.where(early), f"{root}/landing", f"{stem}_A", files=3, max_rows=ARCHIVE_ROWS)
    write_zip_csv(raw.where(~early | F.col("SRVC_DT").isNull()), f"{root}/landing", f"{stem}_B", files=3, max_rows=ARCHIVE_ROWS)
    run_reissued_ingest(spark, *args)
    run_reissued_ingest(spark, *args)  # nothing new
    return read_ingested(spark, f"{root}/lake/{TABLE_PREFIXES[table]}", table)
