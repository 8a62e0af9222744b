"""End-to-end jobs over real file locations (what the source system ran).

* :func:`ingest_all`      - every archive under a landing folder into the lake (JB1-JB4, SK7)
* :func:`model_job`       - lake -> feature table -> model -> scored Parquet (JB6, JB7, SK2, SK7)
* :func:`warehouse_job`   - full refresh of the five warehouse tables (JB8)
* :func:`dashboard_pack`  - the nine worksheet queries over the scored table (JB9)
* :func:`profile_job`     - the three column profiles of a raw CSV file (JB10)

Each job takes a session and paths and returns DataFrames or small summaries;
nothing is collected on a data path.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake import schemas as S
from claimlake.plans import dashboards as dash
from claimlake.plans.features import feature_table
from claimlake.plans.ingest import TABLE_PREFIXES, ingest, read_ingested
from claimlake.plans.links import filename_kind
from claimlake.plans.model import run as run_model
from claimlake.plans.model import scored_table
from claimlake.plans.warehouse import (create_schema, drop_old_versions, full_refresh,
                                       write_predictions)
from claimlake.session import scratch_path
from claimlake.sources.archives import list_archives, member_names


def _append_log(spark: SparkSession, log_path: str | None, job: str, files: int, rows: int,
                elapsed: float) -> None:
    if not log_path:
        return
    entry = spark.createDataFrame([(job, files, rows, float(elapsed))],
                                  "job string, files int, rows long, elapsed_sec double")
    entry.select(F.current_timestamp().alias("run_ts"),
                 F.concat_ws("/", F.date_format(F.current_timestamp(), "yy/MM/dd"), F.col("job"),
                             F.expr("uuid()")).alias("run_id"),
                 "job", "files", "rows", "elapsed_sec").write.mode("append").parquet(log_path)


# The kinds of the download catalogue and their tables, in the
# order that decides if a file is listed under several.
KIND_TABLES = {"beneficiary": "beneficiary_summary", "inpatient": "inpatient_claims",
               "outpatient": "outpatient_claims", "drug_events": "prescription_drug_events"}
LANDED_GLOB = "*.{[zZ][iI][pP],[cC][sS][vV]}"


def _table_of_name(name: Column) -> Column:
    """Table of a file name: the token rule, then the table prefixes; or null."""
    kinds = F.create_map(*[x for k, v in KIND_TABLES.items() for x in (F.lit(k), F.lit(v))])
    out = F.when(filename_kind(name).isNotNull(), kinds[filename_kind(name)])
    for table, prefix in TABLE_PREFIXES.items():
        out = out.when(name.contains(prefix), F.lit(table))
    return out


def route_landed_files(spark: SparkSession, landing: str, catalogue: DataFrame | None = None) -> DataFrame:
    """(path, length, file_name, ext, table) for every ZIP / CSV file under ``landing``.

    The table comes from, in order: the download catalogue's ``table_kind`` for
    that file name (the link-text rule; of several kinds the first of
    ``KIND_TABLES``), the file's own name, and the name of the archive's first
    member.  Files with no table are listed with a null table.
    """
    files = list_archives(spark, landing, LANDED_GLOB).withColumn("file_name", F.substring_index("path", "/", -1))
    files = files.withColumn("ext", F.lower(F.substring_index("file_name", ".", -1)))
    table = _table_of_name(F.col("file_name"))
    if catalogue is not None:
        ranks = F.array_position(F.array(*map(F.lit, KIND_TABLES)), F.col("table_kind"))
        first = (catalogue.where(F.col("table_kind").isin(*KIND_TABLES)).groupBy("file_name").agg(F.min(ranks).alias("_rank")))
        files = files.join(first, "file_name", "left")
        table = F.coalesce(F.get(F.array(*map(F.lit, KIND_TABLES.values())), (F.col("_rank") - 1).cast("int")), table)
    files = files.select("path", "length", "file_name", "ext", table.alias("table"))
    inside = member_names(files.where((F.col("ext") == "zip") & F.col("table").isNull()))
    inside = inside.select(F.col("path").alias("_path"), _table_of_name(F.col("member")).alias("_inside"))
    joined = files.join(inside, files["path"] == inside["_path"], "left")
    return joined.select("path", "length", "file_name", "ext", F.coalesce("table", "_inside").alias("table"))


def ingest_all(spark: SparkSession, landing: str, lake: str, log_path: str | None = None,
               catalogue: DataFrame | None = None) -> dict:
    """Ingest every ZIP archive and plain CSV file under ``landing`` into its table.

    Files are routed by :func:`route_landed_files`; the routed listing is written
    once and stays distributed.  Returns files / rows / rejected rows per table,
    and under ``_unrouted`` the number and the listing of files without a table,
    if there are any; both go to the run log.
    """
    started = time.time()
    listing = scratch_path(spark, "routed")
    route_landed_files(spark, landing, catalogue).write.parquet(listing)
    routed = spark.read.parquet(listing)
    counts = {r["table"]: r["count"] for r in routed.groupBy("table").count().collect()}  # one row a table
    out: dict = {}
    for table in sorted(t for t in counts if t is not None):
        res = ingest(spark, routed.where(F.col("table") == table).select("path", "length"), table, lake)
        out[table] = {"archives": counts[table], "rows": res.rows, "rejected_rows": res.rejected_rows, "path": res.path}
    _append_log(spark, log_path, "ingest", sum(v["archives"] for v in out.values()),
                sum(v["rows"] for v in out.values()), time.time() - started)
    if counts.get(None):
        out["_unrouted"] = {"archives": counts[None], "rows": 0, "rejected_rows": 0, "path": listing}
        _append_log(spark, log_path, "ingest_unrouted", counts[None], 0, time.time() - started)
    return out


def lake_table(spark: SparkSession, lake: str, table: str) -> DataFrame:
    return read_ingested(spark, f"{lake.rstrip('/')}/{TABLE_PREFIXES[table]}", table)


def model_job(spark: SparkSession, lake: str, predictions_path: str, seed: int = 42,
              log_path: str | None = None) -> dict:
    """Beneficiaries + inpatient claims from the lake -> scored table written as Parquet."""
    started = time.time()
    feats = feature_table(lake_table(spark, lake, "beneficiary_summary"),
                          lake_table(spark, lake, "inpatient_claims"))
    m = run_model(feats, seed)
    write_predictions(scored_table(m.scored), predictions_path)
    summary = {"r2_train": m.r2("train"), "r2_test": m.r2("test"),
               "coefficients": list(map(float, m.model.coefficients)), "intercept": float(m.model.intercept),
               "rejected_rows": m.rejected.count()}
    m.release()
    rows = spark.read.parquet(predictions_path).count()
    _append_log(spark, log_path, "predictions", 1, rows, time.time() - started)
    summary["scored_rows"] = rows
    return summary


def model_job_v1(spark: SparkSession, lake: str, csv_path: str, seed: int = 42) -> dict:
    """The earlier model: 3 indexed categoricals, 7 features, scores as CSV with a row index."""
    from claimlake.plans.features import V1_ORDER, feature_table_v1
    from claimlake.plans.model import V1_CATEGORICALS, V1_FEATURES, vector_text
    from claimlake.plans.warehouse import write_csv_indexed
    feats = feature_table_v1(lake_table(spark, lake, "beneficiary_summary"),
                             lake_table(spark, lake, "inpatient_claims"))
    m = run_model(feats, seed, categoricals=V1_CATEGORICALS, feature_cols=V1_FEATURES)
    out = m.scored.select(*V1_ORDER, *[f"{c}_index" for c in V1_CATEGORICALS],
                          vector_text("features").alias("features"), "prediction")
    write_csv_indexed(out, csv_path, [F.col("prediction").desc(), F.col("PATIENT_ID"), F.col("AGE_YRS")])
    summary = {"r2_train": m.r2("train"), "rejected_rows": m.rejected.count(), "rows": spark.read.option("header", True).csv(csv_path).count()}
    m.release()
    return summary


def warehouse_job(spark: SparkSession, db: str, root: str, lake: str, predictions_path: str,
                  create: bool = True, keep_previous: int = 1) -> dict:
    """Full refresh of the five tables from the lake and the scored table.

    After each swap, version folders older than ``keep_previous`` loads are removed.
    """
    if create:
        create_schema(spark, db, root)
    counts = {}
    for table in S.TABLES:
        if table == "annual_cost_predictions":
            src = spark.read.schema(S.table_struct(table)).parquet(predictions_path)
        else:
            src = lake_table(spark, lake, table)
        full_refresh(spark, f"{db}.{table}", src, table)
        drop_old_versions(spark, f"{db}.{table}", keep_previous)
        counts[table] = spark.table(f"{db}.{table}").count()
    return counts


def dashboard_pack(scored: DataFrame, method: str = "bracket") -> dict[str, DataFrame]:
    """The worksheets of both dashboards, by name.  ``method`` of the medians: "bracket"
    starts no job before a worksheet is read, "radix" moves no rows."""
    return {
        "sum_cost_by_age": dash.sum_cost_by_age(scored),
        "median_cost_by_age": dash.median_cost_by_age(scored, method=method),
        "median_cost_by_race": dash.median_cost_by(scored, "RACE", method=method),
        "median_cost_by_state": dash.median_cost_by(scored, "STATE", method=method),
        "median_cost_by_condition": dash.median_cost_by_condition(scored, method=method),
        "sum_cost_by_condition": dash.sum_cost_by_condition(scored),
        "trend_sum_by_age": dash.trend_cost_by_age(scored, "floor"),
        "trend_median_by_age": dash.trend_cost_by_age(scored, "ceil", method=method),
    }


def profile_job(spark: SparkSession, csv_path: str, measure: str | None = "MEDREIMB_IP") -> dict[str, DataFrame]:
    """The notebook's profile of a raw CSV (read untyped), one job per profile kind."""
    from claimlake.operators.profile import describe_profile, distinct_profile, group_mean_profile
    from claimlake.sources.files import scan_csv_untyped
    df = scan_csv_untyped(spark, csv_path)
    out = {"distinct": distinct_profile(df), "describe": describe_profile(df)}
    if measure and measure in df.columns:
        out["group_mean"] = group_mean_profile(df, measure)
    return out
