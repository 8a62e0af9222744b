"""Warehouse tables and loads (SK2-SK7, SE2, JB8).

Tables are external Parquet tables in the session catalog, located under a
caller-given root (a shared folder on a cluster).  A full refresh writes the
new data to a fresh version folder and then repoints the table in one
catalog operation, so readers see the old rows or the new rows, never a
half-written or empty table - the same guarantee as the original
``begin; delete; copy; commit``.  Appends resolve columns by name.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimlake import schemas as S
from claimlake.operators.rowindex import with_row_index


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` by name, in DDL order, cast to the DDL types."""
    st = S.table_struct(table)
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in st.fields])


def create_schema(spark: SparkSession, db: str, root: str, tables: list[str] | None = None) -> dict:
    """SK6: drop + create the schema and its tables (external Parquet tables)."""
    root = root.rstrip("/")
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}.db'")
    locs = {}
    for t in tables or list(S.TABLES):
        loc = f"{root}/{db}.db/{t}/{_version_name(0)}"
        spark.sql(f"DROP TABLE IF EXISTS {db}.{t}")
        spark.sql(S.create_table_sql(f"{db}.{t}", S.TABLES[t], loc))
        locs[t] = loc
    return locs


def _version_name(millis: int | None = None) -> str:
    """Version folder names sort by creation time: v-<epoch ms>-<random>."""
    ms = int(time.time() * 1000) if millis is None else millis
    return f"v-{ms:013d}-{uuid.uuid4().hex[:8]}"


def table_location(spark: SparkSession, qualified: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def full_refresh(spark: SparkSession, qualified: str, df: DataFrame, table: str | None = None) -> str:
    """SK4: replace the table's rows atomically (stage, then swap the location)."""
    table = table or qualified.split(".")[-1]
    current = table_location(spark, qualified).rstrip("/")
    base = current.rsplit("/", 1)[0]
    staged = f"{base}/{_version_name()}"
    conform(df, table).write.mode("errorifexists").parquet(staged)
    spark.sql(f"ALTER TABLE {qualified} SET LOCATION '{staged}'")
    spark.catalog.refreshTable(qualified)
    return staged


def drop_old_versions(spark: SparkSession, qualified: str, keep_previous: int = 1) -> list[str]:
    """Delete version folders of a refreshed table except the current one and the
    ``keep_previous`` newest before it (readers may still be scanning those).

    Driver-side metadata work only (a folder listing and deletes through the
    Arrow filesystem layer: local, HDFS or object stores); returns the deleted paths.
    """
    import pyarrow.fs as pafs

    from claimlake.sources.archives import arrow_fs
    current = table_location(spark, qualified).rstrip("/")
    base = current.rsplit("/", 1)[0]
    fs, base_p = arrow_fs(base)
    entries = fs.get_file_info(pafs.FileSelector(base_p, allow_not_found=True))
    versions = sorted((e for e in entries if e.type == pafs.FileType.Directory and e.base_name.startswith("v-")),
                      key=lambda e: e.base_name, reverse=True)
    cur_name = current.rsplit("/", 1)[-1]
    older = [e for e in versions if e.base_name != cur_name]
    deleted = []
    for e in older[keep_previous:]:
        fs.delete_dir(e.path)
        deleted.append(e.path)
    return deleted


def append(spark: SparkSession, qualified: str, df: DataFrame, table: str | None = None) -> None:
    """SK5: append rows, matching columns by name."""
    table = table or qualified.split(".")[-1]
    conform(df, table).write.mode("append").insertInto(qualified)


def union_branches(*frames: DataFrame) -> DataFrame:
    """SE2: several ingest branches feeding one dataset, matched by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=False)
    return out


def write_predictions(df: DataFrame, path: str, single_file: bool = False) -> None:
    """SK2: the scored table as Parquet (one file only when asked for)."""
    out = conform(df, "annual_cost_predictions")
    (out.coalesce(1) if single_file else out).write.mode("overwrite").parquet(path)


def write_csv_indexed(df: DataFrame, path: str, order_cols: list, index_name: str = "F1") -> None:
    """SK3: CSV with a header and a leading 0-based row index over a declared order."""
    indexed = with_row_index(df, order_cols, index_name)
    indexed.write.mode("overwrite").option("header", True).csv(path)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """SC9: a full snapshot for repeated querying (CTAS-like Parquet copy)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def logged_write(df: DataFrame, path: str, job: str, log_path: str, files: int | None = None,
                 max_rows_per_file: int | None = None) -> DataFrame:
    """SK7: write ``df`` and append one run-log row (rows counted during the write;
    ``files``: the source files that the run processed, not those that it writes)."""
    spark = df.sparkSession
    obs = Observation(f"log_{job}")
    started = time.time()
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if max_rows_per_file:
        w = w.option("maxRecordsPerFile", max_rows_per_file)
    w.parquet(path)
    elapsed = time.time() - started
    rows = int(obs.get.get("rows") or 0)
    entry = spark.createDataFrame(
        [(job, files, rows, float(elapsed))],
        "job string, files int, rows long, elapsed_sec double")
    entry = entry.select(
        F.current_timestamp().alias("run_ts"),
        F.concat_ws("/", F.date_format(F.current_timestamp(), "yy/MM/dd"), F.col("job"),
                    F.expr("uuid()")).alias("run_id"),
        "job", "files", "rows", "elapsed_sec")
    entry.write.mode("append").parquet(log_path)
    return spark.read.parquet(log_path)
