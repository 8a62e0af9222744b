"""Ingest jobs (JB1-JB4): raw archived CSV -> typed, cleaned Parquet datasets.

One Spark job per table: archive scan (parallel over archives) -> typing
and cleaning as JVM expressions -> chunked Parquet append.  Rows are never
dropped: a value that does not convert (malformed date, integer wider
than its column) becomes null and the row records the offending column names
in ``_rejected`` (``_corrupt_record`` for a line that did not parse), so the quarantine is ``WHERE size(_rejected) > 0`` on the
same dataset - written in the same pass, not a second job.  Each row also
keeps the archive it came from (``_source_file``).

A dataset has one partition folder a landed file (``_archive``, the file's name and
a digest of its path), and a write replaces the folders of the files it holds: a
rerun, or a retry after a failure, never adds the same file twice, and files of
one name in different folders are kept apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimlake import schemas as S
from claimlake.functions import clean
from claimlake.sources.archives import ZIP_GLOB, scan_zip_csv, source_key
from claimlake.sources.files import CORRUPT_COLUMN

# Which columns each raw file gets special cleaning on.
DATE_COLUMNS = {
    "beneficiary_summary": ["BENE_BIRTH_DT", "BENE_DEATH_DT"],
    "inpatient_claims": ["CLM_FROM_DT", "CLM_THRU_DT", "CLM_ADMSN_DT", "NCH_BENE_DSCHRG_DT"],
    "outpatient_claims": ["CLM_FROM_DT", "CLM_THRU_DT"],
    "prescription_drug_events": ["SRVC_DT"],
}
NPI_COLUMNS = ["AT_PHYSN_NPI", "OP_PHYSN_NPI", "OT_PHYSN_NPI"]
FILL_ZERO_COLUMNS = {
    "inpatient_claims": ["CLM_UTLZTN_DAY_CNT"],
    "prescription_drug_events": ["QTY_DSPNSD_NUM"],
}
TABLE_PREFIXES = {
    "beneficiary_summary": "Beneficiary_Summary",
    "inpatient_claims": "Inpatient_Claims",
    "outpatient_claims": "Outpatient_Claims",
    "prescription_drug_events": "Prescription_Drug_Events",
}
#: Rows in an output file at most; some hundred MB of these tables.
MAX_ROWS_PER_FILE = 2_000_000


def _typed(table: str, name: str, kind: str, raw: Column) -> Column:
    if name in DATE_COLUMNS.get(table, []):
        return clean.parse_yyyymmdd(raw)
    if name in FILL_ZERO_COLUMNS.get(table, []):
        return clean.fill_zero_short(raw, {"short": "smallint", "long": "bigint"}.get(kind, kind))
    if name in NPI_COLUMNS:
        return clean.normalise_npi(raw)
    return {
        "string": clean.cast_string,
        "date": clean.parse_yyyymmdd,
        "short": clean.cast_smallint,
        "int": clean.cast_int,
        "long": clean.cast_long,
        "double": clean.to_double,
    }[kind](raw)


def type_raw(raw: DataFrame, table: str) -> DataFrame:
    """Text columns -> DDL types, plus ``_rejected`` (columns whose value was lost).

    Two projections: the typed values (each conversion built once) next to a
    presence flag of every raw value, then ``_rejected`` from plain null checks.
    """
    layout = S.TABLES[table]
    typed, present = [], []
    for i, (name, kind) in enumerate(layout):
        r = F.col(name)
        typed.append(_typed(table, name, kind, r).alias(name))
        present.append(clean.given(r).alias(f"_p{i}"))
    extra = [c for c in ("_source_file", CORRUPT_COLUMN) if c in raw.columns]
    step = raw.select(*typed, *present, *extra)
    lost = [F.when(F.col(f"_p{i}") & F.col(name).isNull(), F.lit(name)) for i, (name, _) in enumerate(layout)]
    if CORRUPT_COLUMN in extra:
        lost.append(F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(CORRUPT_COLUMN)))
        extra.remove(CORRUPT_COLUMN)
    rejected = F.filter(F.array(*lost), lambda x: x.isNotNull()).alias("_rejected")
    return step.select(*[n for n, _ in layout], rejected, *extra)


@dataclass
class IngestResult:
    table: str
    path: str
    rows: int
    rejected_rows: int


def ingest(spark: SparkSession, source: str | list[str] | DataFrame, table: str, target_root: str,
           glob: str = ZIP_GLOB, max_rows_per_file: int = MAX_ROWS_PER_FILE, multiline: bool = False) -> IngestResult:
    """JB1-JB4: raw files of ``source`` -> ``<target_root>/<Table_Prefix>/``.

    ``source`` is a folder, a list of files, or a listing (path, length); ``glob``
    picks the files of a folder, ZIP archives (first member read) or plain CSV.
    ``multiline``: quoted values may hold line feeds.  A file that is there
    already (by its path) is replaced.
    """
    raw = scan_zip_csv(spark, source, S.raw_struct(S.TABLES[table]), glob, multiline=multiline, by_file=True)
    typed = type_raw(raw, table)
    obs = Observation(f"ingest_{table}")
    typed = typed.observe(obs, F.count(F.lit(1)).alias("rows"),
                          F.sum(F.when(F.size("_rejected") > 0, 1).otherwise(0)).alias("rejected"))
    path = f"{target_root.rstrip('/')}/{TABLE_PREFIXES[table]}"
    write_archives(typed, path, max_rows_per_file)
    m = _counts(obs)
    return IngestResult(table, path, int(m.get("rows") or 0), int(m.get("rejected") or 0))


def _counts(obs: Observation) -> dict:
    """The counts of a write; an input found to be empty while it ran leaves none."""
    from py4j.protocol import Py4JJavaError

    try:
        return obs.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return {}


def archive_folder(path: Column) -> Column:
    """What names the partition of a landed file: its name, and a digest of its path."""
    digest = F.substring(F.md5(source_key(path).cast("binary")), 1, 16)
    return F.concat(F.substring_index(path, "/", -1), F.lit("-"), digest)


def write_archives(df: DataFrame, path: str, max_rows_per_file: int = MAX_ROWS_PER_FILE) -> None:
    """SK1: one folder of Parquet files an archive, replacing those of the archives
    in ``df``.  Rows are written by the tasks that hold them: the scan has dealt the
    text by archive (``by_file``), a large one to several tasks, small ones to one, which is
    shuffled once and is far narrower than the typed rows."""
    named = df.withColumn("_archive", archive_folder(F.col("_source_file")))
    (named.write.option("maxRecordsPerFile", max_rows_per_file)
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("_archive").parquet(path))


def write_chunked_parquet(df: DataFrame, path: str, max_rows_per_file: int = MAX_ROWS_PER_FILE,
                          mode: str = "append") -> None:
    """SK1: Parquet files of at most ``max_rows_per_file`` rows under one prefix."""
    df.write.option("maxRecordsPerFile", max_rows_per_file).mode(mode).parquet(path)


def read_ingested(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The DDL columns of an ingested dataset (quarantine columns left out)."""
    return spark.read.schema(S.table_struct(table)).parquet(path).select(*[n for n, _ in S.TABLES[table]])


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an ingested dataset that lost a value during typing."""
    return spark.read.parquet(path).where(F.size("_rejected") > 0)


def file_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """SK8: per table, how many source archives and output files fed it, and rows."""
    out = None
    for table, p in paths.items():
        d = spark.read.parquet(p).select(
            F.lit(table).alias("table_name"), "_source_file",
            F.col("_metadata.file_path").alias("_part"))
        out = d if out is None else out.unionByName(d)
    return out.groupBy("table_name").agg(
        F.count_distinct("_source_file").alias("source_archives"),
        F.count_distinct("_part").alias("parquet_files"),
        F.count(F.lit(1)).alias("rows"))
