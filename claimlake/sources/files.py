"""File scans with fixed schemas (SC1, SC2, SC4, SC5, SC6, SC8).

Schemas are declared at the read; nothing is inferred, so types cannot drift
between files of one dataset.  Parquet reads keep column pruning and filter
push-down (``ReadSchema`` / ``PushedFilters`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw claim files' text encoding and date format.
RAW_ENCODING = "ISO-8859-1"
RAW_DATE_FORMAT = "yyyyMMdd"
CORRUPT_COLUMN = "_corrupt_record"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, encoding: str = RAW_ENCODING,
             date_format: str = RAW_DATE_FORMAT, keep_corrupt: bool = False, multiline: bool = False, **sizes) -> DataFrame:
    """SC1: typed CSV with a header; malformed rows keep their text in ``_corrupt_record``.

    ``multiline``: quoted values may hold line feeds.  Files are still read in
    ranges (see :mod:`claimlake.sources.archives`), not one task a file."""
    if multiline:
        from claimlake.sources.archives import archive_records, list_archives, parse_records

        lines = archive_records(list_archives(spark, path, "*"), [f.name for f in schema.fields], encoding, multiline=True, **sizes)
        rows = parse_records(lines, schema, {"dateFormat": date_format})
        return rows.select(*[f.name for f in schema.fields], *([CORRUPT_COLUMN] if keep_corrupt else []))
    reader = (spark.read.option("header", True).option("encoding", encoding)
              .option("dateFormat", date_format).option("mode", "PERMISSIVE"))
    if keep_corrupt:
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(schema).csv(path)


def scan_csv_untyped(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """SC2: header row, every column text, no inference pass."""
    return spark.read.option("header", True).option("encoding", encoding).csv(path)


def scan_csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SC8: comma-separated, header, UTF-8, declared column types."""
    return (spark.read.option("header", True).option("sep", ",").option("encoding", "UTF-8")
            .schema(schema).csv(path))


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SC5: one Parquet file or directory."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(path)


def scan_parquet_multi(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """SC4 / SE1: many Parquet files read as one dataset (an implicit UNION ALL)."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(*paths)


def source_file_inventory(spark: SparkSession, root: str, glob: str | None = None,
                          recursive: bool = True) -> DataFrame:
    """SC6: the files under a prefix (path, name, size, modification time).

    Uses the binary-file source without its ``content`` column, so only the
    listing is done; Spark lists large directories in parallel.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(root)
    return files.select(
        F.col("path"),
        F.substring_index(F.col("path"), "/", -1).alias("file_name"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )
