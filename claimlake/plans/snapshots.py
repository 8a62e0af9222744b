"""Snapshots laid out for repeated querying (SC9).

A snapshot is a catalog table bucketed and sorted by its key, so that two
snapshots of as many buckets join on their keys without an exchange, a look-up by
key opens one bucket, and minimum and maximum of a row group say where in it the key is.
Columns named in ``lookups`` get Parquet Bloom filters, which skip row groups where
minimum and maximum don't.  Table and column statistics are collected for the optimiser.

Rows are dealt by the hash that buckets use, so a bucket is one task's files
(several, if it has more than ``max_rows_per_file`` rows).  Each load writes a folder of
its own and then replaces the table entry.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ROWS_PER_FILE = 4_000_000
#: Bytes of a row group: small enough that skipping one pays for a look-up.
ROW_GROUP_BYTES = 32 << 20


def bucketed_snapshot(df: DataFrame, table: str, root: str, key: str, buckets: int, lookups: list[str] | None = None,
                      distinct: dict[str, int] | None = None, max_rows_per_file: int = MAX_ROWS_PER_FILE,
                      row_group_bytes: int = ROW_GROUP_BYTES) -> DataFrame:
    """Write ``df`` as the catalog table ``table`` under ``root``; returns the table.

    ``distinct`` gives the expected number of values of a look-up column in a row
    group (a million if not known), by which its Bloom filter is sized."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{table.split('.')[-1]}/v-{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
    writer = (df.repartition(buckets, F.col(key)).write.mode("overwrite").option("path", path)
              .option("maxRecordsPerFile", max_rows_per_file).option("parquet.block.size", row_group_bytes))
    for c in lookups or []:
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{c}", (distinct or {}).get(c, 1_000_000)))
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join([key, *(lookups or [])])}")
    return spark.table(table)


def join_snapshots(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """JO1 on two snapshots bucketed by these keys: buckets are joined pairwise, no rows move."""
    return left.join(right.hint("merge"), left[left_key] == right[right_key], how)
