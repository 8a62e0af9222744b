"""Stored, mergeable distinct-count sketches (AG14, PF1 over a growing lake).

A HyperLogLog sketch of every column is kept beside each load and united when a
count is asked for, so the counts of a lake that grows read the sketches of all
loads and the rows of none.  A sketch is some 16 KB whatever its column holds, and is
built map-side: what moves are sketches, not values.  Rows and nulls are counted
with it.  Sketches are stored by load, and storing one again replaces it, so a load that is
repeated or issued again counts once.

The relative standard error of a united sketch is about 1.04 / sqrt(2 ** lg_k):
0.8 % with the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def column_sketches(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None, lg_k: int = LG_K) -> DataFrame:
    """(by..., column, sketch, rows, nulls) in one pass; values count as their text."""
    by = by or []
    columns = columns or [c for c in df.columns if c not in by]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for k, c in enumerate(columns):
        aggs += [F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"_s{k}"), F.count(F.col(c)).alias(f"_n{k}")]
    one = df.groupBy(*by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_s{k}").alias("sketch"), F.col("_rows").alias("rows"),
                              (F.col("_rows") - F.col(f"_n{k}")).alias("nulls")) for k, c in enumerate(columns)])
    return one.select(*by, F.inline(rows))


def store(sketches: DataFrame, path: str, load: str = "load") -> None:
    """Write sketches by their column ``load``; those of a load that is there already are replaced."""
    (sketches.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(load).parquet(path))


def distinct_counts(spark: SparkSession, path: str) -> DataFrame:
    """(column, approx_distinct, rows, nulls) over all stored loads."""
    stored = spark.read.parquet(path)
    return stored.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("approx_distinct"),
                                        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"))


def store_archive_sketches(spark: SparkSession, dataset: str, path: str, files: DataFrame | None = None,
                           columns: list[str] | None = None, lg_k: int = LG_K) -> None:
    """Sketches of an ingested dataset by landed file; only of ``files`` (path) if
    given, whose folders alone are read then."""
    from claimlake.plans.ingest import archive_folder

    rows = spark.read.parquet(dataset)
    columns = columns or [c for c in rows.columns if not c.startswith("_")]
    if files is not None:
        chosen = files.select(archive_folder(F.col("path")).alias("_archive")).distinct()
        names = [r["_archive"] for r in chosen.collect()]  # one name a file of the load
        rows = rows.where(F.col("_archive").isin(names))
    store(column_sketches(rows.select("_archive", *columns), columns, ["_archive"], lg_k), path, "_archive")
