"""A training corpus from ``documents``: five stages, each of one operator.

1. quality: the rule ensemble scores every text; documents below 0.3 go.
2. near_dedup: of each group of documents linked by SimHash fingerprints (4-word
   shingles, 4 of 64 bits) the one of the smallest id stays.
3. decontaminate: benchmark passages are cut out of the texts; a document of
   which they are more than half goes.
4. mix: the sources are brought to their target weights; a document taken k times
   gives k rows.
5. shard: rows are ordered along a Hilbert curve and cut into 40 shards; adds the
   columns shard and slot.

Each stage reads what the one before it wrote, as Parquet.  Tables beside
``documents`` (labels, benchmark) are read from the input folder; the quality
model is fitted on labelled rows that are not held out, among the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import decontaminate, hilbert, mixture, rule_quality, simhash
from claimlake.llm.common import materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = rule_quality.train(docs, table(spark, sf_dir, "labels"))
    return rule_quality.accepted(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.resample(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hilbert.sharded(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("mix", mix), ("shard", shard)]

#: No SQL: trees and a lasso fit, XXH64 fingerprints, iterated components, an automaton's cuts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, from the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
