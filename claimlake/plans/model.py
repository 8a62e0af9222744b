"""Annual-cost model (ML1-ML8, JB7) with Spark ML, fully distributed.

Differences from the original job, all deliberate:
  * one multi-column StringIndexer fit (one pass) instead of one job per column
    fitted twice;
  * the feature table is written once to the shared scratch folder instead of
    being recomputed by every action; nothing stays in the session's cache;
  * the train/test split is an MD5 prefix of the row key and a seed, so it is
    repeatable and does not change when partitions are recomputed after an
    executor loss (``randomSplit`` is offered too);
  * rows that lack an input are neither dropped unseen nor fail the job: they are
    in ``ModelRun.rejected``;
  * scoring keeps every column (``transform``), so there is no collect to the
    driver and no rejoin on the feature vector; de-duplication and casts run
    on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.operators.dedupe import keep_top
from claimlake.schemas import (CATEGORICAL_COLUMNS, DEDUPE_KEYS, FEATURE_COLUMNS,
                               PREDICTIONS)
from claimlake.session import scratch_path

LABEL = "ANNUAL_COST"
SPLIT_BUCKETS = 10_000


def string_indexer(cols: list[str] = CATEGORICAL_COLUMNS) -> StringIndexer:
    """ML1: labels ordered by descending frequency (ties alphabetical); unseen -> extra index."""
    return StringIndexer(inputCols=cols, outputCols=[f"{c}_index" for c in cols],
                         stringOrderType="frequencyDesc", handleInvalid="keep")


def assembler(cols: list[str] = FEATURE_COLUMNS) -> VectorAssembler:
    """ML2: features in fixed order; a row with a missing input is an error."""
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error")


def complete(feature_cols: list[str] = FEATURE_COLUMNS) -> F.Column:
    """No numeric input of the row is null or NaN (indexed ones have a label of their own)."""
    out = F.lit(True)
    for c in feature_cols:
        if not c.endswith("_index"):
            out = out & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return out


# The earlier, smaller model (3 categorical inputs, 7 features).
V1_CATEGORICALS = ["GENDER", "RACE", "STATE"]
V1_FEATURES = ["AGE_YRS", "GENDER_index", "RACE_index", "STATE_index", "DX", "PX", "HCPCS"]


def prepare(features_df: DataFrame, categoricals: list[str] = CATEGORICAL_COLUMNS,
            feature_cols: list[str] = FEATURE_COLUMNS) -> tuple[PipelineModel, DataFrame]:
    """ML7: indexer + assembler fitted on all rows, as the original did; the rows
    that have all inputs, transformed."""
    pm = Pipeline(stages=[string_indexer(categoricals), assembler(feature_cols)]).fit(features_df)
    return pm, pm.transform(features_df.where(complete(feature_cols)))


def split_label(train_fraction: float = 0.7, seed: int = 42,
                key_cols: tuple[str, ...] = ("PATIENT_ID", "AGE_YRS")) -> F.Column:
    """ML3: 'train' / 'test' from an MD5 prefix of seed and row key (one projection, no pass)."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % SPLIT_BUCKETS
    cut = int(round(train_fraction * SPLIT_BUCKETS))
    return F.when(bucket < cut, F.lit("train")).otherwise(F.lit("test"))


def hash_split(df: DataFrame, train_fraction: float = 0.7, seed: int = 42,
               key_cols: tuple[str, ...] = ("PATIENT_ID", "AGE_YRS")) -> tuple[DataFrame, DataFrame]:
    """ML3: deterministic split by a seeded hash of the row key."""
    tagged = df.withColumn("_split", split_label(train_fraction, seed, key_cols))
    return (tagged.where("_split = 'train'").drop("_split"),
            tagged.where("_split = 'test'").drop("_split"))


def random_split(df: DataFrame, train_fraction: float = 0.7, seed: int = 42):
    """ML3 as the original wrote it (seeded here)."""
    return df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)


def fit(train: DataFrame, features_col: str = "features", label: str = LABEL) -> LinearRegressionModel:
    """ML4: ordinary least squares with intercept, no regularisation (normal equations)."""
    return LinearRegression(featuresCol=features_col, labelCol=label).fit(train)


@dataclass
class ModelRun:
    model: LinearRegressionModel
    train: DataFrame
    test: DataFrame
    scored: DataFrame
    rejected: DataFrame  # rows without all inputs, and training rows without a label
    path: str

    def release(self) -> None:
        """Delete the written feature table once the scores are written."""
        from claimlake.sources.archives import arrow_fs
        fs, path = arrow_fs(self.path)
        fs.delete_dir(path)

    def r2(self, which: str = "train") -> float:
        """ML5: R^2 on the training rows (as reported originally) or the test rows."""
        return self.model.evaluate(self.train if which == "train" else self.test.where(F.col(LABEL).isNotNull())).r2


def run(features_df: DataFrame, seed: int = 42, train_fraction: float = 0.7,
        categoricals: list[str] = CATEGORICAL_COLUMNS,
        feature_cols: list[str] = FEATURE_COLUMNS) -> ModelRun:
    """ML1-ML6: index, assemble, split, fit, score the test rows.

    ``categoricals=V1_CATEGORICALS, feature_cols=V1_FEATURES`` gives the earlier model.
    """
    spark = features_df.sparkSession
    path = scratch_path(spark, "features")
    features_df.write.parquet(path)
    base = spark.read.schema(features_df.schema).parquet(path)
    _, assembled = prepare(base, categoricals, feature_cols)
    train, test = hash_split(assembled, train_fraction, seed)
    labelled = F.col(LABEL).isNotNull() & ~F.isnan(F.col(LABEL).cast("double"))
    lost = ~complete(feature_cols) | (~labelled & (split_label(train_fraction, seed) == "train"))
    train = train.where(labelled)
    model = fit(train)
    scored = model.transform(test)  # ML6: all columns kept, no rejoin needed
    return ModelRun(model, train, test, scored, base.where(lost), path)


def vector_text(c: str = "features") -> F.Column:
    """FN18: dense vector -> '[v1,v2,...]' text for the warehouse column."""
    arr = vector_to_array(F.col(c))
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: x.cast("string")), ","), F.lit("]"))


def scored_table(scored: DataFrame) -> DataFrame:
    """ML8: de-duplicate, cast and order columns as the warehouse table expects.

    Per the eight keys the highest prediction is kept; ties keep the lowest
    annual cost.  Counts become 32-bit, the vector becomes text.
    """
    top = keep_top(scored.withColumn("_ftxt", vector_text("features")).drop("features"),
                   DEDUPE_KEYS, "prediction", [LABEL])
    casts = {"DX": "int", "PX": "int", "HCPCS": "int"}
    cols = []
    for name, _ in PREDICTIONS:
        if name == "features":
            cols.append(F.col("_ftxt").alias("features"))
        elif name in casts:
            cols.append(F.col(name).cast(casts[name]).alias(name))
        else:
            cols.append(F.col(name))
    return top.select(*cols)


def annual_cost_predictions(features_df: DataFrame, seed: int = 42) -> DataFrame:
    """JB7: the scored warehouse table, end to end."""
    return scored_table(run(features_df, seed).scored)
