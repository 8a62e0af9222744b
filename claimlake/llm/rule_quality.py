"""Text quality by a sparse rule ensemble.

Shallow trees are grown on statistics of labelled texts; every path from a root
to a node becomes a conjunctive rule; a logistic model with an L1 penalty over
the rules keeps the few that matter; what is left is compiled into one Spark
column expression, so scoring is a projection over the statistics, without a
shuffle, a model object or Python.

Inputs of a score are statistics of the text alone.  The model is fitted on at
most ``max_rows`` labelled rows, lowest hash of the id first; scoring covers
every row and every text whole.

Defined cases: a null or empty text has all statistics 0 and gets a score like
any other; labels with a null id or class are ignored, repeated ones count as
often as they differ; with no labels, or labels of one class, the score is the
smoothed share of class 1; documents that repeat get equal scores.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import materialise

#: Labelled rows that the fit uses at most.
MAX_ROWS = 20_000
TREES, DEPTH, PENALTY, SEED = 20, 3, 0.002, 11
THRESHOLD = 0.3
STATISTICS = ("log_chars", "upper", "symbol", "digit", "stops", "word_len", "distinct", "repeat", "line_distinct")

Condition = tuple[int, str, float]


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``__stats`` of the statistics of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("__text", text)
    trimmed = F.trim(F.regexp_replace("__text", r"[\x09-\x0D]", " "))
    df = df.withColumns({"__words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " +")),
                         "__lines": F.split("__text", "\n")})
    chars, words = F.greatest(F.length("__text"), F.lit(1)), F.greatest(F.size("__words"), F.lit(1))
    values = {
        "log_chars": F.log1p(F.length("__text").cast("double")),
        "upper": F.regexp_count("__text", F.lit(r"\p{Lu}")) / chars,
        "symbol": F.regexp_count("__text", F.lit(r"[^\p{L}\p{N}\s.,]")) / chars,
        "digit": F.regexp_count("__text", F.lit(r"[0-9]")) / chars,
        "stops": F.regexp_count("__text", F.lit(r"[.,]")) / words,
        "word_len": F.length("__text") / words,
        "distinct": F.size(F.array_distinct("__words")) / words,
        "repeat": F.regexp_count("__text", F.lit(r"(?<!\S)(\S++)(?=\s\1(?!\S))")) / words,
        "line_distinct": F.size(F.array_distinct("__lines")) / F.size("__lines"),
    }
    stats = F.struct(*[F.round(values[k].cast("double"), 9).alias(k) for k in STATISTICS])
    return df.withColumn("__stats", stats).drop("__text", "__words", "__lines")


def paths(tree: str) -> list[tuple[Condition, ...]]:
    """Conjunctions on the way to each inner and outer node of a printed tree."""
    out, stack = [], []
    for line in tree.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.Ee]+)\)", line)
        if found:
            depth = len(found[1])
            stack = [s for s in stack if s[0] < depth]
            stack.append((depth, (int(found[2]), found[3], float(found[4]))))
            out.append(tuple(c for _, c in stack))
    return out


def _simplified(rule: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """One bound a side for each statistic."""
    tight: dict[tuple[int, str], float] = {}
    for f, op, x in rule:
        tight[f, op] = x if (f, op) not in tight else (min if op == "<=" else max)(tight[f, op], x)
    return tuple(sorted((f, op, x) for (f, op), x in tight.items()))


def holds(rule: tuple[Condition, ...], stats: str = "__stats") -> Column:
    """The rule as a boolean column."""
    out = F.lit(True)
    for f, op, x in rule:
        value = F.col(f"{stats}.{STATISTICS[f]}")
        out = out & (value <= x if op == "<=" else value > x)
    return out


class RuleModel:
    """Intercept and weighted rules."""

    def __init__(self, intercept: float, rules: list[tuple[tuple[Condition, ...], float]]):
        self.intercept, self.rules = intercept, rules

    def score(self, stats: str = "__stats") -> Column:
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            margin = margin + F.when(holds(rule, stats), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-margin))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_rows: int) -> DataFrame:
    """(label, statistics) of at most ``max_rows`` labels (doc_id, label)."""
    chosen = (labels.where("doc_id is not null and label is not null").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id")  # max_rows rows of two numbers
    return statistics(joined).select(F.col("label").cast("double").alias("label"), "__stats")


def fit(sample: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = SEED) -> RuleModel:
    """Grow the trees, take their paths as rules, and weigh these by lasso."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    # an exchange, so that the texts are read by all tasks; dealt and sorted by value, so that reruns grow the same trees
    sample = materialise(sample.repartition(8, F.xxhash64("label", "__stats")).sortWithinPartitions("label", "__stats"), "rules")
    n, ones = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    ones = ones or 0
    prior = math.log((ones + 1) / (n - ones + 1))
    if not 0 < ones < n:
        return RuleModel(prior, [])
    stats = sample.select("label", "__stats", *[F.col(f"__stats.{k}") for k in STATISTICS])
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(stats)
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=trees, maxDepth=depth, seed=seed,
                                    featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(vectors)
    rules = list(dict.fromkeys(_simplified(p) for t in forest.trees for p in paths(t.toDebugString)))
    if not rules:
        return RuleModel(prior, [])
    table = stats.select("label", *[holds(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)])
    matrix = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="x").transform(table)
    lasso = LogisticRegression(labelCol="label", featuresCol="x", elasticNetParam=1.0, regParam=penalty, maxIter=60,
                               standardization=False).fit(matrix.select("label", "x"))
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w]
    return RuleModel(float(lasso.intercept), weights)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
          label_col: str = "quality", max_rows: int = MAX_ROWS, **how) -> RuleModel:
    """Fit on the labels of documents that are not held out."""
    known = labels.select(F.col(label_id).alias("doc_id"), F.col(label_col).alias("label")).where(~held_out())
    return fit(labelled_sample(docs, known, id_col, text_col, max_rows), **how)


def scored(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    df = statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text").select("doc_id", "__stats")
    df = df.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return df.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``."""
    # not where(): the optimiser would move the condition below the statistics and
    # work them out again for each rule that names them
    keep = F.explode(F.when(model.score() >= threshold, F.array(F.lit(True))))
    return statistics(docs, text_col).select(*docs.columns, "__stats").select(*docs.columns, keep.alias("__keep")).drop("__keep")
