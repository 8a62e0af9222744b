"""Refitting the cost model from stored sums (ML4, ML5 over a growing lake).

Least squares needs of its rows only sums of products.  These are kept by load, so a refit
after a new load reads the new rows and the stored sums, not the old rows.

What makes it more than a Gram matrix is the string index: the number of a label is its
rank by frequency, which new rows can change.  So the sums are kept by label (products of
numeric inputs, sums of numeric inputs by label, counts by pair of labels), and the
numbers are put in when the model is solved, from the label counts of all rows.
They are kept for training and test rows apart, so R² of both comes from them too.

Sums are added map-side, one small table a task; the columns that are indexed have
few labels (two inputs of L and M labels keep L * M counts).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.plans.model import LABEL, complete, split_label
from claimlake.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS

#: Sums (kind, a, a_label, b, b_label, s): 'level' counts of all rows; 'train' and 'test' sums of products.
SUMS = "kind string, a string, a_label string, b string, b_label string, s double"
ONE = "(one)"


def _numeric(feature_cols: list[str]) -> list[str]:
    return [c for c in feature_cols if not c.endswith("_index")]


def load_sums(features: DataFrame, seed: int = 42, train_fraction: float = 0.7, categoricals: list[str] = CATEGORICAL_COLUMNS,
              feature_cols: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """The sums of the rows of one load."""
    numeric = _numeric(feature_cols)
    labelled = F.col(LABEL).isNotNull() & ~F.isnan(F.col(LABEL).cast("double"))
    kind = F.when(complete(feature_cols) & labelled, split_label(train_fraction, seed))
    rows = features.select(kind.alias("kind"), *[F.col(c).cast("double").alias(f"n{k}") for k, c in enumerate([*numeric, LABEL])],
                           *[F.col(c).cast("string").alias(f"c{k}") for k, c in enumerate(categoricals)])
    names, width = [ONE, *numeric, LABEL], len(numeric) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, float] = defaultdict(float)
        for batch in batches:
            kinds = np.array(batch.column(0).to_pylist(), dtype=object)
            x = np.ones((len(kinds), width + 1))
            for k in range(width):
                x[:, k + 1] = batch.column(1 + k).to_numpy(zero_copy_only=False)
            coded = []
            for k, c in enumerate(categoricals):
                col = batch.column(1 + width + k).dictionary_encode(null_encoding="encode")
                labels = col.dictionary.to_pylist()
                codes = col.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                coded.append((c, labels, codes))
                for label, n in zip(labels, np.bincount(codes, minlength=len(labels)), strict=True):
                    sums["level", c, label, ONE, None] += n
            for which in ("train", "test"):
                mine = kinds == which
                if not mine.any():
                    continue
                z = x[mine]
                gram = z.T @ z
                for i in range(width + 1):
                    for j in range(i, width + 1):
                        sums[which, names[i], None, names[j], None] += gram[i, j]
                for k, (c, labels, codes) in enumerate(coded):
                    by = np.zeros((len(labels), width + 1))
                    np.add.at(by, codes[mine], z)
                    for label, row in zip(labels, by, strict=True):
                        for j in range(width + 1):
                            sums[which, c, label, names[j], None] += row[j]
                    for d, other, their in coded[k + 1:]:
                        pairs = np.bincount(codes[mine] * len(other) + their[mine], minlength=len(labels) * len(other))
                        for p in np.flatnonzero(pairs):
                            sums[which, c, labels[p // len(other)], d, other[p % len(other)]] += pairs[p]
        if sums:
            cols = [pa.array([k[i] for k in sums], pa.string()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(list(sums.values()), pa.float64())], names=["kind", "a", "a_label", "b", "b_label", "s"])

    return rows.mapInArrow(run, SUMS).groupBy("kind", "a", "a_label", "b", "b_label").agg(F.sum("s").alias("s"))


def add_load(features: DataFrame, path: str, load: str, **how) -> None:
    """Store the sums of a load under its name; a load of that name is replaced."""
    (load_sums(features, **how).withColumn("load", F.lit(load)).coalesce(1)
     .write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("load").parquet(path))


@dataclass
class Refit:
    names: list[str]
    coefficients: np.ndarray
    intercept: float
    rows: dict[str, int]
    r2: dict[str, float]
    labels: dict[str, list[str]]  # by column, in order of index


def refit(spark: SparkSession, path: str, categoricals: list[str] = CATEGORICAL_COLUMNS, feature_cols: list[str] = FEATURE_COLUMNS) -> Refit:
    """Solve the model from the sums of all loads (driver work: one square matrix of the inputs)."""
    total = (spark.read.schema(SUMS).parquet(path).groupBy("kind", "a", "a_label", "b", "b_label").agg(F.sum("s").alias("s")).collect())
    sums: dict[str, dict] = defaultdict(lambda: defaultdict(float))
    levels: dict[str, dict] = defaultdict(dict)
    for r in total:
        if r.kind == "level":
            levels[r.a][r.a_label] = r.s
        else:
            sums[r.kind][(r.a, r.a_label), (r.b, r.b_label)] = sums[r.kind][(r.b, r.b_label), (r.a, r.a_label)] = r.s
    labels = {c: sorted((x for x in levels[c] if x is not None), key=lambda x: (-levels[c][x], x)) for c in categoricals}  # noqa: B023
    terms: list[list[tuple]] = [[((ONE, None), 1.0)]]
    for f in feature_cols:
        c = f.removesuffix("_index")
        if f == c:
            terms.append([((f, None), 1.0)])
        else:  # a missing label has the number after the last
            terms.append([((c, x), float(k)) for k, x in enumerate(labels[c])] + ([((c, None), float(len(labels[c])))] if None in levels[c] else []))
    terms.append([((LABEL, None), 1.0)])

    def products(which: str) -> np.ndarray:
        s, n = sums[which], len(terms)
        out = np.zeros((n, n))
        for i in range(n):
            for j in range(i, n):
                if i == j and terms[i] and terms[i][0][0][0] in labels:  # of an indexed input only equal labels meet
                    out[i, j] = sum(w * w * s.get((u, (ONE, None)), 0.0) for u, w in terms[i])
                else:
                    out[i, j] = sum(w * v * s.get((u, t), 0.0) for u, w in terms[i] for t, v in terms[j])
                out[j, i] = out[i, j]
        return out

    def centred(which: str) -> tuple[np.ndarray, np.ndarray, float]:
        g = products(which)
        n = g[0, 0]
        mean = g[0, 1:] / n if n else g[0, 1:]
        return g[1:, 1:] - n * np.outer(mean, mean), mean, n

    s, mean, n = centred("train")
    spread = np.sqrt(np.clip(np.diag(s), 0, None))
    usable = spread[:-1] > 1e-9 * np.abs(mean[:-1]) * np.sqrt(max(n, 1)) + 1e-300  # a constant input gets no weight
    b = np.zeros(len(feature_cols))
    if usable.any():
        at = np.flatnonzero(usable)
        scaled = s[np.ix_(at, at)] / np.outer(spread[at], spread[at])
        b[at] = np.linalg.lstsq(scaled, s[at, -1] / spread[at], rcond=None)[0] / spread[at]
    intercept = float(mean[-1] - mean[:-1] @ b)
    r2 = {}
    for which in ("train", "test"):
        c, m, k = centred(which)
        off = k * (m[-1] - m[:-1] @ b - intercept) ** 2
        r2[which] = float(1 - (c[-1, -1] - 2 * b @ c[:-1, -1] + b @ c[:-1, :-1] @ b + off) / c[-1, -1]) if c[-1, -1] else float("nan")
    return Refit(list(feature_cols), b, intercept, {w: int(sums[w][(ONE, None), (ONE, None)]) for w in ("train", "test")}, r2, labels)
