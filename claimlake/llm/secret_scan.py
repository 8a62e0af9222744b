"""Secrets: fixed patterns, and character Markov models for the rest.

Two first-order Markov models over characters, one of random strings and one of
ordinary identifiers, are trained by counting character pairs in labelled
samples.  A candidate token is a secret if the log-likelihood ratio of the two
models over its pairs reaches ``margin``.

Only DataFrame functions are used.  One pass over the texts finds the pattern
matches and the candidate tokens with their positions and writes that short
table; training and scoring read the table, never the texts again.

Positions come from cutting the text at the matches: a match starts after all
earlier gaps and matches, counted in code points.

Samples: ``labelled`` (value, random boolean) if given; else labels by rule: random are the
values of all pattern matches and ``GENERATED`` digests, ordinary are the words
of 8 to 19 letters of all documents, each different value once.  The trained table has one
entry a pair of characters (65 * 65) and becomes a literal.

Scale: no shuffle of texts, only of distinct words, combined map-side; documents are
judged alone, in work that grows with the length of the text and the number of matches.

Defined cases: a null or empty text has no spans; offsets are code points, end
exclusive; repeated rows give repeated results; other columns are not read; with
empty tables the model is trained on the generated samples alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import materialise

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "markov")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # greedy, so the same as dropping matches of fewer than 18 characters
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"(?<![A-Za-z])[A-Za-z]{8,19}(?![A-Za-z])"  # shorter than a candidate
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
GENERATED = 1_000
MARGIN = 10.0
HUNDRED = 128
#: Weight of the back-off, in pairs seen.
BACK_OFF = 5.0
_N = len(ALPHABET) + 1  # the last class: every other character


def _placed(df: DataFrame, text: str, found: dict[str, str]) -> DataFrame:
    """``df`` with, for each name of ``found`` (name, pattern), an array of (start,
    end, value) of its matches instead of the text.

    A fold that carries its result copies it at each step, so places are prefix sums in two
    levels: of hundreds of matches, and inside a hundred.  Each step is a column
    of its own that the next one names more than once, so it is worked out once."""
    keep = [c for c in df.columns if c != text]
    zero = F.lit(0)

    def total(numbers: Column) -> Column:
        return F.aggregate(numbers, zero, lambda x, y: x + y)

    def hundreds(k: str) -> Column:
        a = F.col(f"{k}_a")
        return F.when(F.size(a) > 0, F.transform(F.sequence(zero, F.floor((F.size(a) - 1) / HUNDRED).cast("int")),
                                                 lambda c: total(F.slice(a, c * HUNDRED + 1, F.lit(HUNDRED))))).otherwise(F.array().cast("array<int>"))

    def before(k: str) -> Column:
        grown = F.aggregate(f"{k}_h", F.struct(zero.alias("at"), F.array().cast("array<int>").alias("out")),
                            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))
        return grown["out"]

    def spans(k: str) -> Column:
        a, g, v, p = (F.col(f"{k}_{x}") for x in "agvp")

        def span(value: Column, i: Column) -> Column:
            block = F.floor(i / HUNDRED).cast("int")
            start = F.get(p, block) + total(F.slice(a, block * HUNDRED + 1, i - block * HUNDRED)) + F.get(g, i)
            return F.struct(start.alias("start"), (start + F.get(v, i)).alias("end"), value.alias("value"))

        return F.when(F.size(p) > 0, F.transform(k, span)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))

    df = df.select(*keep, text, *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(k) for k, p in found.items()])
    names = [*keep, *found]
    gaps = [F.transform(F.slice(F.split(F.col(text), p, -1), F.lit(1), F.size(k)), F.length).alias(f"{k}_g") for k, p in found.items()]
    df = df.select(*names, *gaps, *[F.transform(k, F.length).alias(f"{k}_v") for k in found])
    names += [f"{k}_{x}" for k in found for x in "gv"]
    df = df.select(*names, *[F.zip_with(f"{k}_g", f"{k}_v", lambda g, v: g + v).alias(f"{k}_a") for k in found])
    names += [f"{k}_a" for k in found]
    df = df.select(*names, *[hundreds(k).alias(f"{k}_h") for k in found])
    df = df.select(*names, *[before(k).alias(f"{k}_p") for k in found])
    return df.select(*keep, *[spans(k).alias(k) for k in found])


def _kind(spans: Column, no: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("no"), s["end"].alias("end"), s["value"].alias("value")))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["no"]), s["start"], s["end"])), ",")


def patterns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, base, candidates, assigned): placed pattern matches, candidate tokens, places of assignments."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "candidate": CANDIDATE}
    df = _placed(df, "text", found)
    assign = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 12)
    df = df.select("doc_id", assign.alias("assign"), "access", "hex", "candidate")
    base = F.concat(_kind(F.col("assign"), 0), _kind(F.col("access"), 1), _kind(F.col("hex"), 2))
    return df.select("doc_id", base.alias("base"), _kind(F.col("candidate"), 3).alias("candidates"),
                     F.transform("assign", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("assigned"))


def samples(found: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(value, random): the distinct values of all matches and generated digests,
    and the distinct words of all documents."""
    secret = F.when(F.col("s.no") == 0, F.regexp_extract("s.value", ASSIGN, 2)).otherwise(F.col("s.value"))
    random = found.select(F.explode("base").alias("s")).select(secret.alias("value")).distinct()
    ordinary = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(text_col, F.lit(ORDINARY), F.lit(0)))).alias("value")).distinct()
    digest = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    made = found.sparkSession.range(0, GENERATED, 1, 1).select(F.explode(F.array(F.base64(digest), F.md5(F.col("id").cast("string")))).alias("value"))
    words = found.sparkSession.createDataFrame([(w,) for w in ("configuration", "description", "identifier", "documentation_page",
                                                               "international", "connection_timeout", "the_quick_brown_fox")], "value string")
    return (random.unionByName(made).withColumn("random", F.lit(True))
            .unionByName(ordinary.unionByName(words).withColumn("random", F.lit(False))))


def _code(char: Column) -> Column:
    """0 for other characters, else the place in the alphabet."""
    return F.position(char, F.lit(ALPHABET))


def _pairs(value: str | Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    codes = F.transform(F.split(value, ""), _code)  # each character once
    n = F.greatest(F.length(value) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n), lambda a, b: a * _N + b)


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of characters, random against ordinary.
    Pair probabilities are backed off to those of the second character alone.
    The counts are at most 2 * 65 * 65 rows."""
    rows = labelled.select("random", F.explode(_pairs("value")).alias("pair")).groupBy("random", "pair").count().collect()
    counts = {kind: [0] * (_N * _N) for kind in (True, False)}
    for r in rows:
        counts[r["random"]][r["pair"]] += r["count"]
    logs = {}
    for kind, c in counts.items():
        alone = [(sum(c[k::_N]) + 0.5) / (sum(c) + 0.5 * _N) for k in range(_N)]
        totals = [sum(c[k * _N:(k + 1) * _N]) for k in range(_N)]
        logs[kind] = [math.log((x + BACK_OFF * alone[k % _N]) / (totals[k // _N] + BACK_OFF)) for k, x in enumerate(c)]
    return [a - b for a, b in zip(logs[True], logs[False], strict=True)]


def ratio(value: str | Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string under a trained model."""
    weights = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    return F.aggregate(_pairs(value), F.lit(0.0), lambda acc, k: acc + F.get(weights, k))


def _free(c: Column) -> Column:
    """Whether a candidate touches no pattern span.  Access keys and hex runs lie whole
    in the candidate that they touch, so its value tells; assignments are looked up by place."""
    assigned = F.exists("assigned", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    return ~c["value"].rlike(HEX) & ~c["value"].rlike(ACCESS) & ~assigned


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None,
         margin: float = MARGIN) -> DataFrame:
    """One row per document: counts and digest of the pattern spans, all spans."""
    found = materialise(patterns(docs, id_col, text_col), "secrets")
    model = train(labelled if labelled is not None else samples(found, docs, text_col))
    added = F.filter("candidates", lambda c: _free(c) & (ratio(c["value"], model) >= margin))
    spans = found.select("doc_id", "base", added.alias("added"))
    return spans.select("doc_id", *[_count(no).alias(f"n_{k}") for no, k in enumerate(BASE_KINDS)],
                        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.concat("base", "added")).alias("spans"))


def _count(no: int) -> Column:
    return F.size(F.filter("base", lambda s: s["no"] == no)).cast("long")
