"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to).  A flow network routes token capacity from the patterns to the quotas of
their sources: the first pass over a pattern's tokens is free and each further
repetition costs more (convex costs), so the quotas are met with the fewest
repetitions.  Within a pattern, documents are put in a seeded order (a hash of
the id); all are taken as often as the whole passes of the flow, and those
before a cut point once more, the document at the cut with the part that is left.

Scale: texts are read once, to count words.  A pattern of one source that no other
pattern shares, and there may be any number of those, takes its source's quota,
by joins of small tables; the targets are a few aggregations over the sources.
Only patterns that overlap reach the driver, and their number is checked
(``max_patterns``, beyond which the operator raises).  The cut point of a pattern is found from sums by
leading hash digits (combined map-side) and then inside one such bucket, whose
size the number of digits bounds; no pattern is ever sorted in one task, however
many documents it has.  The cut points are a table of one row a pattern, joined to
the documents by pattern: sent to all tasks while it is small, else by a shuffle
of ids and sizes whose hot patterns AQE splits.

Defined cases: a null text has no words; a null source is a source of its own,
after the others; a document without sources (an empty list) is not taken; ids
that repeat are ordered together and share what a cut leaves; reruns agree.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import WORD, materialise
from claimlake.operators.rowindex import with_row_index

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 7
#: Overlapping patterns that the driver takes: the flow network's size.
MAX_PATTERNS = 20_000
#: Documents of one pattern that share their leading hash digits, about.
BUCKET_ROWS = 10_000


def targets(sizes: dict, weights: dict, total: int, repeats: int = MAX_REPEATS) -> dict:
    """Shares of ``total`` by weight; none above ``repeats`` times its size, the
    excess shared among the rest by weight until none is above."""
    left, weight, capped = total, sum(weights.values()), set()
    for s in sorted(sizes, key=lambda s: repeats * sizes[s] / weights[s]):
        if repeats * sizes[s] * weight < left * weights[s]:
            capped.add(s)
            left -= repeats * sizes[s]
            weight -= weights[s]
    return {s: float(repeats * sizes[s]) if s in capped else float(left) * weights[s] / weight for s in sizes}


def min_cost_flow(patterns: list[tuple[tuple, int]], quotas: dict, repeats: int = MAX_REPEATS) -> list[dict]:
    """Tokens sent from each (sources, size) pattern to each of its sources.

    Repetition k of a pattern costs k for each token, so all first repetitions
    that help are used before any second one.  Levels are opened in order of
    cost and each is saturated by augmenting paths (shortest first): a path may
    move earlier flow between sources, never to a dearer repetition."""
    flow = [dict.fromkeys(sources, 0) for sources, _ in patterns]
    left = dict(quotas)
    of: dict = {}
    for p, (sources, _) in enumerate(patterns):
        for s in sources:
            of.setdefault(s, []).append(p)
    spare = [0] * len(patterns)
    for _ in range(repeats):
        for p, (_, size) in enumerate(patterns):
            spare[p] += size
        for p, (sources, _) in enumerate(patterns):  # direct routes first
            for s in sources:
                sent = min(spare[p], left[s])
                flow[p][s] += sent
                spare[p] -= sent
                left[s] -= sent
        while True:
            came: dict = {("p", p): None for p in range(len(patterns)) if spare[p]}
            queue, end = deque(came), None
            while queue and end is None:
                kind, x = node = queue.popleft()
                steps = [("s", s) for s in patterns[x][0]] if kind == "p" else [("p", p) for p in of[x] if flow[p][x]]
                for step in steps:
                    if step not in came:
                        came[step] = node
                        queue.append(step)
                        if step[0] == "s" and left[step[1]]:
                            end = step
                            break
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()  # pattern, source, pattern, source, ...
            sent = min(spare[path[0][1]], left[end[1]], *(flow[path[k + 1][1]][path[k][1]] for k in range(1, len(path) - 1, 2)))
            spare[path[0][1]] -= sent
            left[end[1]] -= sent
            for k in range(0, len(path) - 1, 2):
                flow[path[k][1]][path[k + 1][1]] += sent
            for k in range(1, len(path) - 1, 2):
                flow[path[k + 1][1]][path[k][1]] -= sent
    return flow


def order_key(doc_id: str | Column, seed: int) -> Column:
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_goals(patterns: DataFrame, weights=WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """``patterns`` (sources, size, rows) -> (source, source_size, target) of every
    source, :func:`targets` as a few aggregations: sources above their limit are set
    aside until the share of the rest, which only grows, is above none."""
    sizes = patterns.select(F.explode("sources").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_row_index(sizes, [F.col("source").isNull(), F.col("source")], "place")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int")).cast("long")
    goals = materialise(ranked.select("source", "source_size", weight.alias("weight")), "mix-sources")
    total = patterns.agg(F.sum("size")).first()[0] or 0
    left, weight_left = total, goals.agg(F.sum("weight")).first()[0] or 1

    def above(left: int, weight_left: int) -> Column:
        return F.expr(f"cast({repeats} * source_size as decimal(38,0)) * {weight_left} < cast({left} as decimal(38,0)) * weight")

    while True:
        size, weight = goals.where(above(left, weight_left)).agg(F.sum("source_size"), F.sum("weight")).first()
        now = total - repeats * (size or 0), goals.agg(F.sum("weight")).first()[0] or 1
        now = now[0], now[1] - (weight or 0)
        if now == (left, weight_left):
            break
        left, weight_left = now
    share = F.lit(float(left)) * F.col("weight") / F.lit(float(max(1, weight_left)))
    target = F.when(above(left, weight_left), (repeats * F.col("source_size")).cast("double")).otherwise(share)
    return materialise(goals.select("source", "source_size", target.alias("target")), "mix-goals")


def plan(docs: DataFrame, weights=WEIGHTS, repeats: int = MAX_REPEATS, seed: int = SEED,
         max_patterns: int = MAX_PATTERNS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``docs`` (doc_id, sources array, size) -> cut points by pattern (whole
    passes, key at the cut, tokens left there and tokens of that key), the tokens
    routed by pattern, and the sizes and targets of the sources.

    A pattern of one source that no other pattern shares takes that source's quota:
    these are routed by a join, however many there are.  Patterns that overlap, and
    those of one source which share it with them, are the flow network, on the driver."""
    spark = docs.sparkSession
    patterns = materialise(docs.groupBy("sources").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")), "mix-patterns")
    goals = source_goals(patterns, weights, repeats)
    shared = patterns.where(F.size("sources") > 1).select(F.explode("sources").alias("s")).distinct()
    first = F.get("sources", F.lit(0))
    single = patterns.where(F.size("sources") == 1).withColumn("first", first)
    meets = single.join(shared, single["first"].eqNullSafe(shared["s"]), "left_semi").drop("first")
    network = patterns.where(F.size("sources") != 1).unionByName(meets).limit(max_patterns + 1).collect()
    if len(network) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns overlap; group the sources first")
    network = sorted(network, key=lambda r: [(s is None, s or "") for s in r["sources"]])
    wanted = spark.createDataFrame([(s,) for s in {s for r in network for s in r["sources"]}], "s string")
    quotas = {r["source"]: round(r["target"]) for r in goals.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("s")), "left_semi").collect()}
    flow = min_cost_flow([(tuple(r["sources"]), r["size"]) for r in network], quotas, repeats)
    passes = [(r["sources"], *(divmod(sum(f.values()), r["size"]) if r["size"] else (0, 0))) for r, f in zip(network, flow, strict=True)]
    alone = single.join(shared, single["first"].eqNullSafe(shared["s"]), "left_anti")
    alone = alone.join(goals, alone["first"].eqNullSafe(goals["source"]))
    quota = F.bround("target", 0).cast("long")
    direct = alone.select("sources", F.when(F.col("size") > 0, F.expr("cast(bround(target, 0) as bigint) div size")).otherwise(0).alias("whole"),
                          F.when(F.col("size") > 0, quota % F.col("size")).otherwise(0).alias("rest"))
    routed = materialise(direct.unionByName(spark.createDataFrame(passes, "sources array<string>, whole long, rest long")), "mix-routed")
    rows = patterns.agg(F.max("rows")).first()[0] or 1
    digits = max(1, min(8, math.ceil(math.log(rows / BUCKET_ROWS + 1, 16))))
    return materialise(_cuts(docs, routed, seed, digits), "mix-cuts"), routed, goals


def _cuts(docs: DataFrame, routed: DataFrame, seed: int, digits: int) -> DataFrame:
    keyed = docs.select("sources", "size", order_key("doc_id", seed).alias("key"))
    bucket = F.substring("key", 1, digits)
    sums = keyed.groupBy("sources", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
    before = F.sum("size").over(Window.partitionBy("sources").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    at = (sums.withColumn("before", F.coalesce(before, F.lit(0))).join(routed, "sources")
          .where("before <= rest and rest < before + size").select("sources", "bucket", "before", "whole", "rest"))
    inside = (keyed.withColumn("bucket", bucket).join(at, ["sources", "bucket"])
              .groupBy("sources", "whole", "rest", "before", "key").agg(F.sum("size").alias("size")))
    earlier = F.sum("size").over(Window.partitionBy("sources").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    return (inside.withColumn("before", F.col("before") + F.coalesce(earlier, F.lit(0)))
            .where("before <= rest and rest < before + size")
            .select("sources", "whole", F.col("key").alias("cut"), (F.col("rest") - F.col("before")).alias("part"), F.col("size").alias("at_cut")))


def take(docs: DataFrame, cuts: DataFrame, seed: int) -> DataFrame:
    """``docs`` (doc_id, sources, size, ...) with ``taken``, the words the mix takes."""
    key = order_key("doc_id", seed)
    more = (F.when(key < F.col("cut"), F.col("size"))
            .when(key == F.col("cut"), F.expr("part * size div at_cut")).otherwise(F.lit(0)))
    return (docs.join(cuts, "sources", "left")  # a row for each pattern
            .withColumn("taken", F.coalesce(F.col("whole") * F.col("size") + more, F.lit(0)).cast("long"))
            .drop("whole", "cut", "part", "at_cut"))


def _sized(docs: DataFrame, id_col: str, text_col: str, sources: Column) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), sources.alias("sources"), word_count(text_col).alias("size"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """One row per document: size, its source's size and target, and the words
    the mix takes.  ``source_col`` is one source or an array of sources; with
    several, size and target are arrays in the order of the sorted list."""
    several = docs.schema[source_col].dataType.typeName() == "array"
    sources = F.array_sort(F.array_distinct(F.coalesce(F.col(source_col), F.array().cast("array<string>")))) if several else F.array(F.col(source_col).cast("string"))
    sized = materialise(_sized(docs, id_col, text_col, sources), "mix")
    cuts, _, goals = plan(sized, weights, repeats, seed)
    taken = take(sized, cuts, seed)
    if several:
        return taken.select("doc_id", "sources", "size", "taken")
    return (taken.withColumn("source", F.get("sources", F.lit(0)))
            .join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
            .select("doc_id", "size", "source_size", "target", "taken"))


def resample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
             repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as the words taken of it
    hold its size, to the nearest (a document at a cut is not torn apart).
    Rows without words, which no quota counts, stay once."""
    sources = F.array(F.col(source_col).cast("string"))
    sized = materialise(_sized(docs, id_col, text_col, sources), "mix")
    cuts, _, _ = plan(sized, weights, repeats, seed)
    key = order_key(F.col("__id"), seed)
    times = F.col("__whole") + F.when(key < F.col("__cut"), 1).when(key == F.col("__cut"), F.round(F.col("__part") / F.col("__at")).cast("int")).otherwise(0)
    renamed = cuts.select(*[F.col(c).alias(n) for c, n in (("sources", "__sources"), ("whole", "__whole"), ("cut", "__cut"), ("part", "__part"), ("at_cut", "__at"))])
    marked = docs.withColumns({"__source": F.col(source_col).cast("string"), "__id": F.col(id_col), "__empty": ~F.coalesce(F.col(text_col).rlike(WORD), F.lit(False))})
    joined = marked.join(renamed, F.col("__source").eqNullSafe(F.get("__sources", F.lit(0))), "left")
    copies = F.when(F.col("__empty"), 1).otherwise(F.coalesce(times, F.lit(0)).cast("int"))
    return (joined.withColumn("__copies", copies).where("__copies > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns))
