"""Sharding along a Hilbert curve through several metadata dimensions.

Each dimension is cut into 2 ** ``bits`` ranges of about equal counts, the cell
of a document is mapped to its index on the Hilbert curve, and the documents are
sorted by that index, then by a hash of the text (equal texts stand together)
and the id.  The order is cut into runs: neighbouring cells share files, so each
file covers a small box of every dimension and readers prune by any of them.

Only DataFrame functions are used.  The curve is a small state machine (an entry
corner and a direction, in tables built from the Gray code), run over the bits
with ``aggregate``.

Scale: only id, size, hashes and the index are sorted, never the texts.  The
sort is a range exchange on a unique key, so no cell, however full, and no group
of equal texts has to fit one task.  Positions need the number of rows in each
partition of the sorted table: it is check-pointed, counted, and the counts (one
a partition) become a literal.

The law is ``rows``: shard k holds positions k N / shards to (k + 1) N / shards,
so counts differ by one at most.

Defined cases: null values of a dimension come first; a null text has no bytes;
repeated rows stand together; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import body
from claimlake.session import ensure_checkpoint_dir

SHARDS, BITS = 40, 5
#: Bytes counted for a document besides its text.
OVERHEAD = 16


def curve(dims: int) -> tuple[list[int], list[int]]:
    """Tables of the state machine: at state * 2^dims + corner, the rank of the
    corner on the curve and the next state; a state is entry * dims + direction."""
    n, mask = dims, (1 << dims) - 1

    def rotate(x: int, by: int) -> int:
        by %= n
        return (x << by | x >> (n - by)) & mask

    def trailing_ones(x: int) -> int:
        return (~x & x + 1).bit_length() - 1

    def gray(x: int) -> int:
        return x ^ x >> 1

    def entry(w: int) -> int:
        return gray(2 * ((w - 1) // 2)) if w else 0

    def direction(w: int) -> int:
        return 0 if w == 0 else trailing_ones(w) % n if w % 2 else trailing_ones(w - 1) % n

    rank_of = {gray(w): w for w in range(1 << n)}
    ranks, states = [], []
    for e in range(1 << n):
        for d in range(n):
            for corner in range(1 << n):
                w = rank_of[rotate(corner ^ e, -(d + 1))]
                ranks.append(w)
                states.append((e ^ rotate(entry(w), d + 1)) * n + (d + direction(w) + 1) % n)
    return ranks, states


def _longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index on the curve of a point with coordinates 0 to 2^bits - 1."""
    n = len(cells)
    ranks, states = map(_longs, curve(n))

    def step(acc: Column, bit: Column) -> Column:
        corner = sum((F.call_function("shiftright", c.cast("long"), bit).bitwiseAND(F.lit(1)) * (1 << k) for k, c in enumerate(cells)), F.lit(0))
        at = (acc["state"] * (1 << n) + corner).cast("int")
        return F.struct((acc["index"] * (1 << n) + F.get(ranks, at)).alias("index"), F.get(states, at).alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).cast("long").alias("state"))
    return F.aggregate(F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)]), start, step, lambda acc: acc["index"])


def _is_text(docs: DataFrame, col: str) -> bool:
    return docs.schema[col].dataType.typeName() in ("string", "binary")


def text_cuts(docs: DataFrame, col: str, cells: int) -> list:
    """The first value of each cell of a text column: cells hold about equal numbers
    of rows, and a value is in one of them.  Values are counted map-side, sorted by
    range, and compared whole; a running count inside each range and the ranges' sums
    (one row each) give a value's place among all rows."""
    counted = docs.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.repartitionByRange("v").sortWithinPartitions("v").withColumn("p", F.spark_partition_id()).checkpoint()
    sums = dict(ordered.groupBy("p").agg(F.sum("n")).collect())
    parts = sorted(sums)
    starts = dict(zip(parts, accumulate([0, *(sums[p] for p in parts)]), strict=False))
    total = sum(sums.values())
    if not total:
        return []
    before = F.sum("n").over(Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, -1))
    start = F.get(_longs([starts.get(p, 0) for p in range(max(parts) + 1)]), F.col("p"))
    place = ordered.select("v", (start + F.coalesce(before, F.lit(0))).alias("at"))
    firsts = place.groupBy(F.expr(f"at * {cells}L div {total}L").alias("cell")).agg(F.min("v").alias("v"))
    return sorted(r["v"] for r in firsts.select("v").collect())  # at most ``cells`` rows


def _count_in(points: Column, holds) -> Column:
    return F.size(F.filter(points, holds))  # a function of one argument: of two, the second would be the place


def quantised(docs: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """Cell of each dimension: the number of cut points below a number, or of first
    values at or below a text but one; missing values are in cell 0."""
    numbers = [c for c in dims if not _is_text(docs, c)]
    cuts = [(k + 1) / (1 << bits) for k in range((1 << bits) - 1)]
    row = docs.agg(*[F.percentile_approx(F.col(c).cast("double"), cuts, 1_000).alias(f"d{k}") for k, c in enumerate(numbers)]).first() if numbers else None
    out = []
    for c in dims:
        if c in numbers:
            points = sorted(set(row[f"d{numbers.index(c)}"] or ()))
            held, value = F.array(*[F.lit(float(x)) for x in points]).cast("array<double>"), F.col(c).cast("double")
            cell = _count_in(held, lambda p: p < value)  # noqa: B023  used at once
        else:
            points = text_cuts(docs, c, 1 << bits)
            held, value = F.array(*[F.lit(x) for x in points]).cast(f"array<{docs.schema[c].dataType.simpleString()}>"), F.col(c)
            cell = F.greatest(_count_in(held, lambda p: p <= value) - 1, F.lit(0))  # noqa: B023
        out.append(F.when(value.isNotNull(), cell).otherwise(0))
    return out


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), body(text_col))


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = ("lang", "source"),
           shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.  The curve's
    dimensions are ``dims`` and the size of the text."""
    ensure_checkpoint_dir(docs.sparkSession)
    text = body(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.length(text) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
                       _row_key(id_col, text_col).alias("row_key"),
                       *[F.col(c).alias(f"dim{k}") for k, c in enumerate(dims)])
    names = ["size", *[f"dim{k}" for k in range(len(dims))]]
    rows = rows.withColumn("at", hilbert_index(quantised(rows, names, bits), bits))
    order = ["at", "text_hash", "doc_id", "size"]
    kept = ["doc_id", "size", "text_crc32", "text_hash", "row_key", "at"]
    ordered = rows.select(*kept).repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    counts = dict(ordered.groupBy(F.spark_partition_id().alias("p")).count().collect())  # one row a partition
    starts = [0, *accumulate(counts.get(p, 0) for p in range(max(counts, default=-1) + 1))]
    total = starts[-1]
    place = F.monotonically_increasing_id()  # partition and place in it, as check-pointed
    position = F.get(_longs(starts), F.shiftright(place, 33).cast("int")) + place.bitwiseAND(F.lit((1 << 33) - 1))
    placed = ordered.withColumn("position", position).withColumn("shard", F.floor(F.expr(f"position * {shards} div {max(1, total)}")).cast("int"))
    return placed.withColumn("slot", F.expr(f"position - (shard * {total}L + {shards - 1}) div {shards}")).drop("position")


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the columns shard and slot (replacing any of these names).
    Repeated rows share a key and take its places one by one."""
    placed = (assign(docs, id_col, text_col, **how).groupBy(F.col("row_key").alias("__key"))
              .agg(F.sort_array(F.collect_list(F.struct("shard", "slot"))).alias("__places")))
    marked = docs.drop("shard", "slot").withColumn("__key", _row_key(id_col, text_col))
    joined = marked.join(placed, "__key")
    copy = F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(0)))
    place = F.get("__places", F.col("__copy") - 1)
    return (joined.withColumn("__copy", copy)
            .select(*marked.drop("__key").columns, place["shard"].alias("shard"), place["slot"].alias("slot")))
