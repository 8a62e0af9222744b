"""Joins (JO1, JO2).

No broadcast hints: with AQE on, Spark re-plans a shuffle join into a
broadcast join only after measuring the materialised side against
``spark.sql.autoBroadcastJoinThreshold``, i.e. broadcasting is always behind
a size check, and skewed partitions of a sort-merge join are split by the
skew-join rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                 how: str = "inner") -> DataFrame:
    """JO1: equi-join on differently named keys; both keys are kept."""
    return left.join(right, left[left_key] == right[right_key], how)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """JO2: join on all common columns, keeping one copy of each.

    Keys compare null-safe (missing equals missing), as a data-frame merge does.
    Equal keys on both sides multiply rows (that is the semantics being kept);
    the scoring path never needs this join - ``transform`` keeps every column.
    """
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("natural join needs at least one common column")
    lk = left.select(*[F.col(c).alias(c) for c in left.columns])
    rk = right.select(*[F.col(c).alias(f"_r_{c}") if c in common else F.col(c) for c in right.columns])
    cond = None
    for c in common:
        e = lk[c].eqNullSafe(rk[f"_r_{c}"])
        cond = e if cond is None else cond & e
    joined = lk.join(rk, cond, how)
    rest = [c for c in right.columns if c not in common]
    return joined.select(*[lk[c] for c in left.columns], *[rk[c] for c in rest])


#: Rows of one key on one side that a task of the split join takes, about; and keys the counting sketch follows.
BLOCK_ROWS, TRACKED, MOST_HEAVY = 1_000_000, 10_000, 1_000


def heavy_keys(df: DataFrame, keys: list[str], least: int, tracked: int = TRACKED) -> dict[int, int]:
    """Hashes of the keys with ``least`` rows or more, with about their rows.  A
    frequent-items sketch, combined map-side, counts them; a key with more than a
    ``tracked``-th of all rows is never missed."""
    found = df.select(F.xxhash64(*keys).alias("h")).agg(F.expr(f"approx_top_k(h, {MOST_HEAVY}, {tracked})").alias("top")).first()
    return {r["item"]: r["count"] for r in (found["top"] or []) if r["item"] is not None and r["count"] >= least}


def natural_join_split(left: DataFrame, right: DataFrame, block_rows: int = BLOCK_ROWS, tracked: int = TRACKED) -> DataFrame:
    """:func:`natural_join` (inner) where a few keys may hold a large part of both sides.

    The rows of a heavy key are dealt into blocks on each side, by a hash of the row,
    and every block of one side meets every block of the other in a task of
    its own; all other keys are joined as they are, in the same join.  A heavy row
    is sent once for each block of the other side, which is less than the rows it
    is joined to by the size of a block.  AQE splits such keys as well, by the files of
    the map tasks; this split does not depend on its settings or on the kind of join."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("natural join needs at least one common column")
    sides = [heavy_keys(df, common, block_rows + 1, tracked) for df in (left, right)]
    blocks = [(h, *[max(1, -(-side.get(h, 0) // block_rows)) for side in sides]) for h in sides[0].keys() | sides[1].keys()]
    if not blocks:
        return natural_join(left, right)
    # at most 2 * MOST_HEAVY rows
    dealt = F.broadcast(left.sparkSession.createDataFrame(blocks, "_h long, _nl long, _nr long"))

    def placed(df: DataFrame, mine: str, other: str, own: str, met: str) -> DataFrame:
        marked = df.withColumn("_h", F.xxhash64(*common)).join(dealt, "_h", "left")
        one = F.lit(1).cast("long")
        mine_, other_ = F.coalesce(mine, one), F.coalesce(other, one)
        marked = marked.withColumn(own, F.pmod(F.xxhash64(F.lit(7), *df.columns), mine_))
        return marked.withColumn(met, F.explode(F.sequence(F.lit(0).cast("long"), other_ - 1))).select(*df.columns, "_bl", "_br")

    joined = natural_join(placed(left, "_nl", "_nr", "_bl", "_br"), placed(right, "_nr", "_nl", "_br", "_bl"))
    return joined.drop("_bl", "_br")
