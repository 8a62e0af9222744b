"""Consecutive 0-based row index over a declared order, computed distributed.

``row_number() OVER (ORDER BY ...)`` without a partition moves every row into
one task.  Instead: a range-partitioned global sort, a per-task position
(``monotonically_increasing_id`` is consecutive inside a task), a check-point
so the task assignment is fixed, then each task's offset from a table with
one row per task (its size is bounded by the partition count, so it is
broadcast safely).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlake.session import ensure_checkpoint_dir


def with_row_index(df: DataFrame, order_cols: list, name: str = "row_index") -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    cols = list(df.columns)
    s = (df.orderBy(*order_cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint())
    per_task = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("_pid", "_first",
                              F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = s.join(F.broadcast(offsets), "_pid")
    idx = (F.col("_off") + F.col("_mid") - F.col("_first")).alias(name)
    return out.select(idx, *cols)
