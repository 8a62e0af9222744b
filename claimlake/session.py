"""Session and shared-scratch helpers.

Library functions never create sessions; tests and ``bench.py`` call
:func:`build_session`.  Intermediate files (round-trip fixtures, staged
tables, streaming checkpoints) live under the cluster's shared checkpoint
folder, read from the session.  A private folder is only created when the
session has none configured (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "claimlake", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench: AQE on, UTC, UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CLAIMLAKE_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    # Unset: a private folder, which only the one machine of a local master sees.
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="claimlake-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/claimlake/{tag}-{uuid.uuid4().hex[:12]}"


def suggest_shuffle_partitions(spark: SparkSession, roots: list[str], target_mb: int = 200,
                               expansion: float = 3.0) -> int:
    """A shuffle-partition count for inputs under ``roots``: total file bytes
    (a metadata listing, nothing is read) times an expansion factor for
    decompressed / decoded size, divided by ``target_mb`` per partition; never
    below the cluster's default parallelism.  Opt-in: the caller applies it."""
    import math

    from pyspark.sql import functions as F
    total = 0
    for root in roots:
        listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                   .load(root).select("length"))
        total += listing.agg(F.sum("length")).first()[0] or 0
    want = math.ceil(total * expansion / (target_mb * 1024 * 1024))
    return max(spark.sparkContext.defaultParallelism, want)
