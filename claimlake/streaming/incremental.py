"""Incremental ingestion of newly landed files (ST1) with Structured Streaming.

The original re-read every file under a prefix on a timer.  Here a file
stream over the landing folder is run with ``trigger(availableNow=True)``:
each run processes exactly the files that arrived since the last run (the
checkpoint remembers which were seen), then stops, so a scheduler can start
it like a batch job.  The Parquet file sink commits every micro-batch to its
own metadata log, so a batch that is retried after a failure is not written
twice, and readers of the target only see committed files.  For the same reason a
target that holds files of another writer is refused: the sink's log would hide
them from readers.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from claimlake.sources.archives import ZIP_GLOB


def _listed(spark: SparkSession, path: str) -> DataFrame | None:
    """The files under a folder, seen as Spark sees it, or None if there is no such folder."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return None
        raise


def _checked_target(spark: SparkSession, target: str) -> None:
    """Raise if ``target`` holds data files but no log of a streaming sink."""
    files = _listed(spark, target)
    if files is not None and _listed(spark, f"{target}/_spark_metadata") is None and not files.isEmpty():
        raise ValueError(f"{target} holds files that no stream wrote; stream into a folder of its own")


class _Progress(StreamingQueryListener):
    """Input rows of each batch of each run, however many there are."""

    def __init__(self):
        self.rows: dict[str, dict[int, int]] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if p.numInputRows:
            self.rows.setdefault(str(p.runId), {})[p.batchId] = p.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()


def _finish(spark: SparkSession, writer) -> dict:
    """Run a query to its end; its batches and rows, counted batch by batch
    (``recentProgress`` keeps only the last hundred)."""
    seen = _Progress()
    spark.streams.addListener(seen)
    try:
        query = writer.start()
        query.awaitTermination()
        run = str(query.runId)
        with seen.changed:  # the listener hears of the end after all batches
            seen.changed.wait_for(lambda: run in seen.ended, timeout=60)
    finally:
        spark.streams.removeListener(seen)
    batches = seen.rows.get(run, {})
    return {"batches": len(batches), "rows": sum(batches.values())}


def run_incremental(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                    checkpoint: str, fmt: str = "parquet", max_files_per_trigger: int | None = None,
                    transform=None) -> dict:
    """Process every not-yet-seen file under ``landing`` into ``target``; return progress."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream: DataFrame = reader.load(landing)
    if transform is not None:
        stream = transform(stream)
    _checked_target(spark, target)
    return _finish(spark, _sink(stream, target, checkpoint))


def _sink(stream: DataFrame, target: str, checkpoint: str):
    return (stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True))


def run_archive_ingest(spark: SparkSession, landing: str, table: str, target: str, checkpoint: str,
                       glob: str = ZIP_GLOB, max_files_per_trigger: int | None = None) -> dict:
    """Incremental ingest of newly landed claim archives into ``target`` (ST1 on raw files).

    A streaming listing of the landing folder (content never read) feeds the
    same record reader, JVM parsing and typing as the batch ingest; every
    archive is ingested exactly once across runs.
    """
    from claimlake import schemas as S
    from claimlake.plans.ingest import type_raw
    from claimlake.sources.archives import archive_records, parse_records

    binary_schema = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    reader = spark.readStream.format("binaryFile").schema(binary_schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    listing = reader.load(landing).select("path", "length")
    cols = [n for n, _ in S.TABLES[table]]
    typed = type_raw(parse_records(archive_records(listing, cols), cols), table)
    _checked_target(spark, target)
    return _finish(spark, _sink(typed, target, checkpoint))


def run_record_ingest(spark: SparkSession, landing: str, table: str, target: str, checkpoint: str, glob: str = ZIP_GLOB, **options) -> dict:
    """:func:`run_archive_ingest` through the data source ``claim_records``: the stream
    reads the files itself, in the partitions that it plans."""
    from claimlake import schemas as S
    from claimlake.plans.ingest import type_raw
    from claimlake.sources.landed import read_records

    _checked_target(spark, target)
    done = {"batches": 0, "rows": 0}
    while True:  # a run takes one batch: after a failure the one that failed, as it was
        rows = read_records(spark, landing, [n for n, _ in S.TABLES[table]], stream=True, glob=glob, log=f"{checkpoint}/landed", **options)
        run = _finish(spark, _sink(type_raw(rows, table), target, f"{checkpoint}/stream"))
        done = {k: v + run[k] for k, v in done.items()}
        if not run["rows"]:
            return done
