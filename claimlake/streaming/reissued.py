"""Incremental ingest that follows archives issued again (ST1).

A file stream remembers paths, so a claims file that its publisher replaces under the same
name is never read again.  Here the landing folder is a stream of files found new
or changed (:class:`claimlake.sources.landed.ClaimFiles`), and a keyed state, one
content digest a path, decides which of them hold something new: a file that was only
touched or copied again is passed over.  What remains goes through the batch
ingest, whose dataset has one folder a landed file and replaces the folders it
writes.  So the rows of an earlier issue are withdrawn as the new ones
appear, a batch that is repeated after a failure writes the same folders again, and the
dataset equals a batch ingest of the landing folder as it stands (files that
were taken away stay ingested).

The state lives in the RocksDB store, one short row a path, and is partitioned by path;
the digests are worked out by the tasks that hold the state.
"""

from __future__ import annotations

import contextlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from claimlake import schemas as S
from claimlake.plans.ingest import TABLE_PREFIXES, archive_folder, ingest
from claimlake.sources import landed
from claimlake.sources.archives import ZIP_GLOB, arrow_fs, scan_zip_csv, storage_options

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGED = "path string, length long, digest string, again boolean"


def content_digest(path: str, storage: dict | None = None, block: int = 1 << 20) -> str | None:
    """Digest of a file's bytes, read in blocks; None if it has gone."""
    import hashlib

    sha = hashlib.sha256()
    fs, p = arrow_fs(path, storage)
    try:
        with fs.open_input_stream(p) as f:
            while part := f.read(block):
                sha.update(part)
    except FileNotFoundError:
        return None
    return sha.hexdigest()


class ContentState(StatefulProcessor):
    """Per path the digest last seen; a row goes out when it changes."""

    def __init__(self, storage: dict | None):
        self.storage = storage

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.digest = handle.getValueState("digest", "digest string")

    def handleInputRows(self, key, rows, timerValues):
        length = 0
        for part in rows:
            length = int(part["length"].iloc[part["version"].argmax()])
        (path,) = key
        new, old = content_digest(path, self.storage), self.digest.get()[0] if self.digest.exists() else None
        if new is not None and new != old:
            self.digest.update((new,))
            yield pd.DataFrame({"path": [path], "length": [length], "digest": [new], "again": [old is not None]})

    def close(self) -> None:
        pass


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def changed_files(spark: SparkSession, landing: str, log: str, glob: str = ZIP_GLOB) -> DataFrame:
    """Streaming (path, length, digest, again): landed files whose content is new."""
    landed.register(spark)
    files = spark.readStream.format("claim_files").options(glob=glob, log=log, **landed.source_options(spark)).load(landing)
    return files.groupBy("path").transformWithStateInPandas(
        statefulProcessor=ContentState(storage_options(spark) or None), outputStructType=CHANGED, outputMode="Update", timeMode="None")


def _withdraw_empty(spark: SparkSession, again: DataFrame, table: str, path: str, multiline: bool, glob: str) -> None:
    """Remove the folders of files that were issued again without a single record."""
    rows = scan_zip_csv(spark, again.select("path", "length"), S.raw_struct(S.TABLES[table]), glob, multiline=multiline)
    empty = again.join(rows.select(F.col("_source_file").alias("path")).distinct(), "path", "left_anti")
    fs, root = arrow_fs(path, storage_options(spark) or None)
    for r in empty.select(archive_folder(F.col("path")).alias("folder")).toLocalIterator():  # one short row a replaced file
        with contextlib.suppress(FileNotFoundError):
            fs.delete_dir(f"{root}/_archive={r.folder}")


def run_reissued_ingest(spark: SparkSession, landing: str, table: str, lake: str, checkpoint: str, glob: str = ZIP_GLOB,
                        multiline: bool = False) -> dict:
    """Bring ``<lake>/<Table_Prefix>/`` up to date with the files under ``landing``;
    returns the numbers of batches, files and rows ingested."""
    done = {"batches": 0, "files": 0, "rows": 0}

    def each(changed: DataFrame, batch_id: int) -> None:
        kept = f"{checkpoint}/changed/{batch_id}"
        changed.write.mode("overwrite").parquet(kept)  # the state is read once
        files = spark.read.schema(CHANGED).parquet(kept)
        n = files.count()
        if not n:
            return
        res = ingest(spark, files.select("path", "length"), table, lake, glob, multiline=multiline)
        again = files.where("again")
        if not again.isEmpty():
            _withdraw_empty(spark, again, table, f"{lake.rstrip('/')}/{TABLE_PREFIXES[table]}", multiline, glob)
        done.update(batches=done["batches"] + 1, files=done["files"] + n, rows=done["rows"] + res.rows)

    with _setting(spark, STORE, ROCKSDB):
        while True:  # a run takes one batch: after a failure the one that failed, as it was
            query = (changed_files(spark, landing, f"{checkpoint}/landed", glob).writeStream.outputMode("update")
                     .option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).foreachBatch(each).start())
            query.awaitTermination()
            if not (query.lastProgress or {}).get("numInputRows"):
                return done
