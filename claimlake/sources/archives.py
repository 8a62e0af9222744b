"""Claim-file scans (SC3): ZIP-archived and plain CSV, every value kept as text.

The binary-file source lists the files (their ``content`` is never read) and the
listing stays a DataFrame.  A task opens its files through the Arrow filesystem
layer (local, HDFS or object-store URIs; the session's object-store settings
are handed on to it), and sends on blocks of whole lines
of about ``BLOCK_BYTES``, so its memory is bounded by a block, not by the file.
An archive is not splittable and is read by one task, its first member only; a
plain file is read in byte ranges of ``RANGE_BYTES``.  The blocks are rebalanced
over evenly sized tasks, which split the lines and parse them with the JVM CSV
parser.  The plan is the same for any number and size of files.

A record is a line, unless ``multiline`` is set: then line feeds inside quotes
belong to the record.  Where a range of a plain file starts, inside or outside of
quotes, depends on all quotes before it, so a first pass counts the quotes of
each range, and a prefix sum over the ranges of a file (one small row each) tells
each range its start state; then all ranges are cut at the same time.  A file whose quotes do not
balance is read line by line, so that one stray quote does not swallow the rest.

A line that does not parse into the columns of its file's
header (a stray quote, too few or too many fields) keeps what could be read, and
its text in ``_corrupt_record``, and never touches its neighbours.  Headers are
matched without regard to case and order; a missing column fails the scan.  A
corrupt archive fails its task visibly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.sources.files import CORRUPT_COLUMN, RAW_ENCODING

BLOCK_BYTES, RANGE_BYTES = 1 << 20, 128 << 20
#: Blocks of a file that are dealt together where a write has a folder a file: some 8 MB of text.
CHUNK_BLOCKS = 8
#: Text that a task of such a write gets on average, and how much text an archive's byte holds at most, about.
TASK_BYTES, ARCHIVE_RATIO = 64 << 20, 8
#: A record may not be longer than this; two stray quotes far apart could make one of all between them.
MAX_RECORD_BYTES = 64 << 20
ZIP_GLOB, CSV_GLOB = "*.[zZ][iI][pP]", "*.[cC][sS][vV]"


def arrow_uri(path: str) -> str:
    """A Spark/Hadoop path as an Arrow filesystem URI (file:/x, s3a://, plain paths)."""
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    if path.startswith("s3a://") or path.startswith("s3n://"):
        return "s3://" + path[6:]
    if "://" not in path:
        return "file://" + path
    return path


#: Settings of the object store that Spark uses, and what the Arrow filesystem calls them.
STORE_SETTINGS = {"access.key": "access_key", "secret.key": "secret_key", "session.token": "session_token",
                  "endpoint": "endpoint_override", "endpoint.region": "region"}


def storage_options(spark: SparkSession) -> dict[str, str]:
    """The session's object-store settings (``spark.hadoop.fs.s3a.*``), for :func:`arrow_fs` in tasks."""
    found = {ours: spark.conf.get(f"spark.hadoop.fs.s3a.{theirs}", None) for theirs, ours in STORE_SETTINGS.items()}
    return {k: v for k, v in found.items() if v}


def arrow_fs(path: str, storage: dict[str, str] | None = None):
    """(filesystem, path) for reading or writing ``path`` from a Python task or the
    driver; ``storage`` are credentials and the like of an object store."""
    import pyarrow.fs as pafs

    uri = arrow_uri(path)
    if storage and uri.startswith("s3://"):
        return pafs.S3FileSystem(**storage), uri.removeprefix("s3://")
    return pafs.FileSystem.from_uri(uri)


def list_archives(spark: SparkSession, root: str | list[str], glob: str = ZIP_GLOB) -> DataFrame:
    """(path, length) of the files under ``root`` (or the given list of files) matching ``glob``."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.load(root if isinstance(root, str) else list(root)).select("path", "length")


def member_names(listing: DataFrame) -> DataFrame:
    """(path, member): name of the first member of each archive of ``listing.path``
    (only the archives' directories are read)."""
    def read(batches):
        import zipfile

        import pandas as pd

        for batch in batches:
            names = []
            for path in batch["path"]:
                fs, p = arrow_fs(path)
                with fs.open_input_file(p) as fh, zipfile.ZipFile(fh) as zf:
                    names.append(next(iter(zf.namelist()), None))
            yield pd.DataFrame({"path": batch["path"], "member": names})

    return listing.select("path").mapInPandas(read, "path string, member string")


def _blocks(stream, size: int, end: int | None = None):
    """Blocks of the whole lines that start before byte ``end`` of a stream."""
    at = stream.tell()
    while end is None or at < end:
        part = stream.read(size if end is None else min(size, end - at))
        if not part:
            return
        if not part.endswith(b"\n"):
            part += stream.readline()
        at += len(part)
        yield part


def _skip_to_line(stream, start: int) -> None:
    """To the first line that starts at or after byte ``start``."""
    stream.seek(start - 1)
    if stream.read(1) != b"\n":
        stream.readline()


def source_key(path: Column) -> Column:
    """A file's path in one spelling, whatever scheme it was listed by."""
    return F.regexp_replace(F.regexp_replace(path, "^file:/+", "/"), "^s3[an]:", "s3:")


def _cut_records(stream, size: int, start: int, end: int | None, inside: bool, whole: bool) -> Iterator[list[bytes]]:
    """Records that start in the bytes from ``start`` to ``end`` of a stream which
    stands at ``start``, in lists of some ``size`` bytes.  ``inside``: ``start`` is
    inside quotes; ``whole``: a record starts there."""
    import numpy as np

    held, at = b"", start  # held: bytes from place ``at`` on, from the start of a record once ``whole``
    while True:
        part = stream.read(size)
        data = np.frombuffer(held + part, np.uint8)
        quoted = (np.cumsum(data == 34) + inside) & 1
        ends = np.flatnonzero((data == 10) & (quoted == 0)) + 1
        if not whole:
            if not len(ends) and part:
                inside, at = bool(quoted[-1]) if len(data) else inside, at + len(data)
                held = b""
                if end is not None and at >= end:
                    return
                continue
            if not len(ends):
                return
            first, ends = int(ends[0]), ends[1:] - ends[0]
            data, held, at, whole, inside = data[first:], b"", at + first, True, False
        text = data.tobytes()
        out, begin = [], 0
        for stop in ([*ends.tolist(), len(text)] if not part and len(text) else ends.tolist()):
            if end is not None and at + begin >= end:
                break
            if stop > begin:
                out.append(text[begin:stop].rstrip(b"\r\n"))
            begin = stop
        if out:
            yield out
        held, at = text[begin:], at + begin
        if not part or (end is not None and at >= end):
            return
        if len(held) > MAX_RECORD_BYTES:
            raise ValueError(f"a record of over {MAX_RECORD_BYTES} bytes starts at byte {at}")


def _odd_quotes(stream, size: int, end: int | None = None) -> bool:
    """Whether a stream holds an odd number of quotes up to byte ``end``."""
    odd, at = 0, stream.tell()
    while end is None or at < end:
        part = stream.read(size if end is None else min(size, end - at))
        if not part:
            break
        odd, at = odd ^ (part.count(b'"') & 1), at + len(part)
    return bool(odd)


def _in_order(record: str, width: int, places: list[int], n_columns: int) -> str:
    """A record of a file with another header, its fields in the order of the
    table; one of the wrong length is made too long for any table, so that
    the parser reports it."""
    import csv
    import io

    try:
        fields = next(csv.reader([record]), [])
    except csv.Error:
        fields = []
    if len(fields) != width or record.count('"') % 2:
        return record + "," * (n_columns + width)
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow([fields[k] for k in places])
    return out.getvalue()


class _Opened:
    """The stream of a landed file: a plain file, or the first member of an archive."""

    def __init__(self, path: str, size: int, storage: dict[str, str] | None = None):
        self.path, self.size, self.storage = path, size, storage

    def __enter__(self):
        import contextlib
        import io
        import zipfile

        self._stack = contextlib.ExitStack()
        fs, p = arrow_fs(self.path, self.storage)
        fh = self._stack.enter_context(fs.open_input_file(p))
        if not is_archive(self.path):
            return self._stack.enter_context(io.BufferedReader(fh, self.size)), self.path.rsplit("/", 1)[-1]
        zf = self._stack.enter_context(zipfile.ZipFile(fh))
        member = zf.namelist()[0]
        return self._stack.enter_context(zf.open(member)), member

    def __exit__(self, *exc):
        return self._stack.__exit__(*exc)


def _ranges(listing: DataFrame, range_bytes: int) -> DataFrame:
    """(path, start): an archive is one range, a plain file as many as its length asks for."""
    zero = F.lit(0).cast("long")
    ranges = F.when(F.lower("path").endswith(".zip"), F.array(zero)).otherwise(
        F.sequence(zero, F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    return listing.select("path", F.explode(ranges).alias("start"))


def is_archive(path: str) -> bool:
    return path.lower().endswith(".zip")


@dataclass(frozen=True)
class RecordReader:
    """Reads the records of a range of a landed file, inside a task."""

    columns: tuple[str, ...]
    encoding: str = RAW_ENCODING
    block_bytes: int = BLOCK_BYTES
    range_bytes: int = RANGE_BYTES
    multiline: bool = False
    storage: dict[str, str] | None = None

    def end_of(self, path: str, start: int) -> int | None:
        return None if is_archive(path) else start + self.range_bytes

    def odd_quotes(self, path: str, start: int = 0, whole: bool = False) -> bool:
        with _Opened(path, self.block_bytes, self.storage) as (stream, _):
            if start:
                stream.seek(start)
            return _odd_quotes(stream, self.block_bytes, None if whole else self.end_of(path, start))

    def _layout(self, first: bytes) -> list[str]:
        import csv
        text = first.decode(self.encoding).strip("\r\n").removeprefix("\ufeff").removeprefix("\u00ef\u00bb\u00bf")
        header = [c.strip().lower() for c in next(csv.reader([text]), [])]
        missing = [c for c in self.columns if c.lower() not in header]
        if missing:
            raise ValueError(f"columns missing in the header: {missing[:5]}")
        return header

    def _parts(self, stream, start: int, end: int | None, inside: bool, records: bool):
        """Lists of records as bytes, or blocks of whole lines."""
        if not records:
            if start:
                _skip_to_line(stream, start)
            yield from _blocks(stream, self.block_bytes, end)
            return
        whole = True
        if start:
            stream.seek(start - 1)
            whole = stream.read(1) == b"\n" and not inside
        yield from _cut_records(stream, self.block_bytes, stream.tell(), end, inside and start > 0, whole)

    def read(self, path: str, start: int, inside: bool, balanced: bool | None) -> Iterator[tuple[str | None, list[str] | None, str]]:
        """(block of lines or none, records or none, member).  Where ``balanced`` is
        not known the quotes of the file are counted first."""
        wanted = [c.lower() for c in self.columns]
        records = self.multiline and (not self.odd_quotes(path, whole=True) if balanced is None else balanced)
        with _Opened(path, self.block_bytes, self.storage) as (stream, member):
            first = stream.readline()
            if not first:
                return
            header = self._layout(first)
            places = [header.index(c) for c in wanted]
            for part in self._parts(stream, start, self.end_of(path, start), inside, records):
                if not records and header == wanted:
                    yield part.decode(self.encoding), None, member
                    continue
                rows = [r.decode(self.encoding) for r in part] if records else part.decode(self.encoding).split("\n")
                if header != wanted:
                    rows = [_in_order(r.rstrip("\r"), len(header), places, len(wanted)) for r in rows if r.strip("\r")]
                yield None, rows, member


def quote_states(ranges: DataFrame, reader: RecordReader) -> DataFrame:
    """(path, start, inside, balanced): whether a range starts inside quotes, and
    whether the quotes of its file balance; a prefix XOR over the ranges of a file."""
    def count(batches):
        import pandas as pd

        for batch in batches:
            odd = [int(reader.odd_quotes(path, int(start))) for path, start in zip(batch["path"], batch["start"], strict=True)]
            yield pd.DataFrame({"path": batch["path"], "start": batch["start"], "odd": odd})

    counted = ranges.mapInPandas(count, "path string, start long, odd int")
    of_file = Window.partitionBy("path")
    before = of_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("path", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"),
                          (F.sum("odd").over(of_file) % 2 == 0).alias("balanced"))


def archive_records(listing: DataFrame, columns: list[str], encoding: str = RAW_ENCODING, block_bytes: int = BLOCK_BYTES,
                    range_bytes: int = RANGE_BYTES, multiline: bool = False, by_file: bool = False) -> DataFrame:
    """(line, _source_file, _member) of the files named in ``listing`` (path,
    length), ZIP archives or plain CSV, a batch or a streaming listing.
    ``by_file``: neighbouring blocks of a file stay together, for a write with a
    folder a file; else the blocks are spread evenly."""
    spark = listing.sparkSession
    if listing.isStreaming and multiline:
        range_bytes = 1 << 62  # no prefix over a stream: a file is one range, its quotes counted by the task that reads it
    reader = RecordReader(tuple(columns), encoding, block_bytes, range_bytes, multiline, storage_options(spark) or None)

    def read(batches):
        import pandas as pd

        for batch in batches:
            for path, start, inside, balanced in zip(*[batch[c] for c in ("path", "start", "inside", "balanced")], strict=True):
                found = reader.read(path, int(start), bool(inside), None if balanced is None else bool(balanced))
                for i, (block, rows, member) in enumerate(found):
                    yield pd.DataFrame({"block": [block], "rows": [rows], "_source_file": [path], "_member": [member],
                                        "_chunk": [int(start) + i // CHUNK_BLOCKS]})

    found = _ranges(listing, range_bytes)
    if multiline and not listing.isStreaming:
        found = quote_states(found, reader)
    else:
        found = found.select("path", "start", F.lit(False).alias("inside"), F.lit(None).cast("boolean").alias("balanced"))
    blocks = found.mapInPandas(read, f"{BLOCKS}, _chunk long")
    if listing.isStreaming:
        return lines_of(spread(blocks))
    if by_file:
        return lines_of(blocks.repartition(_tasks(listing), "_source_file", "_chunk"))
    return lines_of(blocks.hint("rebalance"))


def _tasks(listing: DataFrame) -> int:
    """Tasks for the text of the listed files: their number grows with it, so that
    what a task holds of it, typed and sorted by file, does not."""
    text = F.col("length") * F.when(F.lower("path").endswith(".zip"), ARCHIVE_RATIO).otherwise(1)
    total = listing.agg(F.sum(text)).first()[0] or 0
    return max(listing.sparkSession.sparkContext.defaultParallelism, -(-int(total) // TASK_BYTES))


def spread(blocks: DataFrame) -> DataFrame:
    """Blocks of a stream over as many tasks as its shuffles have, so that a batch of
    many files can be cut as finely as the session asks for."""
    spark = blocks.sparkSession
    return blocks.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


#: What a reader sends on: a block of lines, to be split by the JVM, or records.
BLOCKS = "block string, rows array<string>, _source_file string, _member string"


def lines_of(blocks: DataFrame) -> DataFrame:
    """Blocks -> (line, _source_file, _member), one row a record; blank lines are none."""
    lines = blocks.select(F.explode(F.coalesce("rows", F.split("block", "\r?\n"))).alias("line"), "_source_file", "_member")
    return lines.where("line <> ''")


def scan_zip_csv(spark: SparkSession, root: str | list[str] | DataFrame, raw_schema: T.StructType, glob: str = ZIP_GLOB,
                 encoding: str = RAW_ENCODING, **sizes) -> DataFrame:
    """SC3: rows of every file under ``root`` (a folder, a list of files or a
    listing), all text: the first member of a ZIP archive, or a plain CSV file.

    Adds ``_source_file`` (file path), ``_member`` (member name) and
    ``_corrupt_record`` (text of a line that did not parse, else null).
    """
    cols = [f.name for f in raw_schema.fields]
    listing = root if isinstance(root, DataFrame) else list_archives(spark, root, glob)
    return parse_records(archive_records(listing, cols, encoding, **sizes), cols)


def parse_records(lines: DataFrame, cols: list[str] | T.StructType, options: dict | None = None) -> DataFrame:
    """CSV records -> one text column per name (or typed, by a schema), parsed by the JVM CSV parser."""
    shape = cols if isinstance(cols, T.StructType) else T.StructType([T.StructField(c, T.StringType()) for c in cols])
    names = [f.name for f in shape.fields]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*shape.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN} | (options or {})
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    parsed = lines.select("line", (quotes % 2 == 1).alias("_open"), F.from_csv("line", ddl, options).alias("_r"), "_source_file", "_member")
    return parsed.select(*[F.col("_r")[c].alias(c) for c in names],
                         F.coalesce(F.col("_r")[CORRUPT_COLUMN], F.when(F.col("_open"), F.col("line"))).alias(CORRUPT_COLUMN),
                         "_source_file", "_member")
