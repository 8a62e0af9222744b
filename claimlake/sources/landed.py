"""Landed claim files as Spark data sources (SC3, ST1).

``claim_records``: the records of the files under a folder, ZIP archives and plain
CSV, through ``spark.read.format`` and ``spark.readStream.format``.  Partitions are
planned on the driver from the listing: one for each member of an archive's
directory that is asked for, byte ranges of a plain file.  Rows are blocks
(see :data:`claimlake.sources.archives.BLOCKS`); :func:`read_records` splits and parses them.

``claim_files``: the files themselves, as a stream of (path, length, modified,
version) that yields a file again when it has been issued again, which Spark's
own file stream never does.

Both streams keep a manifest under the option ``log``: one small file for each set of
files found new or changed, named by its number, which is the stream's
offset.  It is written before the offset is returned and moved into place whole, so an
offset always names the same files, and a batch that is repeated after a failure
reads the same ones.

Options: ``path``, ``glob``, ``columns`` (comma-separated, of the header),
``encoding``, ``multiline``, ``blockBytes``, ``rangeBytes``, ``log``, and
``storage.*``, object-store credentials; :func:`source_options` fills in those of
the session.
"""

from __future__ import annotations

import fnmatch
import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from claimlake.sources.archives import (BLOCK_BYTES, BLOCKS, RANGE_BYTES, ZIP_GLOB, RecordReader, arrow_fs, is_archive, lines_of,
                                        parse_records, spread, storage_options)
from claimlake.sources.files import RAW_ENCODING

#: Files of a partition of the listing stream.
FILES_A_TASK = 1000


def source_options(spark: SparkSession) -> dict[str, str]:
    """The session's object-store settings as options of these sources."""
    return {f"storage.{k}": v for k, v in storage_options(spark).items()}


class _Options:
    def __init__(self, options):
        # Spark's options do not tell capital letters apart
        o = {str(k).lower(): v for k, v in dict(options).items()}
        if "path" not in o:
            raise ValueError("the option path is missing")
        self.path, self.glob, self.log = o["path"].rstrip("/"), o.get("glob", ZIP_GLOB), o.get("log", "").rstrip("/")
        self.storage = {k.removeprefix("storage."): v for k, v in o.items() if k.startswith("storage.")} or None
        self.reader = RecordReader(tuple(c for c in o.get("columns", "").split(",") if c), o.get("encoding", RAW_ENCODING),
                                   int(o.get("blockbytes", BLOCK_BYTES)), int(o.get("rangebytes", RANGE_BYTES)),
                                   str(o.get("multiline", "false")).lower() == "true", self.storage)

    def listing(self) -> list[tuple[str, int, int]]:
        """(path, length, modified in ns) of the landed files, by path."""
        import pyarrow.fs as pafs

        fs, root = arrow_fs(self.path, self.storage)
        prefix = self.path[:len(self.path) - len(root)] if self.path.endswith(root) else ""
        match = re.compile(fnmatch.translate(self.glob)).match
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        hidden = re.compile(r"(^|/)[._]")
        return sorted((prefix + f.path, f.size, f.mtime_ns or 0) for f in found
                      if f.type == pafs.FileType.File and match(f.base_name) and not hidden.search(f.path[len(root):]))


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    inside: bool
    balanced: bool | None


@dataclass
class _Files(InputPartition):
    files: list


def _planned(opts: _Options, files: list) -> list[InputPartition]:
    """Ranges of the files; with quoted line feeds a file is one range, its quotes counted by its task."""
    out: list[InputPartition] = []
    for path, length, _ in files:
        step = length + 1 if is_archive(path) or opts.reader.multiline else opts.reader.range_bytes
        out += [_Range(path, start, False, None) for start in range(0, max(length, 1), step)]
    return out


def _read_blocks(reader: RecordReader, part: _Range):
    import dataclasses

    import pyarrow as pa

    if reader.multiline:
        reader = dataclasses.replace(reader, range_bytes=1 << 62)
    types = [pa.string(), pa.list_(pa.string()), pa.string(), pa.string()]
    for block, rows, member in reader.read(part.path, part.start, part.inside, part.balanced):
        cols = [pa.array([v], type=t) for v, t in zip((block, rows, part.path, member), types, strict=True)]
        yield pa.RecordBatch.from_arrays(cols, names=["block", "rows", "_source_file", "_member"])


class _BlockReader(DataSourceReader):
    def __init__(self, opts: _Options):
        self.opts = opts

    def partitions(self):
        return _planned(self.opts, self.opts.listing())

    def read(self, partition):
        yield from _read_blocks(self.opts.reader, partition)


class _Manifest:
    """Numbered sets of files found new or changed."""

    def __init__(self, opts: _Options):
        if not opts.log:
            raise ValueError("a stream needs the option log, a folder for its manifest")
        self.opts = opts
        self.known: dict[str, tuple[int, int]] | None = None
        self.version = 0

    def _name(self, version: int) -> str:
        return f"{version:012d}.json"

    def files(self, version: int) -> list[tuple[str, int, int]]:
        fs, root = arrow_fs(self.opts.log, self.opts.storage)
        with fs.open_input_file(f"{root}/{self._name(version)}") as f:
            return [tuple(x) for x in json.loads(f.read())]

    def _load(self) -> dict[str, tuple[int, int]]:
        import pyarrow.fs as pafs

        if self.known is None:
            self.known = {}
            fs, root = arrow_fs(self.opts.log, self.opts.storage)
            names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.base_name.endswith(".json"))
            for name in names:
                self.version = int(name.removesuffix(".json"))
                self.known.update({path: (length, modified) for path, length, modified in self.files(self.version)})
        return self.known

    def latest(self) -> int:
        """The number of the last set, after adding one for what has changed since."""
        known = self._load()
        changed = [f for f in self.opts.listing() if known.get(f[0]) != f[1:]]
        if changed:
            fs, root = arrow_fs(self.opts.log, self.opts.storage)
            fs.create_dir(root)
            name = f"{root}/{self._name(self.version + 1)}"
            with fs.open_output_stream(f"{name}.tmp") as f:
                f.write(json.dumps(changed).encode())
            fs.move(f"{name}.tmp", name)
            self.version += 1
            known.update({path: (length, modified) for path, length, modified in changed})
        return self.version


class _Stream(DataSourceStreamReader):
    def __init__(self, opts: _Options):
        self.opts, self.manifest = opts, _Manifest(opts)

    def initialOffset(self):
        return {"version": 0}

    def latestOffset(self):
        return {"version": self.manifest.latest()}

    def found(self, start: dict, end: dict):
        for version in range(start["version"] + 1, end["version"] + 1):
            yield version, self.manifest.files(version)

    def commit(self, end):
        pass


class _BlockStream(_Stream):
    def partitions(self, start, end):
        return [p for _, files in self.found(start, end) for p in _planned(self.opts, files)]

    def read(self, partition):
        yield from _read_blocks(self.opts.reader, partition)


class _FileStream(_Stream):
    def partitions(self, start, end):
        rows = [(*f, version) for version, files in self.found(start, end) for f in files]
        return [_Files(rows[k:k + FILES_A_TASK]) for k in range(0, len(rows), FILES_A_TASK)]

    def read(self, partition):
        yield from partition.files


class ClaimRecords(DataSource):
    @classmethod
    def name(cls):
        return "claim_records"

    def schema(self):
        return BLOCKS

    def reader(self, schema):
        return _BlockReader(_Options(self.options))

    def streamReader(self, schema):
        return _BlockStream(_Options(self.options))


class ClaimFiles(DataSource):
    @classmethod
    def name(cls):
        return "claim_files"

    def schema(self):
        return "path string, length long, modified long, version long"

    def streamReader(self, schema):
        return _FileStream(_Options(self.options))


def register(spark: SparkSession) -> None:
    """Make both sources known to the session."""
    spark.dataSource.register(ClaimRecords)
    spark.dataSource.register(ClaimFiles)


def read_records(spark: SparkSession, path: str, columns: list[str], stream: bool = False, **options) -> DataFrame:
    """The rows of the files under ``path``, all text, as :func:`claimlake.sources.archives.scan_zip_csv` gives them."""
    register(spark)
    reader = spark.readStream if stream else spark.read
    blocks = reader.format("claim_records").options(columns=",".join(columns), **source_options(spark), **options).load(path)
    return parse_records(lines_of(spread(blocks) if stream else blocks.hint("rebalance")), columns)
