"""Line dedup by range-partitioned line hashes.

A line's key is the line stripped of ASCII white space at both ends, with A-Z
lower-cased.  A key of at least ``min_chars`` code points that occurs in at least
``min_docs`` documents is kept in the first document of the order (that of the
largest id) and dropped, every occurrence, from all others.

Method.  Each such line becomes one row: 128 bits of its key's hash, document,
position.  The rows are range-partitioned by (hash, document descending,
position) and sorted so inside each task, which then streams them: the first
document met under a hash is the one that keeps its lines, and as soon as
``min_docs`` documents have been met the others are known to lose theirs.  The
range bounds cut through the rows of one hash, so a line that a third of all
documents hold is spread over as many tasks as it fills.  What a task cannot
know are the hashes at its two ends: of these it sends on a summary (documents,
first and last) and the rows that depend on it.  The summaries, two a task at
most, are put together and decide those rows.

The result is a keep bitmap a document (one bit a line, packed and deflated),
not its text; :func:`apply` cuts the texts by it.  Texts are read twice and
never shuffled by the search; :func:`apply` moves each once.

Memory: a task holds one batch and, for the hash at hand, the rows of fewer than
``min_docs`` documents.

Defined cases: null and empty texts are one empty line; rows of one id are one
document, and each row keeps its own bitmap; null ids together are one document,
after all others in the order; equal rows get equal bitmaps; other columns are
not read.  Ids may be of any integer or string type.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import OUT_ROWS, materialise

MIN_CHARS, MIN_DOCS = 40, 5
SPACE = b" \t\n\x0b\x0c\r"
#: Kinds of rows that the stream sends on.
DROP, OPEN, SUMMARY = 0, 1, 2


def text_key(text: Column) -> Column:
    """What tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc, row, pos) of every line with a key of ``min_chars`` or more."""
    import xxhash

    kind = docs.schema[id_col].dataType

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            ids, texts = batch.column(0), batch.column(2).to_pylist()
            at, places, keys = [], [], []

            def out() -> pa.RecordBatch:
                taken = pa.array(at, pa.int64())  # noqa: B023  used before the loop goes on
                h = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)  # noqa: B023
                cols = [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), ids.take(taken), batch.column(1).take(taken),  # noqa: B023
                        pa.array(places, pa.int64())]  # noqa: B023
                return pa.RecordBatch.from_arrays(cols, names=["h1", "h2", "doc", "row", "pos"])

            for k, text in enumerate(texts):
                for pos, line in enumerate(text.split(b"\n")):
                    if len(line) < min_chars:
                        continue
                    key = line.strip(SPACE).lower()
                    n = len(key)
                    if n < min_chars or not key.isascii() and len(key.decode()) < min_chars:
                        continue
                    at.append(k)
                    places.append(pos)
                    keys.append(digest(key))
                    if len(keys) >= OUT_ROWS:
                        yield out()
                        at, places, keys = [], [], []
            if keys:
                yield out()

    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("doc"), text_key(F.col(text_col)).alias("row"), text.cast("binary").alias("body"))
            .mapInArrow(rows, f"h1 long, h2 long, doc {kind.simpleString()}, row long, pos long"))


class _Rows:
    """Columns of some sorted rows; documents as values beside a null mask."""

    def __init__(self, h1, h2, doc, none, row, pos):
        self.cols = (h1, h2, doc, none, row, pos)

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Rows:
        doc = batch.column(2)
        filled = doc.fill_null("" if pa.types.is_string(doc.type) else 0)
        h1, h2, row, pos = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3, 4))
        return cls(h1, h2, filled.to_numpy(zero_copy_only=False), doc.is_null().to_numpy(zero_copy_only=False), row, pos)

    def __len__(self) -> int:
        return len(self.cols[0])

    def __getitem__(self, cut) -> _Rows:
        return _Rows(*[c[cut] for c in self.cols])

    def new_hash(self) -> np.ndarray:
        h1, h2 = self.cols[:2]
        return np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))

    def new_doc(self) -> np.ndarray:
        doc, none = self.cols[2:4]
        return np.concatenate(([True], (doc[1:] != doc[:-1]) | (none[1:] != none[:-1])))

    def doc_at(self, k: int):
        return None if self.cols[3][k] else self.cols[2][k]

    def other_than(self, doc) -> np.ndarray:
        return ~self.cols[3] if doc is None else self.cols[3] | (self.cols[2] != doc)


def stream_firsts(batches: Iterator[pa.RecordBatch], min_docs: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The sorted rows of one task -> rows to drop, and for the hashes at its two
    ends open rows and summaries (kind, h1, h2, doc, row, pos, n, last)."""
    schema = pa.schema([("kind", pa.int8()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc", kind), ("row", pa.int64()),
                        ("pos", pa.int64()), ("n", pa.int64()), ("last", kind)])

    def sent(what: int, rows: _Rows) -> pa.RecordBatch:
        h1, h2, doc, none, row, pos = rows.cols
        n = len(rows)
        cols = [pa.array(np.full(n, what, np.int8)), pa.array(h1), pa.array(h2), pa.array(doc, type=kind, mask=none), pa.array(row),
                pa.array(pos), pa.nulls(n, pa.int64()), pa.nulls(n, kind)]
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    def summary() -> pa.RecordBatch:
        values = [SUMMARY, int(at[0]), int(at[1]), first, None, None, n_docs, last]
        return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    at, at_start, n_docs, first, last, held = None, True, 0, None, None, []

    def more(rows: _Rows) -> Iterator[pa.RecordBatch]:
        """Further rows of the hash at hand."""
        nonlocal n_docs, first, last, held
        starts = int(rows.new_doc().sum())
        if n_docs == 0:
            first = rows.doc_at(0)
        elif rows.doc_at(0) == last:
            starts -= 1
        n_docs, last = n_docs + starts, rows.doc_at(len(rows) - 1)
        if at_start:
            yield sent(OPEN, rows)
            return
        held.append(rows)
        if n_docs >= min_docs:
            for part in held:
                lost = part[part.other_than(first)]
                if len(lost):
                    yield sent(DROP, lost)
            held = []

    for batch in batches:
        rows = _Rows.of(batch)
        if not len(rows):
            continue
        fresh = rows.new_hash()
        if at is not None:
            fresh[0] = (rows.cols[0][0], rows.cols[1][0]) != at
        cuts = np.flatnonzero(fresh)
        head = int(cuts[0]) if len(cuts) else len(rows)
        if head:
            yield from more(rows[:head])
        if not len(cuts):
            continue
        if at is None:  # the task's first hash
            stop = int(cuts[1]) if len(cuts) > 1 else len(rows)
            at = (rows.cols[0][0], rows.cols[1][0])
            yield from more(rows[:stop])
            cuts = cuts[1:]
            if not len(cuts):
                continue
        if at_start:
            yield summary()
        at_start, held = False, []
        # hashes that begin and end in this batch
        begin, end = int(cuts[0]), int(cuts[-1])
        if end > begin:
            whole = rows[begin:end]
            group = np.cumsum(fresh[begin:end]) - 1
            docs = np.bincount(group, weights=whole.new_doc() | fresh[begin:end])
            starts = cuts[:-1] - begin
            doc, none = whole.cols[2:4]
            of_first = (doc == doc[starts][group]) & (none == none[starts][group])
            lost = whole[(docs >= min_docs)[group] & ~of_first]
            if len(lost):
                yield sent(DROP, lost)
        at, n_docs = (rows.cols[0][end], rows.cols[1][end]), 0
        yield from more(rows[end:])
    if at is not None:
        yield summary()
        for part in held:
            yield sent(OPEN, part)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                  min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, row, pos) of every line to drop."""
    kind = docs.schema[id_col].dataType.simpleString()
    arrow = pa.string() if kind == "string" else {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind]
    lines = materialise(line_rows(docs, id_col, text_col, min_chars), "line-rows")
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc_nulls_last(), F.col("row"), F.col("pos")]

    def stream(batches):
        return stream_firsts(batches, min_docs, arrow)

    found = (lines.repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInArrow(stream, f"kind byte, h1 long, h2 long, doc {kind}, row long, pos long, n long, last {kind}")
             .withColumn("task", F.spark_partition_id()))
    found = materialise(found, "line-firsts")
    ends = found.where(F.col("kind") == SUMMARY)  # two rows a task at most
    along = Window.partitionBy("h1", "h2").orderBy("task")
    shared = F.coalesce((F.lag("task").over(along).isNotNull() & F.lag("last").over(along).eqNullSafe(F.col("doc"))).cast("long"), F.lit(0))
    ends = ends.select("h1", "h2", "task", "doc", (F.col("n") - shared).alias("n"))
    decided = ends.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.min_by(F.struct("doc"), "task").alias("first"))
    decided = decided.where(F.col("n") >= min_docs).select("h1", "h2", "first")
    open_rows = found.where(F.col("kind") == OPEN).join(F.broadcast(decided), ["h1", "h2"])
    late = open_rows.where(~F.col("doc").eqNullSafe(F.col("first.doc"))).select("doc", "row", "pos")
    return found.where(F.col("kind") == DROP).select("doc", "row", "pos").unionByName(late)


def pack(n_lines: int, dropped) -> bytes:
    """Deflated bits of one document, 1 for a line that stays."""
    keep = np.ones(n_lines, np.uint8)
    keep[np.asarray(dropped, np.int64)] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack(n_lines: int, keep: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document that loses lines: (doc_id, text_key, n_lines,
    n_dropped, keep).  A document without a row keeps all its lines."""
    kind = docs.schema[id_col].dataType.simpleString()
    places = dropped_lines(docs, id_col, text_col, min_chars, min_docs).groupBy("doc", "row").agg(F.collect_set("pos").alias("gone"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    sizes = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines")).distinct()
    hit = sizes.join(places, sizes["doc_id"].eqNullSafe(places["doc"]) & (F.col("text_key") == F.col("row")))

    def packed(batches):
        for batch in batches:
            n, gone = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            cols = [batch.column(0), batch.column(1), batch.column(2), pa.array([len(g) for g in gone], pa.int64()),
                    pa.array([pack(k, g) for k, g in zip(n, gone, strict=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_key", "n_lines", "n_dropped", "keep"])

    return (hit.select("doc_id", "text_key", "n_lines", "gone")
            .mapInArrow(packed, f"doc_id {kind}, text_key long, n_lines long, n_dropped long, keep binary"))


def apply(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) for every row of ``docs``: the lines that
    stay, joined by line feeds, as UTF-8 bytes."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    both = texts.join(bitmaps, texts["id"].eqNullSafe(bitmaps["doc_id"]) & (F.col("tk") == F.col("text_key")), "left")

    def cut(batches):
        for batch in batches:
            n_lines, dropped, kept = [], [], []
            for body, lost, keep in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
                n = body.count(b"\n") + 1
                if keep is not None:
                    stays = unpack(n, keep)
                    body = b"\n".join([line for line, s in zip(body.split(b"\n"), stays, strict=True) if s])
                n_lines.append(n)
                dropped.append(lost or 0)
                kept.append(body)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_lines, pa.int64()), pa.array(dropped, pa.int64()),
                                              pa.array(kept, pa.binary())], names=["doc_id", "n_lines", "n_dropped", "kept"])

    return both.select("id", "body", "n_dropped", "keep").mapInArrow(cut, f"doc_id {kind}, n_lines long, n_dropped long, kept binary")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) for every row of ``docs``."""
    cut = apply(docs, materialise(keep_bitmaps(docs, id_col, text_col, **how), "line-bitmaps"), id_col, text_col)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
