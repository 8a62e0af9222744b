"""Removal of long repeated substrings by prefix-free parsing.

Texts are bytes.  A rolling hash is taken of every ``GRAM`` bytes; the smallest
one inside a window of ``length`` bytes is the window's trigger.  Runs of windows
with one trigger are phrases, which overlap so that each window lies whole in
exactly one phrase: the parse is prefix-free and depends on content alone, so
equal windows stand at equal places before equal triggers.

Dictionary and parse are ordered together, in four steps:

1. parse: each batch of documents sends its distinct phrases, as hashes of the
   trigger and of the phrase, with the smallest document that holds them;
2. dictionary: by trigger, phrases that occur in several documents are found.
   Documents after the first of a phrase lose all its windows.  Triggers with
   several phrases may still share windows, and only these go on.  The answer is
   two bits an entry, in the order in which the batch sent them;
3. suffixes: the first document of such a phrase sends its text, and all windows
   of the phrases of a trigger (the suffixes of the dictionary, cut at the
   length that decides) are sorted; equal neighbours share their smallest
   document, which gives the windows that the first document loses as well;
4. cover: each batch marks the bytes of the windows it loses and cuts them out.

Highly repetitive text thus costs one dictionary entry a batch.  Since a
decision needs ``length`` bytes only, and a phrase holds them after each of its
positions, the order of the parse beyond the phrase never matters, and no suffix
array of the whole corpus is built.

Scale: a batch is a hash class of ids of about ``BATCH_BYTES`` text; a batch
sends one packed row to each part of the dictionary, so a passage that a third
of all documents hold is one entry a batch.  Parts hold about ``PART_PHRASES``.
Nothing is collected or broadcast.  Sizes follow from the bytes of the input.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing;
rows with one id are one document for the order; rows with a null id are one, after
all others, in batches by their text; repeats inside one document alone are kept; other columns are not
read; very long texts are parsed in pieces of ``PIECE`` bytes (windows that a
piece end cuts off from their phrase form phrases of their own).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import id_and_body

LENGTH, GRAM = 50, 24
BATCH_BYTES, PART_PHRASES, PIECE = 4 << 20, 1 << 17, 1 << 17
_LAST = np.iinfo(np.int64).max
_POS, _TEXT = np.uint64(0xFFFFFF), np.uint64((1 << 56) - 1)

_BYTE_HASH = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = [np.uint64(int(x) | 1) for x in np.random.default_rng(77).integers(1, 1 << 63, 6, dtype=np.uint64)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD[4]
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` (24) bytes from each position, by joining halves."""
    h, eight = _BYTE_HASH[data], None
    for k, size in enumerate((1, 2, 4, 8)):
        h = h[:-size] * _ODD[k] + h[size:]
        if size == 4:
            eight = h = _mixed(h)
    return _mixed(h[:-8] * _ODD[5] + eight[16:])


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = width - size
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


class Parse:
    """Phrases of the documents of a batch: document, first and last window
    start (in the document), place of the trigger, and two hashes."""

    def __init__(self, bodies: list, length: int):
        self.length = length
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        for docs, starts, data in self._pieces(bodies, length):
            if len(data) < length:
                continue
            grams = gram_hashes(data)
            place = np.arange(len(grams), dtype=np.uint64)
            trigger = (_sliding_min((grams & ~_POS) | place, length - GRAM + 1) & _POS).astype(np.int64)
            ends = np.append(starts[1:], len(data))
            left = np.repeat(ends, ends - starts)[:len(trigger)] - np.arange(len(trigger))
            windows = np.flatnonzero(left >= length)
            if not len(windows):
                continue
            own = trigger[windows]
            cut = np.flatnonzero(np.diff(own)) + 1
            first = windows[np.append(0, cut)]
            last = windows[np.append(cut - 1, len(windows) - 1)]
            own = own[np.append(0, cut)]
            # the phrase's grams from its start, and the one at its end, hold all its bytes
            tail = last + (length - GRAM)
            text = _mixed(grams[first] * _ODD[0] + (last - first).astype(np.uint64))
            for step in range(GRAM, length + 32 - GRAM, GRAM):
                text = _mixed(text * _ODD[1] + grams[np.minimum(first + step, tail)])
            text = _mixed(text * _ODD[2] + grams[tail]) & _TEXT
            at = np.searchsorted(starts, first, "right") - 1
            base = starts[at] - self._skip[at]
            for c, x in zip(columns, (docs[at], first - base, last - base, own - first, (grams[own] >> np.uint64(32)).astype(np.uint32), text), strict=True):
                c.append(x)
        kinds = (np.int64, np.int64, np.int64, np.int64, np.uint32, np.uint64)
        self.doc, self.first, self.last, self.before, self.key, self.text = (
            np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(columns, kinds, strict=True))

    def _pieces(self, bodies: list, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of whole documents of up to PIECE bytes; longer documents in
        pieces that overlap by a window less a byte."""
        group, size = [], 0

        def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            sizes = [len(p) for _, _, p in group]
            self._skip = np.array([skip for _, skip, _ in group], np.int64)
            return (np.array([d for d, _, _ in group], np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64),
                    np.frombuffer(b"".join(p for _, _, p in group), np.uint8))

        for d, body in enumerate(bodies):
            if len(body) < length:
                continue
            for skip in range(0, len(body) - length + 1, PIECE):
                part = body[skip:skip + PIECE + length - 1]
                if group and size + len(part) > PIECE:
                    yield joined()
                    group, size = [], 0
                group.append((d, skip, part))
                size += len(part)
        if group:
            yield joined()


def _ordered(key: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by (key, text), and the starts of equal pairs in it."""
    joined = (key.astype(np.uint64) << np.uint64(32)) | (text >> np.uint64(24))
    order = np.argsort(joined, kind="stable")
    j, t = joined[order], text[order]
    same = j[1:] == j[:-1]
    if (same & (t[1:] != t[:-1])).any():  # the lower halves differ
        order = np.lexsort((text, joined))
        j, t = joined[order], text[order]
        same = (j[1:] == j[:-1]) & (t[1:] == t[:-1])
    return order, np.flatnonzero(np.append(True, ~same)) if len(order) else np.zeros(0, np.int64)


_PLANE_LEVEL = 1


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte plane by byte plane, compressed."""
    import zstandard

    planes = b"".join(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in map(np.ascontiguousarray, arrays))
    return zstandard.ZstdCompressor(level=_PLANE_LEVEL).compress(planes)


def unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n, out, at = len(raw) // sum(np.dtype(k).itemsize for k in kinds), [], 0
    for k in kinds:
        size = np.dtype(k).itemsize
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(k).ravel())
        at += n * size
    return out


def _delta(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=sorted_keys[:1] * 0)


def _docs(table: pa.Table) -> tuple[np.ndarray, list, np.ndarray]:
    """Ids and texts in the order of the ids, and the rows they come from."""
    ids = np.array([_LAST if x is None else x for x in table.column("doc_id").to_pylist()], np.int64)
    order = np.argsort(ids, kind="stable")
    bodies = table.column("body").to_pylist()
    return ids[order], [bodies[k] for k in order.tolist()], order


_PARTED = pa.schema([("part", pa.int32()), ("batch", pa.int32()), ("packed", pa.binary())])


def _rows(rows: list) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_PARTED)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _PARTED, strict=True)], schema=_PARTED)


def _each(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
    return zip(*(table.column(f.name).to_pylist() for f in _PARTED), strict=True)


class Classes:
    """The distinct phrases of a batch, ordered by trigger and phrase, and dealt to
    the parts of the dictionary.  Any parse of the batch gives the same list, so
    the other steps answer by place in it."""

    def __init__(self, table: pa.Table, length: int, parts: int):
        self.ids, self.bodies, self.rows = _docs(table)
        self.parse = Parse(self.bodies, length)
        self.order, self.start = _ordered(self.parse.key, self.parse.text)
        self.one = self.order[self.start]  # in the first document
        self.key, self.text = self.parse.key[self.one], self.parse.text[self.one]
        self.doc = self.ids[self.parse.doc[self.one]]
        part = ((self.key.astype(np.uint64) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        cut = np.flatnonzero(np.diff(part)) + 1
        edges = [0, *cut.tolist(), len(part)] if len(part) else [0]
        self.of_part = {int(part[s]): slice(s, e) for s, e in zip(edges, edges[1:], strict=False)}


def _bits(*flags: np.ndarray) -> bytes:
    return pack(np.concatenate([np.packbits(f) for f in flags]))


def _flags(packed: bytes, n: int) -> list[np.ndarray]:
    """The two arrays of n flags that :func:`_bits` packed."""
    raw, size = unpack(packed, np.uint8)[0], (n + 7) // 8
    return [np.unpackbits(raw[k:k + size], count=n).astype(bool) for k in (0, size)]


def _parser(length: int, parts: int):
    """Step 1."""
    def run(group: tuple, table: pa.Table) -> pa.Table:
        c = Classes(table, length, parts)
        return _rows([(p, group[0].as_py(), pack(_delta(c.key[s]), *_seven(c.text[s]), c.doc[s])) for p, s in c.of_part.items()])

    return run


def _seven(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 56 bits of a phrase hash without the empty byte."""
    return (text >> np.uint64(24)).astype(np.uint32), (text >> np.uint64(8)).astype(np.uint16), text.astype(np.uint8)


def _dictionary(group: tuple, table: pa.Table) -> pa.Table:
    """Step 2: for each entry of each batch, if other documents before hold the
    phrase, and else if its trigger has other phrases to be ordered with."""
    sent, columns = [], [[], [], []]
    for part, batch, packed in _each(table):
        step, high, middle, low, doc = unpack(packed, np.uint32, np.uint32, np.uint16, np.uint8, np.int64)
        text = (high.astype(np.uint64) << np.uint64(24)) | (middle.astype(np.uint64) << np.uint64(8)) | low
        sent.append((part, batch, len(step)))
        for c, x in zip(columns, (np.cumsum(step, dtype=np.uint32), text, doc), strict=True):
            c.append(x)
    key, text, doc = map(np.concatenate, columns)
    place = np.argsort(doc, kind="stable")
    order, start = _ordered(key[place], text[place])
    place = place[order]
    key, doc = key[place], doc[place]
    head = np.zeros(len(key), bool)
    head[start] = True
    # triggers whose phrases have different first documents
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    low = np.minimum.reduceat(np.where(head, doc, _LAST), at)
    high = np.maximum.reduceat(np.where(head, doc, np.iinfo(np.int64).min), at)
    mixed = np.repeat(low != high, np.diff(np.append(at, len(key))))
    full, ranked = np.zeros(len(key), bool), np.zeros(len(key), bool)
    full[place[~head]] = True
    ranked[place[head & mixed]] = True
    rows, done = [], 0
    for part, batch, n in sent:
        rows.append((part, batch, _bits(full[done:done + n], ranked[done:done + n])))
        done += n
    return _rows(rows)


def _sender(length: int, parts: int):
    """Step 3, before the exchange: the texts of the phrases to be ordered, and
    the batch's flags in one row of their own (a negative part) for step 4."""
    def run(group: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows or not answers.num_rows:
            return _PARTED.empty_table()
        c, batch = Classes(docs, length, parts), group[0].as_py()
        full, ranked = np.zeros(len(c.one), bool), np.zeros(len(c.one), bool)
        rows = []
        for part, _, packed in _each(answers):
            s = c.of_part[part]
            full[s], ranked[s] = _flags(packed, s.stop - s.start)
            o = c.one[s][ranked[s]]
            if len(o):
                p = c.parse
                size = (p.last[o] + length - p.first[o]).astype(np.uint8)
                data = b"".join(c.bodies[d][f:f + z] for d, f, z in zip(p.doc[o].tolist(), p.first[o].tolist(), size.tolist(), strict=True))
                head = pack(_delta(p.key[o]), c.ids[p.doc[o]], size)
                rows.append((part, batch, len(head).to_bytes(4, "little") + head + pack(np.frombuffer(data, np.uint8))))
        return _rows([*rows, (-1 - batch, batch, _bits(full, ranked))])

    return run


def _suffixes(length: int):
    """Step 3: order the windows of all phrases of a part; for each phrase a mask
    of the windows that its first document loses."""
    def run(group: tuple, table: pa.Table) -> pa.Table:
        if group[0].as_py() < 0:
            return table.select(_PARTED.names).cast(_PARTED)
        sent, columns, datas = [], [[], [], []], []
        for part, batch, packed in _each(table):
            head = int.from_bytes(packed[:4], "little")
            step, doc, size = unpack(packed[4:4 + head], np.uint32, np.int64, np.uint8)
            sent.append((part, batch, len(step)))
            datas.append(unpack(packed[4 + head:], np.uint8)[0])
            for c, x in zip(columns, (np.cumsum(step, dtype=np.uint32), doc, size.astype(np.int64)), strict=True):
                c.append(x)
        key, doc, size = map(np.concatenate, columns)
        data = np.concatenate(datas)
        begin, n = np.cumsum(size) - size, size - length + 1
        mask = np.zeros(len(key), np.uint32)
        turn = np.argsort(key, kind="stable")
        # by runs of triggers, so that few strings are in memory at a time
        many = np.cumsum(n[turn]) // 100_000
        ends = np.flatnonzero((np.diff(key[turn]) != 0) & (np.diff(many) != 0)) + 1
        windows = np.lib.stride_tricks.sliding_window_view(data, length)
        for s, e in zip([0, *ends.tolist()], [*ends.tolist(), len(turn)], strict=True):
            own = turn[s:e]
            first = np.cumsum(n[own]) - n[own]
            phrase = np.repeat(own, n[own])
            offset = np.arange(len(phrase)) - np.repeat(first, n[own])
            strings = windows[begin[phrase] + offset].view(np.dtype((np.void, length))).ravel()
            _, same = np.unique(strings, return_inverse=True)
            least = np.full(same.max() + 1, _LAST)
            np.minimum.at(least, same, doc[phrase])
            lost = np.where(least[same] < doc[phrase], np.uint32(1) << offset.astype(np.uint32), np.uint32(0))
            mask[own] = np.bitwise_or.reduceat(lost, first)
        rows, done = [], 0
        for part, batch, k in sent:
            if mask[done:done + k].any():
                rows.append((part, batch, pack(mask[done:done + k])))
            done += k
        return _rows(rows)

    return run


def lost_windows(c: Classes, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (document, first, last) of window starts that are lost."""
    p, n = c.parse, len(c.one)
    full, ranked, mask = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.uint32)
    found = list(_each(answers))
    for part, _, packed in found:
        if part < 0:
            full, ranked = _flags(packed, n)
    for part, _, packed in found:
        if part >= 0:
            s = c.of_part[part]
            mask[s.start + np.flatnonzero(ranked[s])] = unpack(packed, np.uint32)[0]
    of = np.empty(len(c.order), np.int64)
    of[c.order] = np.repeat(np.arange(n), np.diff(np.append(c.start, len(c.order))))
    whole = full[of] | (c.ids[p.doc] > c.doc[of])  # not the first document, of all or of this batch
    some = np.flatnonzero(~whole & (mask[of] > 0))
    bits = mask[of[some]]
    runs = [(p.doc[whole], p.first[whole], p.last[whole])]
    for k in range(int(bits.max(initial=0)).bit_length()):
        on = some[(bits >> np.uint32(k)) & np.uint32(1) == 1]
        runs.append((p.doc[on], p.first[on] + k, p.first[on] + k))
    return tuple(np.concatenate(x) for x in zip(*runs, strict=True))


def _coverer(length: int, parts: int, texts: bool):
    """Step 4."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if texts else [])]

    def run(group: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        c = Classes(docs, length, parts)
        doc, first, last = lost_windows(c, answers)
        order = np.lexsort((first, doc))
        doc, first, last = doc[order], first[order], last[order]
        bounds = np.searchsorted(doc, np.arange(len(c.bodies) + 1))
        out = []
        for d, body in enumerate(c.bodies):
            s, e = bounds[d], bounds[d + 1]
            kept, removed, spans = body, 0, 0
            if e > s:
                edge = np.zeros(len(body) + 1, np.int32)
                np.add.at(edge, first[s:e], 1)
                np.add.at(edge, last[s:e] + length, -1)
                cover = np.cumsum(edge[:-1]) > 0
                removed = int(cover.sum())
                spans = int((cover[1:] & ~cover[:-1]).sum()) + int(cover[0])
                kept = np.frombuffer(body, np.uint8)[~cover].tobytes()
            out.append((len(body), removed, spans, hashlib.sha256(kept).hexdigest(), *([kept] if texts else [])))
        columns = list(zip(*out, strict=True)) if out else [[]] * (len(names) - 1)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if texts else [])]
        return pa.table([docs.column("doc_id").take(pa.array(c.rows)), *[pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]], names=names)

    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                     texts: bool = False, batch_bytes: int = BATCH_BYTES, part_phrases: int = PART_PHRASES) -> DataFrame:
    """One row per document: bytes, bytes removed, maximal removed runs and the
    SHA-256 of what is left; with ``texts`` also what is left, as bytes."""
    if not GRAM < length < GRAM + 32:  # a phrase has length - GRAM + 1 windows at most, one bit each
        raise ValueError(f"length must be {GRAM + 1} to {GRAM + 31}")
    base = id_and_body(docs, id_col, text_col)
    total = base.agg(F.sum(F.length("body"))).first()[0] or 0
    batches = max(1, math.ceil(total / batch_bytes))
    parts = max(1, math.ceil(total / (length - GRAM) * 2 / part_phrases))
    base = base.select(F.col("doc_id").cast("long").alias("doc_id"), "body",
                       F.pmod(F.hash("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("body"))), F.lit(batches)).alias("batch"))
    parted = "part int, batch int, packed binary"
    phrases = base.groupBy("batch").applyInArrow(_parser(length, parts), parted)
    answers = phrases.groupBy("part").applyInArrow(_dictionary, parted)
    held = base.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_sender(length, parts), parted)
    ordered = held.groupBy("part").applyInArrow(_suffixes(length), parted)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")
    return base.groupBy("batch").cogroup(ordered.groupBy("batch")).applyInArrow(_coverer(length, parts, texts), schema)
