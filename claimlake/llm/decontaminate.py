"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items are inserted word by word into one suffix
automaton.  Document words are streamed through it: after each word the
automaton holds the longest suffix of the words read that occurs in some item.
The automaton state of a match also tells which windows end there and which
items hold them, so one pass over a document finds every window of every item.

Scale: documents are never shuffled.  The automaton is the only thing that is
broadcast and its size is checked: a benchmark with more than ``max_words``
words is dealt over several automata by item (windows never cross items), and
the documents pass through one Python stage per automaton in the same Spark
stage, each worker holding one.

Words: ASCII letters are lower-cased; a word is a maximal run of digits, ASCII
letters and non-ASCII characters.  A window is ``window`` consecutive words of
an item; an item of fewer words, but at least one, is one window.

Defined cases: a null or empty text has no words and is not contaminated; items
without words, with a null id or a null text match nothing; repeated items give
their id once; repeated documents are judged one by one; with an empty
benchmark nothing is contaminated; other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.llm.common import body

WINDOW = 10
#: Words of benchmark in one automaton: some 60 MB in a Python worker.
MAX_WORDS = 100_000
_BODY, _RANGES, _ITEMS = "__decon_body", "__decon_ranges", "__decon_items"

_KEPT = (set(range(0x30, 0x3A)) | set(range(0x41, 0x5B)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100)))
_FOLD = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in _KEPT else 0x20 for c in range(256))
_WORD_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """All word runs of the items; ``windows[v]`` lists (length, item) of the
    windows whose last state is v."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.ids: list[str] = []
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.windows: dict[int, dict[int, set[int]]] = {}  # state -> size -> items
        self.shortest = window
        coded = []
        for item_id, words in items:
            if words:
                self.ids.append(item_id)
                coded.append([self.vocab.setdefault(w, len(self.vocab)) for w in words])
                last = 0
                for w in coded[-1]:
                    last = self._extend(last, w)
        for k, item in enumerate(coded):
            size = min(window, len(item))
            self.shortest = min(self.shortest, size)
            state = 0
            for i, w in enumerate(item):
                state = self.next[state][w]
                if i + 1 >= size:
                    v = state
                    while self.length[self.link[v]] >= size:
                        v = self.link[v]
                    self.windows.setdefault(v, {}).setdefault(size, set()).add(k)
        # nearest state at or above v on the suffix links that ends a window
        self.above = [0] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.above[v] = v if v in self.windows else self.above[self.link[v]]

    def _new(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The state of exactly length(p) + 1 among the suffixes of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, self.next[last][w], w)
        new = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][w], w)
        return new

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words inside window occurrences, and the items hit."""
        ranges: list[tuple[int, int]] = []
        hits: set[tuple[int, int]] = set()  # (state, size) met; the items of each are put together once
        n, get = len(words), self.vocab.get
        codes = np.fromiter((get(w, -1) for w in words), np.int64, n)
        known = np.concatenate(([0], (codes >= 0).view(np.int8), [0]))
        edges = np.flatnonzero(np.diff(known))
        nexts, link, length, windows, above = self.next, self.link, self.length, self.windows, self.above
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if hi - lo < self.shortest:
                continue
            state = matched = 0
            for i, w in enumerate(codes[lo:hi].tolist(), lo):
                while state and w not in nexts[state]:
                    state = link[state]
                    matched = length[state]
                if w in nexts[state]:
                    state = nexts[state][w]
                    matched += 1
                v, longest = above[state], 0
                while v:
                    for size in windows[v]:
                        if size <= matched:
                            longest = max(longest, size)
                            hits.add((v, size))
                    v = above[link[v]]
                if longest:
                    start = i + 1 - longest
                    if ranges and start <= ranges[-1][1]:
                        while ranges and start <= ranges[-1][1]:
                            start = min(start, ranges.pop()[0])
                    ranges.append((start, i + 1))
        return ranges, {self.ids[k] for v, size in hits for k in windows[v][size]}


def _merge(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def automata(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text",
             window: int = WINDOW, max_words: int = MAX_WORDS) -> Iterator[SuffixAutomaton]:
    """One automaton for each share of the items of about ``max_words`` words."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), body(item_text).alias("body")).where("item is not null")
    words = rows.agg(F.sum(F.length("body") / 4)).first()[0] or 0
    shares = max(1, math.ceil(words / max_words))
    rows = rows.withColumn("share", F.pmod(F.xxhash64("item", "body"), F.lit(shares)))
    for k in range(shares):
        part = rows.where(F.col("share") == k).select("item", "body").collect()  # about max_words words
        yield SuffixAutomaton(((r[0], words_of(bytes(r[1]))) for r in part), window)


def annotate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
             item_text: str = "text", window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` with its texts as bytes, the hit word ranges (packed pairs) and
    the ids of the items hit, in three reserved columns."""
    spark = docs.sparkSession
    df = docs.withColumns({_BODY: body(text_col), _RANGES: F.lit(None).cast("binary"),
                           _ITEMS: F.lit(None).cast("array<string>")})
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    for automaton in automata(benchmark, item_id, item_text, window, max_words):
        shared = spark.sparkContext.broadcast(automaton)  # bounded by max_words

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sam = shared.value
            for b in batches:
                at = {n: k for k, n in enumerate(b.schema.names)}
                packed, named = [], []
                for text, ranges, items in zip(*(b.column(at[c]).to_pylist() for c in (_BODY, _RANGES, _ITEMS)), strict=True):
                    hit, ids = sam.matches(words_of(text))
                    if ranges:
                        before = np.frombuffer(ranges, np.int64).reshape(-1, 2).tolist()
                        hit = _merge([tuple(x) for x in before], hit)
                    packed.append(np.array(hit, np.int64).tobytes())
                    named.append(sorted({*(items or ()), *ids}))
                arrays = list(b.columns)
                arrays[at[_RANGES]] = pa.array(packed, pa.binary())
                arrays[at[_ITEMS]] = pa.array(named, b.schema.field(at[_ITEMS]).type)
                yield pa.RecordBatch.from_arrays(arrays, schema=b.schema)

        df = df.mapInArrow(run, schema)
    return df


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document: words, hit words, items hit, and hit word spans."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = annotate(base, benchmark, "text", **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = {n: k for k, n in enumerate(b.schema.names)}
            n_words, n_hit, n_items, digest, spans = [], [], [], [], []
            for text, ranges, items in zip(*(b.column(at[c]).to_pylist() for c in (_BODY, _RANGES, _ITEMS)), strict=True):
                hit = np.frombuffer(ranges or b"", np.int64).reshape(-1, 2)
                n_words.append(len(text.translate(_FOLD).split()))
                n_hit.append(int((hit[:, 1] - hit[:, 0]).sum()))
                n_items.append(len(items or ()))
                digest.append(hashlib.sha256(",".join(sorted(items or ())).encode()).hexdigest())
                spans.append(",".join(f"{s}:{e}" for s, e in hit.tolist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(at["doc_id"]), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(n_items, pa.int64()), pa.array(digest, pa.string()),
                 pa.array([x > 0 for x in n_hit], pa.bool_()), pa.array(spans, pa.string())],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return marked.mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, "
                                  "contaminated boolean, spans string")


def cut_words(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """The text without the words of the ranges and what stands between them."""
    at = [m.span() for m in _WORD_BYTES.finditer(text)]
    out, done = [], 0
    for s, e in ranges:
        out.append(text[done:at[s][0]])
        done = at[e - 1][1]
    return b"".join([*out, text[done:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_coverage: float = 0.5, **how) -> DataFrame:
    """``docs`` without benchmark passages, same columns: the words inside window
    occurrences are cut out of the text, and a document of which they are more
    than ``max_coverage`` is dropped.  Untouched texts stay as they are."""
    marked = annotate(docs, benchmark, text_col, **how)
    schema = docs.schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = {n: k for k, n in enumerate(b.schema.names)}
            keep, texts = [], b.column(at[text_col]).to_pylist()
            for k, (text, ranges) in enumerate(zip(b.column(at[_BODY]).to_pylist(), b.column(at[_RANGES]).to_pylist(), strict=True)):
                hit = np.frombuffer(ranges or b"", np.int64).reshape(-1, 2)
                if not len(hit):
                    keep.append(True)
                    continue
                keep.append(int((hit[:, 1] - hit[:, 0]).sum()) <= max_coverage * len(text.translate(_FOLD).split()))
                texts[k] = cut_words(text, hit.tolist()).decode()
            arrays = [pa.array(texts, b.schema.field(at[n]).type) if n == text_col else b.column(at[n]) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, names=names).filter(pa.array(keep, pa.bool_()))

    return marked.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
