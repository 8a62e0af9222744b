"""Spelling variants by pivotal grams.

Words are the letter runs of all texts, counted; two words are near if they
differ by exactly one inserted, deleted or replaced code point.

Method (edit distance 1, bigrams).  Bigrams are ordered by how many words'
places hold them, rarest first.  A word's prefix is its 3 rarest bigrams, and
every further place of the last of them.  Among these a word has two that do not
overlap; dynamic programming over their places picks the pair of the shortest
lists, the word's pivots.  Of two near words take the one whose prefix ends
later in the order: an edit spoils at most one of the other's two pivots, so the
other one is among its bigrams, and since it comes early enough in the order, in
its prefix.  So it is enough to look up every word's pivots in the prefixes of
the others.  The place limits what can meet: between words of one length a
shared bigram stands at the same place, and between words whose lengths differ by
one at the same place or one further in the longer.  Place and length are part of
the key of a list, so that each pivot is looked up under five keys.

What meets is verified: near words agree in a first or a last part (digests of
the two are compared first), and what remains is compared letter by letter.
The search is exact.

Scale: texts are read once and never shuffled, only words with counts are, combined
map-side.  Words get consecutive numbers in code-point order, so pairs are two
longs.  A list of over ``block`` words is dealt into salted blocks, each of which
sees all its look-ups, in batches; a task holds about one block.  Pairs found
under several keys are merged before they are counted.  The order of bigrams goes
to every task: letters are 90 code points, so it has 8,100 rows at most.

Each step from a word to its form at least doubles the count, so a chain is no
longer than the logarithm of the largest count; roots are found by pointer
doubling.

Defined cases: null and empty texts have no words; a null id counts as the empty
string; rows of one id are as many documents; equal counts choose the smaller
word; words of any length are compared whole; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import OUT_ROWS, body, materialise
from claimlake.operators.rowindex import with_row_index

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SLIP, MIN_CHARS, MIN_COUNT, RATIO = 97, 5, 3, 2
#: Words counted in a task before the counts are sent on: entries, and their code points.
HELD, HELD_CHARS = 300_000, 8_000_000
#: Words of one list held by one task, and pairs compared at once.
BLOCK, PAIRS = 20_000, 100_000
#: Words up to this length are compared as rows of an array, longer ones by digests, then one by one.
WIDE = 40


# words ------------------------------------------------------------------------

def slipped(word: str, base: int) -> str:
    """``word`` without one code point if the digest of id and word says so; ``base`` is the digest of the id."""
    h = zlib.crc32(word.encode(), base)
    if h % SLIP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                slips: bool = True) -> DataFrame:
    """(word, n) over all documents, of words of ``min_chars`` code points or more;
    ``slips`` first deletes a code point from one run in 97 (see :func:`slipped`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        chars = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                base = zlib.crc32(f"{name}:".encode())
                for word, n in Counter(RUN.findall(text.lower().decode())).items():
                    if slips:
                        word = slipped(word, base)
                    if len(word) >= min_chars:
                        if word not in counts:
                            chars += len(word)
                        counts[word] += n
                if len(counts) >= HELD or chars >= HELD_CHARS:
                    yield out()
                    counts.clear()
                    chars = 0
        if counts:
            yield out()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), body(text_col).alias("body"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# grams ------------------------------------------------------------------------

def gram_order(words: DataFrame) -> list[tuple[str, int]]:
    """Bigrams with their number of places, rarest first; 8,100 at most."""
    def run(batches):
        for batch in batches:
            counts: Counter = Counter()
            for w in batch.column(0).to_pylist():
                counts.update([w[i:i + 2] for i in range(len(w) - 1)])
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["g", "n"])

    found = words.select("word").mapInArrow(run, "g string, n long").groupBy("g").agg(F.sum("n").alias("n"))
    return sorted(((r.g, r.n) for r in found.collect()), key=lambda x: (x[1], x[0]))


def prefix_of(word: str, rank: dict[str, int], size: int = 3) -> list[tuple[int, int]]:
    """(rank, place) of the ``size`` rarest bigrams and all places of the last of them."""
    grams = sorted((rank[word[i:i + 2]], i) for i in range(len(word) - 1))
    last = grams[min(size, len(grams)) - 1][0]
    return [g for g in grams if g[0] <= last]


def pivots_of(prefix: list[tuple[int, int]], weight: list[int], count: int = 2, q: int = 2) -> list[tuple[int, int]]:
    """``count`` grams of the prefix that do not overlap, of least total weight.
    best[k] holds, over the grams seen in order of place, the least weight of k that
    do not overlap and end at or before a place."""
    ordered = sorted(prefix, key=lambda g: g[1])
    best = [[(0, ())] * (len(ordered) + 1)] + [[(math.inf, ())] for _ in range(count)]
    for j, (r, place) in enumerate(ordered):
        free = j
        while free and ordered[free - 1][1] > place - q:
            free -= 1
        for k in range(1, count + 1):
            before, chosen = best[k - 1][free]
            best[k].append(min(best[k][j], (before + weight[r], (*chosen, (r, place)))))
    return list(best[count][-1][1])


def parts_of(word: str) -> tuple[int, int, int, int]:
    """Digests of the first and last part that a near word of the same length or
    longer shares one of, and of those that a shorter one does."""
    from xxhash import xxh64_intdigest as digest

    n, m = len(word), len(word) - 1
    cuts = word[:n // 2], word[n // 2:], word[:m // 2], word[n - (m - m // 2):]
    return tuple(digest(c.encode()) for c in cuts)  # type: ignore[return-value]


def entries(words: DataFrame, order: list[tuple[str, int]]) -> DataFrame:
    """Rows (key, role, id, n, word, size, parts, delta): role 0 under each prefix gram,
    role 1 for each look-up of a pivot; delta is the length of the word looked for
    less one's own.  The key holds gram, place and length of the word looked for.
    A long word goes as the digests of its parts, since it can have many places."""
    rank = {g: k for k, (g, _) in enumerate(order)}
    weight = [n for _, n in order]

    def key(r: int, place: int, length: int) -> int:  # what shares a key by chance is told apart when verified
        return ((length & 0xFFFFFF) << 39) | (r << 26) | (place & 0x3FFFFFF)

    names = ["key", "role", "id", "n", "word", "size", "parts", "delta"]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            fixed = [batch.column(0), batch.column(2), pa.array([w if len(w) <= WIDE else "" for w in texts], pa.string()),
                     pa.array([len(w) for w in texts], pa.int64()),
                     pa.array([None if len(w) <= WIDE else np.array(parts_of(w), np.uint64).tobytes() for w in texts], pa.binary())]
            at, keys, role, deltas = [], [], [], []

            def out() -> pa.RecordBatch:
                taken = pa.array(at, pa.int64())  # noqa: B023  used before the loop goes on
                cols = [pa.array(keys, pa.int64()), pa.array(role, pa.int8()), *[c.take(taken) for c in fixed], pa.array(deltas, pa.int8())]  # noqa: B023
                return pa.RecordBatch.from_arrays(cols, names=names)

            for k, w in enumerate(texts):
                prefix, size = prefix_of(w, rank), len(w)
                rows = [(key(r, place, size), 0, 0) for r, place in prefix]
                for r, place in pivots_of(prefix, weight):
                    rows += [(key(r, place + shift, size + delta), 1, delta)
                             for delta, shift in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1)) if place + shift >= 0]
                at += [k] * len(rows)
                for into, values in zip((keys, role, deltas), zip(*rows, strict=True), strict=True):
                    into += values
                if len(at) >= OUT_ROWS:
                    yield out()
                    at, keys, role, deltas = [], [], [], []
            if at:
                yield out()

    return words.select("id", "word", "n").mapInArrow(
        run, "key long, role byte, id long, n long, word string, size long, parts binary, delta byte")


# verification -------------------------------------------------------------------

def is_near(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)  # length of the common start, by halving
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return a[low + 1:] == b[low + 1:] if len(a) == len(b) else a[low:] == b[low + 1:]


def _near_rows(short: np.ndarray, long: np.ndarray, size: np.ndarray, wider: bool) -> np.ndarray:
    """Of rows of letters (zero beyond a word's end), the sizes of the shorter
    words, and whether the others are one longer: which are near."""
    width = short.shape[1]
    inside = np.arange(width) < size[:, None]
    differs = (short != long) & inside
    if not wider:
        return differs.sum(axis=1) == 1
    start = np.where(differs.any(axis=1), differs.argmax(axis=1), size)  # length of the common start
    apart = ((short[:, :-1] != long[:, 1:]) & inside[:, :-1])[:, ::-1]
    tail = np.where(apart.any(axis=1), apart.argmax(axis=1) - (width - 1 - size), size)
    return start + tail >= size


def _matrix(words: list[str]) -> np.ndarray:
    m = np.array(words, dtype=f"<U{WIDE + 2}")
    return m.view(np.uint32).reshape(len(words), WIDE + 2).astype(np.uint8)


class _Stored:
    """Rows of some keys, in order of key, with what a comparison needs."""

    FIELDS = ("key", "ident", "n", "size", "same", "longer", "letters")

    def __init__(self, key, ident, n, size, word, parts):
        self.key, self.ident, self.n, self.size = key, ident, n, size
        p = np.array([parts_of(w) if q is None else np.frombuffer(q, np.uint64) for w, q in zip(word, parts, strict=True)], np.uint64).reshape(-1, 4)
        self.same, self.longer = p[:, :2], p[:, 2:]
        self.letters = _matrix(list(word))

    def cut(self, mask) -> _Stored:
        out = object.__new__(_Stored)
        for name in self.FIELDS:
            setattr(out, name, getattr(self, name)[mask])
        return out

    def __add__(self, other: _Stored) -> _Stored:
        out = object.__new__(_Stored)
        for name in self.FIELDS:
            setattr(out, name, np.concatenate((getattr(self, name), getattr(other, name))))
        return out


def linker(pairs: int = PAIRS):
    """For rows sorted by key and role: stored rows come before the look-ups of a
    key, so a look-up finds them in its batch or among those kept of the last key.
    Yields (a, b, n_a, n_b, sure), a < b; not sure are pairs of long words, of which
    only digests have been compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, role, ident, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            word, parts = (np.array([*batch.column(k).to_pylist(), None], dtype=object)[:-1] for k in (4, 6))
            size, delta = (batch.column(k).to_numpy(zero_copy_only=False) for k in (5, 7))
            is_stored = role == 0
            stored = _Stored(*[x[is_stored] for x in (key, ident, n, size, word, parts)])
            stored = kept + stored if kept is not None else stored
            kept = stored.cut(stored.key == key[-1])
            look = np.flatnonzero(~is_stored & np.isin(key, stored.key))
            if not len(look):
                continue
            seen, ldelta = _Stored(*[x[look] for x in (key, ident, n, size, word, parts)]), delta[look]
            for d, mine, theirs in ((0, seen.same, stored.same), (1, seen.same, stored.longer), (-1, seen.longer, stored.same)):
                asked = np.flatnonzero(ldelta == d)
                for part in (0, 1):
                    for left, right in _agreeing(_mixed(seen.key[asked], mine[asked, part]), _mixed(stored.key, theirs[:, part]), pairs):
                        yield from _verified(seen, stored, d, asked[left], right)

    return run


def _mixed(key: np.ndarray, digest: np.ndarray) -> np.ndarray:
    return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (digest * np.uint64(0xC2B2AE3D27D4EB4F))


def _agreeing(asked: np.ndarray, stored: np.ndarray, pairs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of equal values in the two, some ``pairs`` at once."""
    order = np.argsort(stored)
    held = stored[order]
    lo = np.searchsorted(held, asked, "left")
    count = np.searchsorted(held, asked, "right") - lo
    total = np.concatenate(([0], np.cumsum(count)))
    start = 0
    while start < len(asked):
        stop = max(start + 1, int(np.searchsorted(total, total[start] + pairs, "right")) - 1)
        n = count[start:stop]
        left = np.repeat(np.arange(start, stop), n)
        if len(left):
            yield left, order[np.arange(len(left)) - np.repeat(total[start:stop] - total[start], n) + np.repeat(lo[start:stop], n)]
        start = stop


def _verified(seen: _Stored, stored: _Stored, d: int, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Which of these pairs are near; the stored word is ``d`` longer."""
    fit = (seen.ident[left] != stored.ident[right]) & (stored.size[right] - seen.size[left] == d)
    left, right = left[fit], right[fit]
    if not len(left):
        return
    shorter, other = seen.letters[left], stored.letters[right]
    if d < 0:
        shorter, other = other, shorter
    size = seen.size[left] + min(d, 0)
    open_ = size + abs(d) > WIDE
    near = _near_rows(shorter, other, np.where(open_, 0, size), d != 0) | open_
    sure = ~open_[near]
    left, right = left[near], right[near]
    a, b, na, nb = seen.ident[left], stored.ident[right], seen.n[left], stored.n[right]
    turn = a > b
    found = np.unique(np.stack([np.where(turn, b, a), np.where(turn, a, b), np.where(turn, nb, na), np.where(turn, na, nb), sure], axis=1), axis=0)
    if len(found):
        yield pa.RecordBatch.from_arrays([*[pa.array(found[:, k].copy(), pa.int64()) for k in range(4)], pa.array(found[:, 4] == 1)],
                                         names=["a", "b", "n_a", "n_b", "sure"])


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``words`` (id, word, n), ids distinct -> every pair of near words once: (a, b, n_a, n_b)."""
    rows = entries(words, gram_order(words))
    full = (rows.where("role = 0").groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks")).where("blocks > 1"))
    full = materialise(full, "spelling-hot")
    n_full = full.count()  # at most a few entries a word / block
    if n_full:
        rows = (rows.join(F.broadcast(full) if n_full <= 1_000_000 else full, "key", "left")
                .withColumn("salt", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long")))
                                              .when(F.col("role") == 0, F.array(F.pmod(F.xxhash64("id"), F.col("blocks"))))
                                              .otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))))
    else:
        rows = rows.withColumn("salt", F.lit(0).cast("long"))
    rows = rows.withColumn("key", F.when(F.col("salt") == 0, F.col("key")).otherwise(F.xxhash64("key", "salt")))
    met = (rows.select("key", "role", "id", "n", "word", "size", "parts", "delta").repartition("key").sortWithinPartitions("key", "role")
           .mapInArrow(linker(), "a long, b long, n_a long, n_b long, sure boolean")
           .groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), F.first("sure").alias("sure")))
    met = materialise(met, "spelling-pairs")

    def compared(batches):
        for batch in batches:
            x, y = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            yield batch.select(names).filter(pa.array([is_near(a, b) for a, b in zip(x, y, strict=True)], pa.bool_()))

    names = ["a", "b", "n_a", "n_b"]
    texts = words.where(F.length("word") > WIDE - 1)
    doubtful = (met.where("not sure").select(*names).join(texts.select(F.col("id").alias("a"), F.col("word").alias("x")), "a")
                .join(texts.select(F.col("id").alias("b"), F.col("word").alias("y")), "b"))
    checked = doubtful.select(*names, "x", "y").mapInArrow(compared, "a long, b long, n_a long, n_b long")
    return met.where("sure").select(*names).unionByName(checked)


# forms and roots ------------------------------------------------------------------

def _side(pairs: DataFrame, me: str, other: str) -> DataFrame:
    return pairs.select(F.col(me).alias("id"), F.col(f"n_{me}").alias("n"), F.col(other).alias("other"), F.col(f"n_{other}").alias("other_n"))


def chosen_forms(pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(id, n_near, form, form_n): of each word with near ones their number and the
    form, the one of the largest count (ties: smallest id), if it is large enough."""
    both = _side(pairs, "a", "b").unionByName(_side(pairs, "b", "a"))
    top = both.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.max("n").alias("n"),
                                 F.max(F.struct("other_n", (-F.col("other")).alias("minus"))).alias("top"))
    taken = F.col("top.other_n") >= ratio * F.col("n")
    return top.select("id", "n_near", F.when(taken, -F.col("top.minus")).alias("form"), F.when(taken, F.col("top.other_n")).alias("form_n"))


def roots_of(forms: DataFrame, most: int) -> DataFrame:
    """``forms`` (id, form) with counts that double at each step up to ``most`` -> (id, root)."""
    at = materialise(forms.where("form is not null").select("id", F.col("form").alias("root")), "spelling-roots")
    for _ in range(max(1, math.ceil(math.log2(math.log2(max(most, 2)) + 1)))):  # reach doubles at each step
        nxt = at.select(F.col("id").alias("root"), F.col("root").alias("further"))
        at = materialise(at.join(nxt, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
             ratio: int = RATIO, slips: bool = True, block: int = BLOCK) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    if min_chars < 4:
        raise ValueError("two bigrams that do not overlap need words of four code points or more")
    counted = materialise(count_words(docs, id_col, text_col, min_chars, slips).where(F.col("n") >= min_count), "spelling-counts")
    words = materialise(with_row_index(counted, [F.col("word")], "id"), "spelling-words")
    most = words.agg(F.max("n")).first()[0] or 0
    pairs = near_pairs(words, block)
    forms = materialise(chosen_forms(pairs, ratio), "spelling-forms")
    name = words.select(F.col("id").alias("other"), F.col("word").alias("name"))

    def named(df: DataFrame, col: str) -> DataFrame:
        return df.join(name.select(F.col("other").alias(col), F.col("name").alias(f"{col}_word")), col, "left")

    known = named(named(forms.join(roots_of(forms, most), "id", "left"), "form"), "root")
    return words.join(known.select("id", "n_near", "form_n", "form_word", "root_word"), "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
