"""SimHash near-duplicates with multi-index hashing.

Fingerprints: ASCII letters are lower-cased, words are runs without white space,
shingles are ``shingle`` consecutive words joined by a space (a shorter text is
one shingle); a fingerprint bit is set if it is set in over half the XXH64
values of the shingles.

Links: two fingerprints within ``radius`` differing bits.  The 64 bits are cut
into m segments with radii r_i, sum(r_i + 1) = radius + 1: if every segment
differed by more than its r_i bits, the whole would differ by more than
``radius``.  So each distinct fingerprint is stored once under each segment
value, and looked up under every value of the small Hamming ball around each of
its segments; all that meet are verified on the full 64 bits.  The search is
exact for every m; m only moves work between look-ups and verifications.

Scale: equal fingerprints collapse first, map-side, so a group of exact copies
is one entry.  Look-ups are a hash shuffle on the segment value.  A segment
value that holds over ``block`` fingerprints is dealt into salted blocks; each
block sees all its look-ups, in batches, and a task never holds more than about
one block.  Tasks do not emit pairs: what links within a batch is reduced to a
star per group, so a dense group yields as many rows as it has members and
look-ups.  Components are found by star contraction.

Defined cases: null, empty and blank texts have fingerprint zero and link like
any other; repeated ids count as one document; a null id gets the component of
its fingerprint; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import id_and_body, map_bodies, materialise
from claimlake.llm.components import connected_components

SHINGLE, SEED, RADIUS, BITS = 4, 42, 4, 64
#: Fingerprints of one segment value held by one task (8 bytes each, and as much for the ids).
BLOCK = 20_000
#: Pairs verified at once in a task.
PAIRS = 2_000_000
_SET_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint_of(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of one text; zero without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        values = [digest(joined, seed)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        values = [digest(joined[s:e - 1], seed) for s, e in zip([0, *ends], ends[shingle - 1:], strict=False)]
    n = len(values)
    octets = np.array(values, np.uint64).view(np.uint8).reshape(n, 8)
    counts = np.zeros(2048, np.int64)
    offset = np.arange(8, dtype=np.int64) * 256
    for k in range(0, n, 1 << 16):  # long texts in pieces
        counts += np.bincount((octets[k:k + (1 << 16)] + offset).ravel(), minlength=2048)
    ones = (counts.reshape(8, 256) @ _SET_BITS).ravel()
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def make():
        return lambda ids, texts: (ids, np.array([fingerprint_of(t, shingle, seed) for t in texts], np.uint64).view(np.int64))

    kind = docs.schema[id_col].dataType.simpleString()
    return map_bodies(id_and_body(docs, id_col, text_col), f"doc_id {kind}, fp long", make)


def segment_plan(segments: int, radius: int, bits: int = BITS) -> list[tuple[int, int, list[int]]]:
    """(shift, width, masks of the Hamming ball) of each segment."""
    radii = [(radius + 1) // segments - 1 + (k < (radius + 1) % segments) for k in range(segments)]
    out, shift = [], 0
    for k, r in enumerate(radii):
        width = bits // segments + (k < bits % segments)
        if r >= 0:
            masks = [0]
            for _ in range(r):
                masks = sorted({m ^ (1 << b) for m in masks for b in range(width)} | set(masks))
            out.append((shift, width, masks))
        shift += width
    return out


def choose_segments(n: int, radius: int, bits: int = BITS) -> int:
    """The exact plan of least work for n fingerprints: rows looked up, and pairs verified."""
    def cost(m: int) -> float:
        return sum(n * len(masks) * (1 + 0.02 * n / 2 ** width) for _, width, masks in segment_plan(m, radius, bits))

    return min(range(2, max(3, radius + 1)), key=cost)


def _key(fp: Column, k: int, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1)) * 8 + k


def _looked_up(k: int, shift: int, width: int):
    return lambda mask: _key(F.col("fp").bitwiseXOR(mask), k, shift, width)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star (node, root) for each component of the pairs (a, b)."""
    nodes, inverse = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = inverse[:len(a)], inverse[len(a):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, u, label[v])
        np.minimum.at(label, v, label[u])
        label = label[label]
        if np.array_equal(before, label):
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def linker(radius: int, pairs: int = PAIRS):
    """For rows (key, role, fp, rep) sorted by key and role: stored rows (role 0)
    come before look-ups (role 1) of the same key, so every look-up of a batch
    finds its stored rows in the batch or among those kept of the last key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            key, role, fp, rep = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            stored = role == 0
            skey, sfp, srep = (np.concatenate((o, x[stored])) for o, x in zip(kept, (key, fp, rep), strict=True))
            pkey, pfp, prep = key[~stored], fp[~stored], rep[~stored]
            lo = np.searchsorted(skey, pkey, "left")
            n = np.searchsorted(skey, pkey, "right") - lo
            if len(key):
                last = skey == key[-1]
                kept = [skey[last], sfp[last], srep[last]]
            total = np.concatenate(([0], np.cumsum(n)))
            start = 0
            while start < len(pkey):
                stop = max(start + 1, int(np.searchsorted(total, total[start] + pairs, "right")) - 1)
                count = n[start:stop]
                left = np.repeat(np.arange(start, stop), count)
                right = np.arange(total[stop] - total[start]) - np.repeat(total[start:stop] - total[start], count) + np.repeat(lo[start:stop], count)
                far = np.bitwise_count((pfp[left] ^ sfp[right]).view(np.uint64))
                near = (far <= radius) & (prep[left] != srep[right])
                if near.any():
                    node, root = _stars(prep[left[near]], srep[right[near]])
                    yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], names=["a", "b"])
                start = stop
    return run


def links(fps: DataFrame, radius: int = RADIUS, segments: int | None = None, block: int = BLOCK) -> DataFrame:
    """``fps`` (fp, rep) distinct by fp -> edges (a, b) between ids rep that span
    every component of the fingerprints within ``radius``."""
    segments = segments or choose_segments(fps.count(), radius)
    plan = segment_plan(segments, radius)
    stored = fps.select("fp", "rep", F.explode(F.array(*[_key(F.col("fp"), k, s, w) for k, (s, w, _) in enumerate(plan)])).alias("key"))
    balls = F.flatten(F.array(*[
        F.transform(F.array(*[F.lit(int(np.uint64(m << s).view(np.int64))).cast("long") for m in masks]), _looked_up(k, s, w))
        for k, (s, w, masks) in enumerate(plan)]))
    looked = fps.select("fp", "rep", F.explode(balls).alias("key"))
    full = stored.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts")).where("parts > 1")
    hot = materialise(full, "simhash-hot")
    rows = stored.withColumn("role", F.lit(0)).unionByName(looked.withColumn("role", F.lit(1)))
    n_hot = hot.count()  # at most segments / block of the fingerprints
    if n_hot:
        rows = (rows.join(F.broadcast(hot) if n_hot <= 1_000_000 else hot, "key", "left")
                .withColumn("salt", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long")))
                                              .when(F.col("role") == 0, F.array(F.pmod(F.xxhash64("fp"), F.col("parts"))))
                                              .otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))))
        rows = rows.withColumn("key", F.xxhash64("key", "salt"))  # only groups rows: what meets is verified
    return (rows.select("key", "role", "fp", "rep").repartition("key").sortWithinPartitions("key", "role")
            .mapInArrow(linker(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, segments: int | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    fp = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = materialise(fp.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    # one id with several texts is one document: its classes meet at their ids
    several = fp.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y").select("doc_id")
    shared = (fp.join(several, "doc_id", "left_semi").join(classes, "fp")
              .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    edges = links(classes.where("rep is not null"), radius, segments, block).unionByName(shared)
    roots = connected_components(edges).select(F.col("node").alias("rep"), "root")
    classes = classes.join(roots, "rep", "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    return fp.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (rows with a
    null id are kept); repeated rows of that id are reduced to one."""
    found = near_duplicates(docs, id_col, text_col, **how)
    roots = found.where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    kept = docs.join(roots, F.col(id_col) == F.col("__id"), "left_semi")
    return kept.dropDuplicates([id_col]).unionByName(docs.where(F.col(id_col).isNull()))
