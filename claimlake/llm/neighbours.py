"""Approximate nearest neighbours by largest inner product, over balanced
posting lists.

Fit: a bounded sample is cut in halves again and again by balanced 2-means; the
leaves' means, moved by a few rounds of k-means, are the centroids.  They are
linked to a graph of near centroids, searched best-first in memory.  Index: every
vector goes to its nearest list, and boundary vectors also to each list whose
centroid is within ``spread`` of the nearest distance.  Search: a query reads the
lists within a reach of its nearest centroid's distance (distance-ratio
pruning), more while these hold too few vectors.  What is found is scored
exactly, in double precision.

The reach is measured, not guessed: the true neighbours of ``CALIBRATE`` queries
are found by brute force over all rows, and the reach is the distance ratio
within which the share ``goal`` of them lies.  So recall is about ``goal`` on any
data and at any size; on vectors without structure that costs more lists.

Inner product becomes distance by one more coordinate, sqrt(M^2 - |x|^2) for
stored vectors and 0 for queries, M the largest norm.

Scale: only centroids, their graph and their list sizes are broadcast, at most
``MAX_LISTS`` rows.  Equal vectors form one class and a class is stored once,
with its k + 1 smallest ids: more can never be among k answers, so copies of one
vector, however many, neither fill a list nor multiply look-ups.  Neighbouring
lists share a bin of at most about ``BLOCK`` vectors; a bin with more is read in
blocks.  A task holds one block and its queries stream past it, ``CHUNK`` at a
time, each with a bitmap of the lists it wants; of a chunk only the best 2 k a
query are held.  So memory depends neither on the number of queries nor on that
of the lists they want.  A query sends one row to a block and gets one row of its
best k + 1 over all of the block's lists.  Answers are merged by query.  Vectors
are kept as floats where the table has floats; a product in single precision
rules out what cannot be among the best by more than its rounding error, the
rest is scored in double precision.

Defined cases: vectors that are null, zero, hold null or non-finite components,
or have another length than most take no part, as row or query; ties go to the
smaller id; repeated ids of one vector count once; fewer than k rows give all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import materialise

K, EVERY = 20, 20
#: Vectors of the fit, and bytes they may take on the driver.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 32 << 20
LIST_ROWS, MAX_LISTS, BLOCK, ASKS = 256, 4096, 262_144, 200_000
#: Bytes of a block's vectors, and of a batch of vectors sent on.
BIN_BYTES, SENT_BYTES = 48 << 20, 8 << 20
#: Blocks at least, if they hold ``LEAST_BLOCK`` rows; groups of blocks and queries with a partition of their own.
BLOCKS, LEAST_BLOCK, GROUPS = 12, 8192, 10_000
DEGREE, REPLICAS, SPREAD, BEAM, LEAST, GOAL, CALIBRATE, ROUNDS = 16, 6, 0.01, 24, 512, 0.97, 64, 4
#: Queries scored at once, stored rows of one product, places held before the best are chosen.
CHUNK, ROWS, HITS = 1024, 2048, 65_536
#: Stands for the list of a query's row: after all lists.
QUERY = (1 << 31) - 1


def balanced_centroids(x: np.ndarray, leaf: int, seed: int = 5) -> np.ndarray:
    """Means of the leaves of a tree of equal halves, after some rounds of k-means."""
    rng, done, todo = np.random.default_rng(seed), [], [x]
    while todo:
        part = todo.pop()
        if len(part) <= leaf or (part == part[0]).all():
            done.append(part.mean(0))
            continue
        a, b = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(6):
            lean = part @ (a - b)
            order = np.argsort(lean, kind="stable")
            left, right = part[order[:len(part) // 2]], part[order[len(part) // 2:]]
            b, a = left.mean(0), right.mean(0)
        todo += [left, right]
    c = np.array(done)
    for _ in range(ROUNDS):
        near = np.concatenate([((c * c).sum(1) - 2 * x[k:k + 512] @ c.T).argmin(1) for k in range(0, len(x), 512)])
        order = np.argsort(near, kind="stable")
        at = np.flatnonzero(np.bincount(near, minlength=len(c)))
        starts = np.searchsorted(near[order], at)
        c[at] = np.add.reduceat(x[order], starts) / np.diff(np.append(starts, len(x)))[:, None]
    return c


class CentroidGraph:
    """Centroids linked to their nearest ones; batches of best-first searches."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.c = centroids.astype(np.float32)
        n = len(centroids)
        near = np.empty((n, min(degree, n)), np.int64)
        for k in range(0, n, 512):
            near[k:k + 512] = np.argsort(self.to_all(self.c[k:k + 512]), axis=1, kind="stable")[:, :near.shape[1]]
        ring = np.arange(n)
        self.links = np.column_stack((near, (ring + 1) % n, (ring - 1) % n, (ring + n // 2) % n))
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 16 + 4 * math.isqrt(n))).astype(np.int64))

    def _squared(self, x: np.ndarray, nodes: np.ndarray | slice = slice(None)) -> np.ndarray:
        c = self.c[nodes].astype(np.float64)
        d = x @ (-2 * c.T)
        d += (x * x).sum(1)[:, None]
        d += (c * c).sum(1)
        return d

    def to_all(self, x: np.ndarray) -> np.ndarray:
        """Distances of some rows to every centroid."""
        return np.sqrt(np.maximum(self._squared(x.astype(np.float64)), 0))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest centroids found for each row, nearest first, and distances.
        The rows go best-first together: what one opens is measured for all, in one product."""
        x, n, beam = x.astype(np.float32).astype(np.float64), len(self.c), min(beam, len(self.c))
        known, opened = np.zeros(n, bool), np.zeros(n, bool)
        nodes, dist, new = np.zeros((len(x), 0), np.int64), np.zeros((len(x), 0)), self.entries
        while len(new):
            known[new] = True
            nodes, dist = np.hstack((nodes, np.broadcast_to(new, (len(x), len(new))))), np.hstack((dist, self._squared(x, new)))
            if dist.shape[1] > beam:
                near = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
                nodes, dist = np.take_along_axis(nodes, near, 1), np.take_along_axis(dist, near, 1)
            go = np.zeros(n, bool)
            go[nodes] = True
            go &= ~opened
            opened |= go
            reached = np.zeros(n, bool)
            reached[self.links[go]] = True
            new = np.flatnonzero(reached & ~known)
        order = np.argsort(nodes, axis=1)  # ties by number
        nodes, dist = np.take_along_axis(nodes, order, 1), np.take_along_axis(dist, order, 1)
        order = np.argsort(dist, axis=1, kind="stable")
        return np.take_along_axis(nodes, order, 1), np.sqrt(np.maximum(np.take_along_axis(dist, order, 1), 0))


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): vectors that take part, as floats if they are, else as doubles."""
    kind = "float" if df.select(vec_col).dtypes[0][1] == "array<float>" else "double"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("v"))
    # array_contains is null for a value that is not there beside a null
    sound = [~F.array_contains("v", F.lit(float(x)).cast(kind)) for x in ("nan", "inf", "-inf")]
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
                      & sound[0] & sound[1] & sound[2] & ((F.array_max("v") != 0) | (F.array_min("v") != 0)))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (size[0]["n"] if size else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _kind(classes: DataFrame) -> str:
    return dict(classes.dtypes)["v"]


def _extent(classes: DataFrame) -> tuple[int, float, int]:
    """Number of classes, largest squared norm and length of the vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0)).astype(np.float64)
                yield pa.RecordBatch.from_pydict({"n": [len(x)], "lift": [float((x * x).sum(1).max())], "dim": pa.array([x.shape[1]], pa.int32())})

    n, lift, dim = classes.select("v").mapInArrow(run, "n long, lift double, dim int").agg(F.sum("n"), F.max("lift"), F.max("dim")).first()
    return n or 0, lift, dim


def _chosen(shared, lift: float | None, choose, beam: int):
    """(part of a batch, row, list) for each list that ``choose`` keeps."""
    def found(batches: Iterator[pa.RecordBatch]):
        graph = shared.value
        step = max(16, min(512, (1 << 20) // len(graph.c)))
        for batch in batches:
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                x = _matrix(part.column(1)).astype(np.float64)
                extra = np.zeros(len(x)) if lift is None else np.sqrt(np.maximum(lift - (x * x).sum(1), 0))
                nodes, dist = graph.search(np.column_stack((x, extra)), beam)
                row, at = np.nonzero(choose(nodes, dist))
                yield part, row, nodes[row, at]

    return found


def _indexed(classes: DataFrame, shared, lift: float, choose) -> DataFrame:
    """Rows (list, rep, v, ids): each class under its lists."""
    found = _chosen(shared, lift, choose, BEAM)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, row, lists in found(batches):
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *part.take(pa.array(row)).columns], names=["list", *part.schema.names])

    return classes.mapInArrow(run, f"list int, rep long, v {_kind(classes)}, ids array<long>")


def _wanted(shared, choose, beam: int, first: list[int]):
    """(part of a batch, bin, rows, bitmaps of the bin's lists) for each bin that some row asks; ``first`` has the bins' first lists and their end."""
    found = _chosen(shared, None, choose, beam)

    def bins(batches: Iterator[pa.RecordBatch]):
        for part, row, lists in found(batches):
            ask = np.zeros((part.num_rows, first[-1]), bool)
            ask[row, lists] = True
            for b, (s, e) in enumerate(pairwise(first)):
                some = np.flatnonzero(ask[:, s:e].any(1))
                if len(some):
                    yield part, b, some, np.packbits(ask[some, s:e], axis=1)

    return bins


def _asked(queries: DataFrame, shared, choose, beam: int, first: list[int]) -> dict[int, int]:
    """Number of queries that ask each bin."""
    wanted = _wanted(shared, choose, beam, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.zeros(len(first) - 1, np.int64)
        for _, b, some, _ in wanted(batches):
            asked[b] += len(some)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(asked)), pa.int32()), pa.array(asked)], names=["bin", "n"])

    return dict(queries.mapInArrow(run, "bin int, n long").groupBy("bin").sum("n").collect())  # one row a bin


def _posed(queries: DataFrame, shared, choose, beam: int, first: list[int], parts: list[int], asks: list[int], base: list[int]) -> DataFrame:
    """Rows (g, list, rep, v, ids, bits): each query with its lists in each bin, for every block of the bin."""
    wanted = _wanted(shared, choose, beam, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, b, some, bits in wanted(batches):
            rep = part.column(0).to_numpy()[some]
            ask = (rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(asks[b])
            v = part.column(1)
            rows = max(1, SENT_BYTES * part.num_rows // max(1, part.nbytes))
            for p in range(parts[b]):
                g = base[b] + p * asks[b] + ask.astype(np.int64)
                for k in range(0, len(some), rows):
                    n = len(some[k:k + rows])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[k:k + n], pa.int32()), pa.array(np.full(n, QUERY), pa.int32()), pa.array(rep[k:k + n]), v.take(pa.array(some[k:k + n])),
                         pa.nulls(n, pa.list_(pa.int64())), pa.array([x.tobytes() for x in bits[k:k + n]], pa.binary())],
                        names=["g", "list", "rep", "v", "ids", "bits"])

    return queries.mapInArrow(run, f"g int, list int, rep long, v {_kind(queries)}, ids array<long>, bits binary")


def _looked_up(values: list[int], key: str) -> Column:
    """The value for a small number, from a literal table."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>"), F.col(key))


class Block:
    """Stored rows of a bin, by list, and the best of queries among them."""

    def __init__(self, batches: list[pa.RecordBatch], first: int, lists: int, k: int):
        held = np.concatenate([b.column("list").to_numpy() for b in batches])
        self.starts = np.searchsorted(held, first + np.arange(lists + 1))
        self.rep = np.concatenate([b.column("rep").to_numpy() for b in batches])
        self.ids = np.concatenate([b.column("ids").flatten().to_numpy() for b in batches])
        counts = np.concatenate([b.column("ids").value_lengths().to_numpy() for b in batches]).astype(np.int64)
        self.to = np.cumsum(counts)
        self.counts, self.k, self.top = counts, k, 2 * k
        self.x = np.concatenate([_matrix(b.column("v")) for b in batches])
        mix, sums = np.random.default_rng(7).normal(size=self.x.shape[1]), []
        self.norm = 0.0
        for s in range(0, len(self.x), ROWS):
            x = self.x[s:s + ROWS].astype(np.float64)
            self.norm = max(self.norm, math.sqrt((x * x).sum(1).max()))
            sums.append((x * mix).sum(1))
        # a class stands in several lists: same id, same sum of its vector; classes are numbered in order of their ids
        mixed = np.concatenate(sums)
        order = np.lexsort((mixed, self.rep))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(self.rep[order]) != 0) | (np.diff(mixed[order]) != 0)
        self.at, self.one = order[new], np.empty(len(order), np.int64)
        self.one[order] = np.cumsum(new) - 1
        if not 1e-12 < self.norm < 1e12:  # products in single precision may leave its range
            self.x = self.x.astype(np.float64)

    def _best(self, q: np.ndarray, bound: np.ndarray, kept: tuple[np.ndarray, np.ndarray], hits: list) -> tuple[np.ndarray, np.ndarray]:
        """Keys (row and class in one number, ascending) and exact scores of the best that were kept or found anew; raises ``bound``."""
        key, score = kept
        new = np.sort(np.concatenate([key[:0], *(row * len(self.at) + self.one[place] for row, place in hits)]))
        new = new[np.append(True, new[1:] != new[:-1])] if len(new) else new
        if len(key):
            new = new[key[np.minimum(np.searchsorted(key, new), len(key) - 1)] != new]
        exact = [score]
        for s in range(0, len(new), 8192):
            row, one = np.divmod(new[s:s + 8192], len(self.at))
            exact.append((self.x[self.at[one]].astype(np.float64) * q[row]).sum(1))
        key, score = np.concatenate((key, new)), np.concatenate(exact)
        order = np.argsort(key)
        key, score = key[order], score[order]
        row = key // len(self.at)
        order = np.lexsort((-score, row))  # of equal scores the smaller id first
        rank = np.arange(len(row)) - np.searchsorted(row, np.arange(len(q)))[row]
        last = order[rank == self.top - 1]
        bound[row[last]] = np.maximum(bound[row[last]], score[last])
        best = np.sort(order[rank < self.top])
        return key[best], score[best]

    def best(self, queries: pa.RecordBatch) -> pa.RecordBatch:
        """(rep, ids, scores): the best k + 1 ids for each query of a chunk."""
        q = _matrix(queries.column("v")).astype(np.float64)
        single = q.astype(self.x.dtype)
        # what rounding can change in a product, and no more than it can in any order of the sum
        slack = 2 * (q.shape[1] + 2) * np.finfo(self.x.dtype).eps * np.sqrt((q * q).sum(1)) * self.norm + 1e-35
        bits = np.frombuffer(b"".join(queries.column("bits").to_pylist()), np.uint8).reshape(len(q), -1)
        asks = np.ascontiguousarray(np.unpackbits(bits, axis=1, count=len(self.starts) - 1).T).view(bool)
        bound, hits, held = np.full(len(q), -np.inf), [], 0
        kept = (np.zeros(0, np.int64), np.zeros(0))
        for one in np.flatnonzero(asks.any(1)):
            rows = np.flatnonzero(asks[one])
            some = single[rows]
            for s in range(self.starts[one], self.starts[one + 1], ROWS):
                score = some @ self.x[s:min(s + ROWS, self.starts[one + 1])].T
                low = bound[rows] - slack[rows]
                new = np.flatnonzero(np.isneginf(low))
                if len(new) and score.shape[1] >= self.top:
                    place = score.shape[1] - self.top
                    bound[rows[new]] = np.partition(score[new], place, axis=1)[:, place] - slack[rows[new]]
                    low = bound[rows] - slack[rows]
                least = np.nextafter(low.astype(score.dtype), np.array(-np.inf, score.dtype))
                row, at = np.divmod(np.flatnonzero(score >= least[:, None]), score.shape[1])
                hits.append((rows[row], s + at))
                held += len(row)
                if held > HITS:
                    kept, hits, held = self._best(q, bound, kept, hits), [], 0
        key, score = self._best(q, bound, kept, hits)
        row, one = np.divmod(key, len(self.at))
        place = self.at[one]
        order = np.lexsort((-score, self.rep[place], row))
        row, place, score = row[order], place[order], score[order]
        once = np.ones(len(row), bool)  # an id with several vectors counts with its best
        once[1:] = (np.diff(row) != 0) | (np.diff(self.rep[place]) != 0)
        row, place, score = row[once], place[once], score[once]
        order = np.lexsort((-score, row))
        row, place, score = row[order], place[order], score[order]
        counts = self.counts[place]
        before = np.cumsum(counts) - counts
        before -= before[np.searchsorted(row, row)] if len(row) else 0
        least = np.full(len(q), np.inf)
        np.minimum.at(least, row[before <= self.k], score[before <= self.k])
        near = score >= least[row]  # with all that tie with the last
        row, place, score, counts = row[near], place[near], score[near], counts[near]
        ids = self.ids[np.repeat(self.to[place] - np.cumsum(counts), counts) + np.arange(counts.sum())]
        row, score = np.repeat(row, counts), np.repeat(score, counts)
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        near = np.arange(len(row)) - np.searchsorted(row, row) <= self.k
        ends = pa.array(np.searchsorted(row[near], np.arange(len(q) + 1)), pa.int32())
        return pa.RecordBatch.from_arrays([queries.column("rep"), pa.ListArray.from_arrays(ends, pa.array(ids[near])),
                                           pa.ListArray.from_arrays(ends, pa.array(score[near]))], names=["rep", "ids", "scores"])


def _scan(k: int, first: list[int], bin_of: list[int]):
    """Rows (rep, ids, scores) of each group's queries: in order of group and list, the rows of a block come before its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, block = -1, [], None
        for batch in batches:
            g, asks = batch.column("g").to_numpy(), batch.column("list").to_numpy() == QUERY
            cut = np.flatnonzero((np.diff(g) != 0) | (np.diff(asks) != 0)) + 1
            for s, e in pairwise([0, *cut.tolist(), len(g)]):
                if e > s and g[s] != key:
                    key, rows, block = g[s], [], None
                if e > s and not asks[s]:
                    rows.append(batch.slice(s, e - s))
                elif rows or block:
                    if block is None:
                        b = bin_of[key]
                        block, rows = Block(rows, first[b], first[b + 1] - first[b], k), []
                    for at in range(s, e, CHUNK):
                        yield block.best(batch.slice(at, min(CHUNK, e - at)))

    return run


def _brute(queries: np.ndarray, reps: np.ndarray, k: int):
    """The best k other classes of each query in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, v = np.zeros((len(queries), 0)), None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x, rep = _matrix(batch.column(1).slice(at, ROWS)), batch.column(0).slice(at, ROWS).to_numpy()
                new = queries @ x.T.astype(np.float64)
                new[reps[:, None] == rep[None]] = -np.inf
                top = np.argsort(-new, axis=1, kind="stable")[:, :k] if new.shape[1] <= k else np.argpartition(-new, k - 1, axis=1)[:, :k]
                score = np.hstack((score, np.take_along_axis(new, top, 1)))
                v = x[top] if v is None else np.concatenate((v, x[top]), axis=1)
                order = np.argsort(-score, axis=1, kind="stable")[:, :k]
                score, v = np.take_along_axis(score, order, 1), np.take_along_axis(v, order[:, :, None], 1)
        if v is not None:
            ends = pa.array(np.arange(score.size + 1) * v.shape[2], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(queries)), score.shape[1]), pa.int32()), pa.array(score.ravel()),
                                              pa.ListArray.from_arrays(ends, pa.array(v.ravel()))], names=["query", "score", "v"])

    return run


def measured_reach(classes: DataFrame, queries: DataFrame, graph: CentroidGraph, lift: float, choose, k: int, goal: float) -> tuple[float, int]:
    """The distance ratio within which ``goal`` of the true neighbours lie, and the
    beam that holds the lists of that reach, from a few queries."""
    some = queries.orderBy(F.xxhash64("rep"), "rep").limit(CALIBRATE).toArrow()
    if not some.num_rows:
        return 0.0, BEAM
    q, reps = _matrix(some.column("v")).astype(np.float64), some.column("rep").to_numpy()
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    true = (classes.select("rep", "v").mapInArrow(_brute(q, reps, k), f"query int, score double, v {_kind(classes)}")
            .where("score > double('-infinity')").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("query", "v").toArrow())
    to_all = graph.to_all(np.column_stack((q, np.zeros(len(q)))))
    if not true.num_rows:
        return 0.0, BEAM
    x = _matrix(true.column("v")).astype(np.float64)
    nodes, dist = graph.search(np.column_stack((x, np.sqrt(np.maximum(lift - (x * x).sum(1), 0)))), BEAM)
    mine = true.column("query").to_numpy()
    nearest_list = np.where(choose(nodes, dist), np.take_along_axis(to_all[mine], nodes, 1), np.inf).min(1)
    ratio = nearest_list / np.maximum(to_all.min(1)[mine], 1e-12) - 1
    reach = float(np.quantile(ratio, goal))
    return reach, int(1.25 * (to_all <= (1 + reach) * to_all.min(1, keepdims=True)).sum(1).max()) + BEAM


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = EVERY,
            list_rows: int = LIST_ROWS, spread: float = SPREAD, goal: float = GOAL, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id ``every`` divides."""
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    # one shuffle of the vectors; their hash only makes the sort cheap
    same = Window.partitionBy("h", "v")
    ranked = rows.withColumn("h", F.xxhash64("v")).withColumn("n", F.dense_rank().over(same.orderBy("id"))).where(F.col("n") <= k + 1)
    classes = (ranked.withColumn("ids", F.sort_array(F.collect_set("id").over(same))).withColumn("n", F.row_number().over(same.orderBy("id")))
               .where("n = 1").select(F.col("id").alias("rep"), "v", "ids"))
    classes = materialise(classes, "neighbours")
    n, lift, dim = _extent(classes)
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    wanted = min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim))
    share = math.ceil(min(1.0, wanted / n) * (1 << 20))
    sample = classes.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < share).orderBy("rep").select("v").limit(2 * wanted).toArrow()
    x = _matrix(sample.column("v")).astype(np.float64) if sample.num_rows else np.zeros((1, dim))
    x = np.column_stack((x, np.sqrt(np.maximum(lift - (x * x).sum(1), 0))))
    lists = min(MAX_LISTS, max(1, n // list_rows), max(1, len(x) // 8))
    graph = CentroidGraph(balanced_centroids(x, max(1, math.ceil(len(x) / lists))))
    shared = spark.sparkContext.broadcast(graph)  # at most about 2 * MAX_LISTS centroids

    def boundary(_, dist: np.ndarray) -> np.ndarray:
        keep = dist <= (1 + spread) * dist[:, :1]
        keep[:, REPLICAS:] = False
        keep[:, 0] = True
        return keep

    stored = materialise(_indexed(classes, shared, lift, boundary), "neighbours-lists")
    sizes = dict(stored.groupBy("list").count().collect())  # one row a list
    counts = [sizes.get(c, 0) for c in range(len(graph.c))]
    width = 4 if _kind(classes) == "array<float>" else 8
    block = min(block, max(1024, BIN_BYTES // (width * dim)), max(LEAST_BLOCK, sum(counts) // BLOCKS))
    first, bins = np.unique((np.cumsum(counts) - counts) // block, return_index=True, return_inverse=True)[1:]  # neighbouring leaves of the tree share a bin
    first = [*first.tolist(), len(counts)]

    def pruned(nodes: np.ndarray, dist: np.ndarray) -> np.ndarray:
        held = np.cumsum(np.array(counts)[nodes], axis=1)
        before = np.column_stack((np.zeros(len(nodes)), held[:, :-1]))
        return (dist <= (1 + reach) * dist[:, :1]) | (before < LEAST)

    # a class lists all of its ids, or k + 1 and maybe more: only these are looked up by their vectors
    mine, full = F.col("id") % every == 0, classes.where(F.size("ids") > k)
    asked = classes.select(F.explode("ids").alias("id"), "rep").where(mine)
    more = rows.where(mine).select("id", "v").distinct().join(full.select("v", "rep"), "v").select("id", "rep")
    asked = materialise(asked.union(more).distinct(), "neighbours-asked")
    listed = F.exists("ids", lambda x: x % every == 0)
    queries = classes.where(listed).select("rep", "v").union(
        full.where(~listed).select("rep", "v").join(asked.select("rep").distinct(), "rep", "left_semi"))
    queries = materialise(queries, "neighbours-queries")
    reach, beam = measured_reach(classes, queries, graph, lift, boundary, k, goal)
    asked_of = _asked(queries, shared, pruned, beam, first)

    held = np.bincount(bins, counts)
    parts = [max(1, round(n / block)) for n in held]
    asks = [max(1, math.ceil(asked_of.get(b, 0) / ASKS)) for b in range(len(held))]
    base = np.cumsum([0, *(p * a for p, a in zip(parts, asks, strict=True))]).tolist()
    bin_of = np.repeat(np.arange(len(held)), np.diff(base)).tolist()
    by = [_looked_up([values[b] for b in bins], "list") for values in (base, parts, asks)]
    least = by[0] + F.pmod(F.xxhash64("rep"), by[1]).cast("int") * by[2]
    dealt = stored.select(F.explode(F.sequence(least, least + by[2] - 1)).alias("g"), "list", "rep", "v", "ids", F.lit(None).cast("binary").alias("bits"))
    posed = _posed(queries, shared, pruned, beam, first, parts, asks, base)
    # a group is a block with some of its queries
    groups = dealt.union(posed).repartitionById(min(base[-1], GROUPS), "g").sortWithinPartitions("g", "list")
    found = groups.mapInArrow(_scan(k, first, bin_of), "rep long, ids array<long>, scores array<double>").repartition("rep")
    found = found.select("rep", F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))))
    ranked = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    best = (found.distinct().withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k + 1).drop("n"))
    answers = asked.join(best, "rep").where("vec_id <> id")
    final = Window.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select(F.col("id").alias("query_id"), "rank", "vec_id", "score"))
