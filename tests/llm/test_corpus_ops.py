"""Operators on whole tables against brute force."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from claimlake.llm import components, hilbert, mixture, neighbours, rule_quality, simhash, substring_dedup
from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_rows

# substring dedup ----------------------------------------------------------------


def removed(rows, length=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            first[w] = min(first.get(w, (2, 0)), (d is None, d or 0))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone, at = np.zeros(len(b), bool), (d is None, d or 0)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < at:
                gone[i:i + length] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [{}, {"batch_bytes": 20_000, "part_phrases": 300}, {"batch_bytes": 3_000, "part_phrases": 40}])
def test_substrings(edge, sizes, monkeypatch):
    got = substring_dedup.dedup_substrings(edge, **sizes)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == removed(edge_rows())


def test_substrings_pieces_of_long_texts(monkeypatch):
    rng = np.random.default_rng(3)
    text = rng.integers(97, 101, 5_000).astype(np.uint8).tobytes()
    for piece in (64, 700, 1 << 20):
        monkeypatch.setattr(substring_dedup, "PIECE", piece)
        p = substring_dedup.Parse([text, b"short", text[:49], text[100:150]], 50)
        for d, n in ((0, len(text) - 49), (3, 1)):  # every window in exactly one phrase
            own = [i for k in np.flatnonzero(p.doc == d) for i in range(p.first[k], p.last[k] + 1)]
            assert sorted(own) == list(range(n))


def test_substrings_texts_and_empty(spark, no_docs):
    line = "this line of more than fifty bytes stands in both of the documents"
    df = spark.createDataFrame([(2, f"b {line} tail"), (1, f"a {line}!"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in substring_dedup.dedup_substrings(df, texts=True).collect()}
    assert got == {1: f"a {line}!".encode(), 2: b"b tail", 3: b""}
    assert substring_dedup.dedup_substrings(no_docs).count() == 0


# neighbours ---------------------------------------------------------------------

def vectors(n=1500, d=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d)) * 2
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, d)) * 0.7
    x[100:500] = x[100]  # a large group of copies
    return [(int(i), [float(v) for v in row]) for i, row in enumerate(x.astype(np.float32))]


def exact(rows, k, every):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in zip(ids, x, strict=True):
        if i % every == 0:
            score = (x * v).sum(1)
            score[ids == i] = -np.inf
            order = np.lexsort((ids, -score))[:min(k, len(ids) - 1)]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_neighbours_recall_scores_and_ties(spark):
    rows = vectors()
    odd = [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (9060, [1.0, None] + [0.0] * 14), (9080, [float("inf")] * 16), (9100, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd + rows[200:203], "vec_id long, embedding array<float>").selectExpr("*", "1 as rank", "2 as list", "3 as v", "4 as ids")
    want = exact(rows, 20, 20)
    got = {}
    for r in neighbours.nearest(df, list_rows=40, block=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    x = {i: np.array(v) for i, v in rows}
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        assert [f[1:] for f in found] == sorted([f[1:] for f in found], key=lambda f: (-f[1], f[0]))
        assert all(abs(s - float((x[v] * x[q]).sum())) < 1e-9 for _, v, s in found)
        hits += len({f[1] for f in found} & {v for v, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)
    assert [f[1] for f in got[200]] == [v for v, _ in want[200]]  # copies: smallest ids first


def test_neighbours_few_rows(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 1.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in neighbours.nearest(df).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 3, -1.0)]
    assert neighbours.nearest(df.limit(0)).count() == 0
    assert neighbours.nearest(df.where("vec_id = 20")).count() == 0


def test_centroid_graph_finds_the_nearest():
    rng = np.random.default_rng(0)
    c = neighbours.balanced_centroids(rng.normal(size=(4000, 8)), 20)
    graph = neighbours.CentroidGraph(c)
    x = rng.normal(size=(200, 8))
    nodes, dist = graph.search(x, 48)
    brute = ((x[:, None] - graph.c[None]) ** 2).sum(-1).argmin(1)
    assert (nodes[:, 0] == brute).mean() > 0.97 and (np.diff(dist, axis=1) >= 0).all()
    assert all(len(set(row)) == len(row) for row in nodes.tolist())


# simhash ------------------------------------------------------------------------

def fingerprint(text, shingle=4):
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(pairs):
    """Smallest node of each node's component."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def test_simhash_components(edge):
    rows = edge_rows()
    fps = [(d, fingerprint(t)) for d, t in rows]
    known = [(d, f) for d, f in fps if d is not None]
    comp = grouped([(a, b) for a, x in known for b, y in known if (x ^ y).bit_count() <= 4])
    by_fp = {f: comp[d] for d, f in known}
    want = sorted(((d, f"{f:016x}", by_fp.get(f)) for d, f in fps), key=repr)
    assert sorted((tuple(r) for r in simhash.near_duplicates(edge).collect()), key=repr) == want


@pytest.mark.parametrize("segments,block", [(2, 20_000), (3, 20_000), (4, 20_000), (4, 7), (3, 5)])
def test_simhash_links_are_exact(spark, segments, block):
    rng = random.Random(8)
    fps = {rng.getrandbits(64) for _ in range(250)}
    for f in list(fps)[:120]:  # at all distances about the radius
        fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    dense = rng.getrandbits(64)  # a dense group in one segment value
    fps |= {dense ^ sum(1 << b for b in rng.sample(range(30), 2)) for _ in range(150)}
    rows = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(sorted(fps))]
    df = spark.createDataFrame(rows, "fp long, rep long")
    got = grouped([(r.a, r.b) for r in simhash.links(df, 4, segments, block).collect()])
    want = grouped([(i, j) for f, i in rows for g, j in rows if i < j and ((f ^ g) & ((1 << 64) - 1)).bit_count() <= 4])
    assert got == want


def test_simhash_stars_cover_small_pair_batches():
    import pyarrow as pa
    n = 60
    key = np.zeros(2 * n, np.int64)
    role = np.repeat([0, 1], n).astype(np.int32)
    fp = np.tile(np.arange(n, dtype=np.int64) & 3, 2)
    rep = np.tile(np.arange(n, dtype=np.int64), 2)
    for cut in (1, 7, 2 * n):
        batches = [pa.RecordBatch.from_arrays([pa.array(x[k:k + cut]) for x in (key, role, fp, rep)], names=["key", "role", "fp", "rep"]) for k in range(0, 2 * n, cut)]
        edges = [e for b in simhash.linker(4, pairs=50)(batches) for e in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        assert set(grouped(edges).values()) == {0}


def test_simhash_keep_one_and_empty(spark, edge, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(1, text), (2, text), (2, text), (3, text + " x"), (4, "other words stand here"), (None, text), (4, "other words stand here")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 4, None]
    assert simhash.keep_one(edge).columns == edge.columns


def test_components_random(spark):
    rng = random.Random(6)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    star = [(2000, 2001 + i) for i in range(80)]
    loose = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)]
    pairs = chain + star + loose
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: r for x, r in grouped(pairs).items() if x in {y for p in pairs if p[0] != p[1] for y in p}}


# mixture ------------------------------------------------------------------------

def test_mix_totals(edge):
    rows = mixture.mix(edge).collect()
    size = {d: len((t or "").encode().split()) for d, t in edge_rows() if d is not None}
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and (r.doc_id is None or r.size == size[r.doc_id])
        s = by.setdefault((r.source_size, r.target), [0, 0])
        s[0] += r.size
        s[1] += r.taken
    for (source_size, target), (total, taken) in by.items():
        assert total == source_size and abs(taken - target) <= 4 and target <= 3 * source_size
    assert abs(sum(t for _, t in by) - sum(s for s, _ in by)) < 1e-6
    assert sorted(map(tuple, mixture.mix(edge).collect()), key=repr) == sorted(map(tuple, rows), key=repr)


def test_mix_empty_and_all_blank(spark, no_docs, edge):
    assert mixture.mix(no_docs).count() == 0 and mixture.resample(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixture.mix(blank).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixture.resample(blank).count() == 2
    again = mixture.resample(edge)
    assert again.columns == edge.columns and again.count() > 0


def test_targets():
    assert mixture.targets({"a": 10, "b": 100, "c": 100}, {"a": 5, "b": 2, "c": 1}, 210) == {"a": 30.0, "b": 120.0, "c": 60.0}
    assert mixture.targets({"a": 0, "b": 7}, {"a": 5, "b": 2}, 7) == {"a": 0.0, "b": 7.0}


def test_min_cost_flow_uses_overlaps_and_few_repeats():
    patterns = [(("a", "b"), 100), (("a",), 10), (("b", "c"), 50)]
    flow = mixture.min_cost_flow(patterns, {"a": 60, "b": 60, "c": 40})
    assert [sum(f.get(s, 0) for f in flow) for s in "abc"] == [60, 60, 40]
    assert sum(flow[0].values()) <= 100 and sum(flow[1].values()) <= 10 and sum(flow[2].values()) <= 50  # no repeats needed
    rng = random.Random(2)
    for _ in range(200):  # as much as a maximal flow level by level
        names = "abcd"
        patterns = [(tuple(sorted(rng.sample(names, rng.randint(1, 3)))), rng.randint(0, 9)) for _ in range(4)]
        quotas = {s: rng.randint(0, 20) for s in names if any(s in p for p, _ in patterns)}
        flow = mixture.min_cost_flow(patterns, quotas, 2)
        for (sources, size), f in zip(patterns, flow, strict=True):
            assert all(v >= 0 for v in f.values()) and sum(f.values()) <= 2 * size and set(f) == set(sources)
        sent = sum(sum(f.values()) for f in flow)
        bit = {s: 1 << k for k, s in enumerate(quotas)}
        best = min(sum(q for s, q in quotas.items() if not m & bit[s])
                   + sum(2 * z for p, z in patterns if any(m & bit[s] for s in p)) for m in range(1 << len(quotas)))
        assert sent == best  # minimal cut
        assert all(sum(f.get(s, 0) for f in flow) <= q for s, q in quotas.items())


def test_mix_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i % 3 else ["b", "a"]) for i in range(300)] + [(900, "w", []), (901, "w w", None)]
    got = mixture.mix(spark.createDataFrame(rows, "doc_id long, text string, source array<string>")).collect()
    assert sum(r.taken for r in got) > 0 and all(r.taken == 0 for r in got if not r.sources)


# sharding -----------------------------------------------------------------------

@pytest.mark.parametrize("dims,bits", [(1, 3), (2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_is_a_walk_through_all_cells(spark, dims, bits):
    from pyspark.sql import functions as F
    df = spark.range(1 << dims * bits).select(*[F.expr(f"id >> {bits * k} & {(1 << bits) - 1}").alias(f"c{k}") for k in range(dims)])
    rows = df.withColumn("h", hilbert.hilbert_index([F.col(f"c{k}") for k in range(dims)], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(1 << dims * bits))
    assert all(sum(abs(x - y) for x, y in zip(a[:-1], b[:-1], strict=True)) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_shards(edge, no_docs):
    rows = hilbert.assign(edge).collect()
    text = dict(edge_rows())
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        if r.doc_id is not None:
            body = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(body) + 16, zlib.crc32(body))
    assert sorted(slots) == list(range(40)) and {len(s) for s in slots.values()} <= {len(rows) // 40, len(rows) // 40 + 1}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert hilbert.assign(no_docs).count() == 0 and hilbert.sharded(no_docs).count() == 0


def test_sharded_rows(edge):
    out = hilbert.sharded(edge)
    assert out.columns == [*[c for c in edge.columns if c not in ("shard", "slot")], "shard", "slot"]
    assert out.count() == edge.count() and out.select("shard", "slot").distinct().count() == edge.count()


def test_shards_use_no_python(edge):
    plan = hilbert.assign(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# quality ------------------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    folder = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = rule_quality.scored(docs, rule_quality.train(docs, labels))
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95 and np.mean([r.predicted == r.quality for r in rows]) > 0.93


def test_quality_edges(spark, edge, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 1), (3, None), (None, 1)], "doc_id long, quality int")
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        model = rule_quality.train(edge, known)
        out = rule_quality.scored(edge, model).collect()
        assert len(out) == edge.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
        assert rule_quality.scored(no_docs, model).count() == 0
        assert rule_quality.accepted(edge, model).columns == edge.columns
    assert rule_quality.train(no_docs, labels).rules == []


def test_quality_rules_from_a_printed_tree():
    tree = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=9
  If (feature 2 <= 0.5)
   If (feature 1 <= 1.0E-4)
    Predict: 0.0
   Else (feature 1 > 1.0E-4)
    Predict: 1.0
  Else (feature 2 > 0.5)
   Predict: 1.0
"""
    assert rule_quality.paths(tree) == [((2, "<=", 0.5),), ((2, "<=", 0.5), (1, "<=", 1e-4)), ((2, "<=", 0.5), (1, ">", 1e-4)), ((2, ">", 0.5),)]
