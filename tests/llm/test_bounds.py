"""What the operators must do beyond usual sizes, and orders and scores against brute force."""
import itertools
import math
import random
import string
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from claimlake.llm import hilbert, mixture, neighbours, rule_quality, secret_scan, substring_dedup, token_count
from tests.conftest import SF_SMALL


# mixing -------------------------------------------------------------------------

def test_more_sources_than_the_network_takes(spark):
    n = 3_000
    df = spark.range(2 * n).selectExpr("id AS doc_id", "concat('site', lpad(cast(id % {0} AS string), 5, '0')) AS source".format(n), "repeat('w ', 1 + cast(id % 7 AS int)) AS text")
    got = mixture.mix(df).collect()
    sizes, taken = {}, {}
    for r in df.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    goals = mixture.targets(sizes, {s: mixture.WEIGHTS[k % 3] for k, s in enumerate(sorted(sizes))}, sum(sizes.values()))
    source = {r.doc_id: r.source for r in df.collect()}
    for r in got:
        assert (r.source_size, r.target) == (sizes[source[r.doc_id]], goals[source[r.doc_id]])
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert taken == {s: round(t) for s, t in goals.items()}
    several = df.withColumn("source", F.array("source"))
    assert sorted((r.doc_id, r.taken) for r in mixture.mix(several).collect()) == sorted((r.doc_id, r.taken) for r in got)


def test_overlaps_beyond_the_bound_are_told(spark):
    df = spark.range(60).selectExpr("id AS doc_id", "array(cast(id AS string), 'all') AS sources", "id AS size")
    with pytest.raises(ValueError, match="patterns overlap"):
        mixture.plan(df, max_patterns=50)


def test_flow_is_of_least_cost():
    """Against all ways to send whole tokens, with the costs 1, 2, 3 of repetitions."""
    rng = random.Random(6)
    for _ in range(25):
        patterns = [(s, rng.randint(1, 2)) for s in [("a",), ("a", "b"), ("b", "c")][:rng.randint(1, 3)]]
        quotas = {"a": rng.randint(0, 4), "b": rng.randint(0, 3), "c": rng.randint(0, 2)}
        flow = mixture.min_cost_flow(patterns, quotas, 3)

        def cost(sent, size):
            return sum(k + 1 for k in range(3) for _ in range(max(0, min(size, sent - k * size))))

        best = None
        routes = [(p, s) for p, (sources, _) in enumerate(patterns) for s in sources]
        for amounts in itertools.product(*[range(min(quotas[s], 3 * patterns[p][1]) + 1) for p, s in routes]):
            to, of = dict.fromkeys(quotas, 0), [0] * len(patterns)
            for (p, s), x in zip(routes, amounts, strict=True):
                to[s] += x
                of[p] += x
            if any(to[s] > quotas[s] for s in quotas) or any(of[p] > 3 * patterns[p][1] for p in range(len(patterns))):
                continue
            value = (-sum(of), sum(cost(of[p], patterns[p][1]) for p in range(len(patterns))))
            best = value if best is None else min(best, value)
        sums = [sum(f.values()) for f in flow]
        assert (-sum(sums), sum(cost(x, patterns[p][1]) for p, x in enumerate(sums))) == best


# sharding -----------------------------------------------------------------------

def brute_order(rows, bits):
    """doc_ids along the curve, of (doc_id, text, lang, source) without nulls in the id."""
    cells = 1 << bits
    sizes = sorted(len((t or "").encode()) + 16 for _, t, _, _ in rows)
    points = sorted({float(sizes[max(0, math.ceil((k + 1) / cells * len(sizes)) - 1)]) for k in range(cells - 1)})

    def texts(values):
        known = sorted(v for v in values if v is not None)
        firsts = {}
        for v in sorted(set(known)):
            firsts.setdefault(known.index(v) * cells // len(known), v)
        return lambda v: 0 if v is None else max(0, sum(f <= v for f in firsts.values()) - 1)

    lang, source = texts([r[2] for r in rows]), texts([r[3] for r in rows])
    ranks, states = hilbert.curve(3)

    def at(row):
        size = len((row[1] or "").encode()) + 16
        cell = [sum(p < size for p in points), lang(row[2]), source(row[3])]
        index = state = 0
        for bit in range(bits - 1, -1, -1):
            corner = sum(((c >> bit) & 1) << k for k, c in enumerate(cell))
            index, state = index * 8 + ranks[state * 8 + corner], states[state * 8 + corner]
        digest = xxhash.xxh64_intdigest((row[1] or "").encode(), 42)
        return index, digest - (1 << 64) * (digest >> 63), row[0]

    return [r[0] for r in sorted(rows, key=at)]


@pytest.mark.parametrize("seed,bits", [(1, 5), (2, 2)])
def test_the_order_is_that_of_the_curve(spark, seed, bits):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, "", "x" * rng.randint(1, 300), "é" * rng.randint(1, 50)]), rng.choice(["de", "en", None]),
             rng.choice([None, *[f"https://www.example.org/dataset_{k}" for k in range(8)]])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = [r.doc_id for r in sorted(hilbert.assign(df, shards=7, bits=bits).collect(), key=lambda r: (r.shard, r.slot))]
    assert got == brute_order(rows, bits)


def test_sources_of_one_beginning_are_told_apart(spark):
    df = spark.range(800).selectExpr("concat('dataset_', id % 8) AS v")
    assert hilbert.text_cuts(df, "v", 8) == [f"dataset_{k}" for k in range(8)]
    cells = df.select("v", hilbert.quantised(df, ["v"], 3)[0].alias("c")).distinct().collect()
    assert sorted((r.v, r.c) for r in cells) == [(f"dataset_{k}", k) for k in range(8)]


# quality --------------------------------------------------------------------------

def test_scores_are_those_of_the_rules(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = rule_quality.train(docs, labels)
    assert model.rules
    stats = rule_quality.statistics(docs.select("doc_id", "text"), "text").select("doc_id", "__stats.*").collect()
    names = list(rule_quality.STATISTICS)
    want = {}
    for r in stats:
        margin = model.intercept + sum(w for rule, w in model.rules
                                       if all((r[names[f]] <= x) if op == "<=" else (r[names[f]] > x) for f, op, x in rule))
        want[r.doc_id] = 1 / (1 + math.exp(-margin))
    got = {r.doc_id: (r.score, r.predicted) for r in rule_quality.scored(docs, model).collect()}
    assert got.keys() == want.keys() and all(got[d][0] == pytest.approx(s, rel=1e-9) and got[d][1] == int(s >= 0.3) for d, s in want.items())
    again = rule_quality.train(docs.repartition(7), labels)
    assert (again.intercept, again.rules) == (model.intercept, model.rules)


def test_the_fit_reads_the_texts_by_all_tasks(spark):
    docs = spark.range(0, 4000, 1, 24).selectExpr("id AS doc_id", "concat('Some words of document ', id, '.') AS text")
    labels = spark.range(4000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS label")
    spark.sparkContext.setJobGroup("fit", "fit")
    sample = rule_quality.labelled_sample(docs, labels, "doc_id", "text", 1000)
    rule_quality.fit(sample, trees=1, depth=1)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("fit") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s is not None) >= 24


# secrets ----------------------------------------------------------------------------

def test_secrets_found_and_ordinary_identifiers_left(spark):
    rng = random.Random(11)
    words = "configuration manager value document session request handler index builder context parser window account service".split()
    alphabet = string.ascii_letters + string.digits + "+/"
    secrets = ["".join(rng.choice(alphabet) for _ in range(rng.randint(24, 60))) for _ in range(300)]
    plain = [rng.choice(["_", "-", ""]).join(rng.choice(words).capitalize() if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randint(3, 6)))
             for _ in range(300)]
    rows = [(i, f"see {x} here") for i, x in enumerate(secrets + plain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id + 10000 AS doc_id", "text"))
    hit = {r.doc_id for r in secret_scan.scan(docs).where("spans LIKE '%markov%'").collect() if r.doc_id < 10000}
    found, wrong = len([d for d in hit if d < 300]), len([d for d in hit if d >= 300])
    assert found >= 0.97 * 300 and found / (found + wrong) >= 0.97, (found, wrong)


def test_long_tokens_take_time_in_proportion(spark):
    rng = random.Random(2)
    run = "".join(rng.choice(string.ascii_letters) for _ in range(1_000_000))
    hexes = " ".join("".join(rng.choice("0123456789abcdef") for _ in range(20)) for _ in range(50_000))
    for text in (run, hexes):
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.time()
        r = secret_scan.scan(df).first()
        assert time.time() - start < 60
        assert r.n_hex == (50_000 if text is hexes else 0)
        spans = r.spans.split(",")
        assert spans[0] == ("hex:0:20" if text is hexes else "markov:0:1000000")
        assert spans[-1] == (f"hex:{21 * 49_999}:{21 * 49_999 + 20}" if text is hexes else "markov:0:1000000")


# tokens and substrings ----------------------------------------------------------------

def test_counts_of_long_pretokens_are_not_kept():
    trie = token_count.UnigramTrie(["a", "b", "ab"])
    texts = ["ab" * 5_000 + "a" * k for k in range(20)]
    assert trie.count(texts)[0] == token_count.UnigramTrie(["a", "b", "ab"]).count(texts)[0]
    assert not any(len(w) > token_count.KEPT_CHARS for w in trie.counts) and trie.held == sum(map(len, trie.counts))


def test_substrings_of_the_longest_length(spark):
    length = substring_dedup.GRAM + 31
    with pytest.raises(ValueError):
        substring_dedup.dedup_substrings(spark.createDataFrame([], "doc_id long, text string"), length=length + 1)
    rng = random.Random(4)
    base = "".join(rng.choice("abcd") for _ in range(400))
    rows = [(0, base)] + [(k, "".join(rng.choice("xyz") for _ in range(rng.randint(0, 40))) + base[s:s + n] + "".join(rng.choice("xyz") for _ in range(9)))
                          for k, (s, n) in enumerate([(rng.randint(0, 300), rng.randint(40, 100)) for _ in range(60)], 1)]
    got = {r.doc_id: r.n_removed for r in substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), length=length).collect()}
    seen, want = set(), {}
    for d, t in rows:
        own = [t[i:i + length] for i in range(len(t) - length + 1)]
        mark = set()
        for i, w in enumerate(own):
            if w in seen:
                mark.update(range(i, i + length))
        want[d] = len(mark)
        seen.update(own)
    assert got == want


def test_many_rows_without_an_id_are_in_many_batches(spark):
    rng = random.Random(5)
    rows = [(None, "".join(rng.choice("abcdefgh") for _ in range(300))) for _ in range(200)] + [(1, "own text")]
    rows += [(None, rows[0][1]), (2, rows[1][1])]
    got = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), batch_bytes=2_000).collect()
    # rows without an id are one document after all others: what id 2 holds goes from them, their own repeats stay
    assert len(got) == len(rows) and sorted(r.n_removed for r in got)[-2:] == [0, 300]


# neighbours ---------------------------------------------------------------------

def vector_column(x):
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def stored_rows(lists, place, ids, x):
    order = np.argsort(lists, kind="stable")
    n, place = len(lists), place[order]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n), pa.int32()), pa.array(lists[order], pa.int32()), pa.array([ids[p][0] for p in place]), vector_column(x[place]),
         pa.array([ids[p] for p in place], pa.list_(pa.int64())), pa.nulls(n, pa.binary())], names=["g", "list", "rep", "v", "ids", "bits"])


def asking_rows(rep, x, asks):
    n = len(x)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n), pa.int32()), pa.array(np.full(n, neighbours.QUERY), pa.int32()), pa.array(rep), vector_column(x), pa.nulls(n, pa.list_(pa.int64())),
         pa.array([b.tobytes() for b in np.packbits(asks, axis=1)], pa.binary())], names=["g", "list", "rep", "v", "ids", "bits"])


def test_neighbours_memory_does_not_grow_with_the_lists_that_queries_want():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(256 * 32, 8)).astype(np.float32)
    stored = stored_rows(np.repeat(np.arange(256), 32), np.arange(len(x)), [[i] for i in range(len(x))], x)
    scan = neighbours._scan(20, [0, 256], [0])

    def peak(n):
        asked = [asking_rows(np.arange(2000), x[:2000], np.ones((2000, 256), bool)) for _ in range(n // 2000)]
        tracemalloc.start()
        found = sum(b.num_rows for b in scan(iter([stored, *asked])))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found == n
        return most

    few = peak(2000)
    assert few < 100e6 and peak(8000) < 1.2 * few  # 900 bytes for each list of each query would be 460 MB and 1.8 GB


@pytest.mark.parametrize("kind, whole, scale", [(np.float32, False, 1), (np.float32, True, 1), (np.float64, True, 1), (np.float32, False, 1e18), (np.float64, False, 1e-9)])
def test_neighbours_of_a_block_are_exact(kind, whole, scale):
    rng = np.random.default_rng(3)
    d, k = (3, 5) if whole else (12, 20)  # whole numbers tie
    x = np.unique((rng.integers(-2, 3, size=(1500, d)) if whole else rng.normal(size=(1500, d)) * scale).astype(kind), axis=0)
    x = x[rng.permutation(len(x))]
    ids = [[3 * i + 100_000 * c for c in range(1 + i % 4)] for i in range(len(x))]
    of = [rng.choice(30, rng.integers(1, 4), replace=False) for _ in x]
    lists, place = np.concatenate(of), np.repeat(np.arange(len(x)), [len(o) for o in of])
    n = min(100, len(x))
    asks = rng.random((n, 30)) < 0.4
    asks[0] = False
    stored = stored_rows(lists + 7, place, ids, x)
    asked = asking_rows(np.array([i[0] for i in ids[:n]]), x[:n], asks)
    found = [r for b in neighbours._scan(k, [0, 7, 37], [1])(iter([stored.slice(0, 99), stored.slice(99), asked.slice(0, 40), asked.slice(40)])) for r in b.to_pylist()]
    assert [r["rep"] for r in found] == [i[0] for i in ids[:n]]
    for row, r in enumerate(found):
        held = sorted(set(place[asks[row][lists]].tolist()))
        score = (x[held].astype(np.float64) * x[row].astype(np.float64)).sum(1).tolist()
        want = sorted((-v, i) for v, p in zip(score, held, strict=True) for i in ids[p])[:k + 1]
        assert [(-v, i) for v, i in zip(r["scores"], r["ids"], strict=True)] == want


def test_neighbours_in_many_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(700, 6)), 1)
    x[300:340] = 5 * x[300]  # more copies than a class lists
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(7, [float(v) for v in x[7]])] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = neighbours.nearest(df, k=5, every=4, list_rows=20, goal=1.0, spread=0.3).collect()
    assert {r.query_id for r in whole} == set(range(0, 700, 4))
    near = {q: [r.vec_id for r in sorted(whole, key=lambda r: r["rank"]) if r.query_id == q] for q in (300, 336)}
    assert near == {300: [301, 302, 303, 304, 305], 336: [300, 301, 302, 303, 304]}
    # several blocks a bin, several shares of its queries, several groups a partition
    for name, value in (("BLOCKS", 10_000), ("LEAST_BLOCK", 10), ("ASKS", 7), ("GROUPS", 5)):
        monkeypatch.setattr(neighbours, name, value)
    assert sorted(neighbours.nearest(df, k=5, every=4, list_rows=20, goal=1.0, spread=0.3).collect()) == sorted(whole)


def test_centroid_graph_of_many_dimensions():
    rng = np.random.default_rng(0)
    graph = neighbours.CentroidGraph(rng.normal(size=(2000, 40)))
    x = rng.normal(size=(100, 40))
    nodes, dist = graph.search(x, 24)
    brute = ((x[:, None] - graph.c[None]) ** 2).sum(-1)
    assert (nodes[:, 0] == brute.argmin(1)).mean() > 0.95 and (np.diff(dist, axis=1) >= 0).all()
    assert np.allclose(dist, np.sqrt(np.take_along_axis(brute, nodes, 1)), atol=1e-5) and all(len(set(row)) == 24 for row in nodes.tolist())
