"""Median, keep-top dedupe, panes, natural join, profiles, row index."""
import random

from pyspark.sql import functions as F

from claimlake.operators.aggregate import median_by_panes, sum_by_panes, trend_line
from claimlake.operators.dedupe import keep_top
from claimlake.operators.joins import natural_join
from claimlake.operators.median import grouped_median
from claimlake.operators.profile import describe_profile, distinct_profile, group_mean_profile
from claimlake.operators.rowindex import with_row_index


def _median(vals):
    v = sorted(x for x in vals if x is not None)
    if not v:
        return None
    n = len(v)
    lo, hi = v[(n - 1) // 2], v[n // 2]
    return lo if lo == hi else lo * 0.5 + hi * 0.5


def test_median_matches_exact_on_skewed_groups(spark):
    rnd = random.Random(7)
    rows = []
    # one hot group with a third of all rows, repeated values, nulls, tiny groups
    for i in range(3000):
        rows.append(("hot", float(rnd.randint(0, 400))))
    for g in range(60):
        for _ in range(rnd.randint(1, 40)):
            rows.append((f"g{g}", rnd.choice([None, float(rnd.randint(-50, 50)) / 4])))
    rows.append(("allnull", None))
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    expected = {}
    for k, v in rows:
        expected.setdefault(k, []).append(v)
    expected = {k: _median(v) for k, v in expected.items()}
    for accuracy in (10, 100, 10_000):
        assert {r.k: r.m for r in grouped_median(df, ["k"], "v", "m", accuracy=accuracy).collect()} == expected


def test_median_equals_the_built_in_on_extremes(spark):
    from pyspark.sql import functions as F
    inf, nan = float("inf"), float("nan")
    rows = [("a", 0.1), ("a", 0.7), ("b", inf), ("b", inf), ("c", 1e308), ("c", -1e308), ("d", -inf), ("d", 3.0), ("e", nan), ("e", 1.0), ("e", nan),
            ("f", -inf), ("f", inf), ("g", None), ("h", 0.0)] + [("i", i / 7) for i in range(30_000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    want = {r.k: repr(r.m) for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert {r.k: repr(r.m) for r in grouped_median(df, ["k"], "v", "m").collect()} == want
    longs = spark.createDataFrame([(1, 2 ** 62), (1, -2 ** 62), (1, 2 ** 62 - 1), (2, 2 ** 62), (2, 2 ** 62 - 5), (3, 7), (3, None)], "k int, v long")
    want = {r.k: r.m for r in longs.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert {r.k: r.m for r in grouped_median(longs, ["k"], "v", "m").collect()} == want


def test_median_plan_starts_no_job(spark):
    from claimlake.plans.jobs import dashboard_pack
    from claimlake.plans import catalogue
    from tests.conftest import SF_SMALL
    scored = catalogue.acp(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("median-plan", "plans only")
    dashboard_pack(scored)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not tracker.getJobIdsForGroup("median-plan")


def test_median_null_keys_and_two_keys(spark):
    rows = [(None, 1, 5.0), (None, 1, 7.0), ("a", 1, 1.0), ("a", 2, 2.0), ("a", 2, 4.0), ("a", 2, 9.0)]
    df = spark.createDataFrame(rows, "k string, j int, v double")
    got = {(r.k, r.j): r.m for r in grouped_median(df, ["k", "j"], "v", "m").collect()}
    assert got == {(None, 1): 6.0, ("a", 1): 1.0, ("a", 2): 4.0}


def test_keep_top_rules(spark):
    # keys equal with different predictions; equal on keys and prediction; null key
    rows = [("p1", 1, 10.0, 5.0), ("p1", 1, 12.0, 6.0), ("p2", 1, 8.0, 3.0), ("p2", 1, 8.0, 1.0),
            ("p3", None, 1.0, 1.0), ("p3", None, 2.0, 2.0), ("p4", 2, None, 1.0), ("p4", 2, 3.0, 9.0)]
    df = spark.createDataFrame(rows, "id string, flag int, prediction double, cost double")
    got = sorted(tuple(r) for r in keep_top(df, ["id", "flag"], "prediction", ["cost"]).collect())
    assert got == [("p1", 1, 12.0, 6.0), ("p2", 1, 8.0, 1.0), ("p3", None, 2.0, 2.0), ("p4", 2, 3.0, 9.0)]


def test_keep_top_properties(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 20), rnd.randint(0, 3), float(rnd.randint(0, 50)), float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int, p double, t double")
    out = keep_top(df, ["a", "b"], "p", ["t"]).collect()
    keys = [(r.a, r.b) for r in out]
    assert len(keys) == len(set(keys)) == len({(a, b) for a, b, _, _ in rows})
    best = {}
    for a, b, p, t in rows:
        cur = best.get((a, b))
        if cur is None or (p, -t) > (cur[0], -cur[1]):
            best[(a, b)] = (p, t)
    assert {(r.a, r.b): (r.p, r.t) for r in out} == best


def test_panes_are_one_grouping_per_column(spark):
    rows = [(1.0, 1, 2), (2.0, 1, 1), (4.0, 2, 1), (8.0, None, 2)]
    df = spark.createDataFrame(rows, "p double, c1 int, c2 int")
    s = {(r.condition, r.flag): r.s for r in sum_by_panes(df, ["c1", "c2"], "p", "s").collect()}
    assert s == {("c1", 1): 3.0, ("c1", 2): 4.0, ("c1", None): 8.0, ("c2", 1): 6.0, ("c2", 2): 9.0}
    m = {(r.condition, r.flag): r.m for r in median_by_panes(df, ["c1", "c2"], "p", "m").collect()}
    assert m[("c2", 2)] == 4.5 and m[("c1", None)] == 8.0


def test_panes_scan_input_once(spark):
    df = spark.range(100).select((F.col("id") * 1.0).alias("p"), (F.col("id") % 2).alias("c1"),
                                 (F.col("id") % 3).alias("c2"))
    plan = sum_by_panes(df, ["c1", "c2"], "p", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_trend_line(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 5.0), (3, 7.0)], "x int, y double")
    r = trend_line(df, "x", "y").first()
    assert (round(r.slope, 9), round(r.intercept, 9), round(r.r2, 9), r.n_marks) == (2.0, 1.0, 1.0, 3)


def test_natural_join_null_safe_many_to_many(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", 1)], "id int, f string, g int")
    b = spark.createDataFrame([("x", None, 10.0), ("x", None, 11.0), ("y", 2, 12.0)], "f string, g int, p double")
    got = sorted(tuple(r) for r in natural_join(a, b).collect())
    assert got == [(1, "x", None, 10.0), (1, "x", None, 11.0), (2, "x", None, 10.0), (2, "x", None, 11.0)]


def test_profiles(spark):
    df = spark.createDataFrame([("1", "a", "10"), ("2", None, "20"), ("2", "b", None), (None, "b", "x")],
                               "c1 string, c2 string, m string")
    d = {r.column_name: r.n_distinct for r in distinct_profile(df).collect()}
    assert d == {"c1": 3, "c2": 3, "m": 4}
    desc = {r.column_name: r for r in describe_profile(df).collect()}
    assert desc["c1"]["count"] == 3 and desc["c1"]["mean"] == 5 / 3 and desc["c1"]["min"] == "1"
    assert desc["c2"]["mean"] is None and desc["c2"]["max"] == "b"
    gm = {(r.column_name, r.value): r.avg_m for r in group_mean_profile(df, "m", ["c1"]).collect()}
    assert gm == {("c1", "1"): 10.0, ("c1", "2"): 20.0, ("c1", None): None}


def test_profile_is_one_job_shape(spark):
    df = spark.range(50).select(*[(F.col("id") % (i + 2)).alias(f"c{i}") for i in range(12)])
    plan = distinct_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_row_index_is_consecutive(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(9)
    out = with_row_index(df, [F.col("k").desc()], "i").collect()
    pairs = sorted((r.i, r.k) for r in out)
    assert [i for i, _ in pairs] == list(range(5000))
    assert [k for _, k in pairs] == list(range(4999, -1, -1))


def test_keep_top_string_and_date_tiebreaks(spark):
    import datetime as dt
    rows = [("k", 5.0, "b", dt.date(2009, 1, 1)), ("k", 5.0, "a", dt.date(2010, 1, 1)),
            ("j", None, "a", dt.date(2008, 1, 1)), ("j", 1.0, "z", dt.date(2008, 1, 1))]
    df = spark.createDataFrame(rows, "key string, p double, name string, d date")
    by_name = sorted(tuple(r) for r in keep_top(df, ["key"], "p", ["name"]).collect())
    assert by_name == [("j", 1.0, "z", dt.date(2008, 1, 1)), ("k", 5.0, "a", dt.date(2010, 1, 1))]
    by_date = {r.key: r.name for r in keep_top(df, ["key"], "p", ["d"]).collect()}
    assert by_date == {"k": "b", "j": "z"}


def test_approx_median_close(spark):
    df = spark.range(10001).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.0).alias("v"))
    exact = {r.g: r.m for r in grouped_median(df, ["g"], "v", "m").collect()}
    approx = {r.g: r.m for r in grouped_median(df, ["g"], "v", "m", approx_accuracy=10000).collect()}
    assert all(abs(exact[g] - approx[g]) <= 3.0 for g in exact)


def test_approx_distinct_within_error(spark):
    from claimlake.operators.aggregate import approx_distinct_columns
    df = spark.range(20000).select((F.col("id") % 7).alias("a"), (F.col("id") % 5003).alias("b"),
                                   F.col("id").cast("string").alias("c"))
    got = {r.column: r.approx_distinct for r in approx_distinct_columns(df, 0.02).collect()}
    exact = {"a": 7, "b": 5003, "c": 20000}
    for k, v in exact.items():
        assert abs(got[k] - v) <= 0.06 * v


def test_select_matching_and_slice(spark):
    from claimlake.operators.project import select_matching, select_slice
    df = spark.createDataFrame([(1, "a", "b", "c", 2.0)], "id int, HCPCS_CD_1 string, HCPCS_CD_2 string, CLM_DRG_CD string, x double")
    assert select_matching(df, r"HCPCS_CD_\d+|CLM_DRG_CD").columns == ["HCPCS_CD_1", "HCPCS_CD_2", "CLM_DRG_CD"]
    assert select_slice(df, 1, 3).columns == ["HCPCS_CD_1", "HCPCS_CD_2"]


def test_random_split_seeded_and_complete(spark):
    from claimlake.plans.model import random_split
    df = spark.range(2000)
    a, b = random_split(df, 0.7, seed=5)
    a2, _ = random_split(df, 0.7, seed=5)
    ids_a = {r.id for r in a.collect()}
    assert ids_a == {r.id for r in a2.collect()}
    assert ids_a.isdisjoint({r.id for r in b.collect()}) and len(ids_a) + b.count() == 2000
