"""Property tests: Spark expressions vs. plain-Python brute force on random inputs.

Each hypothesis example is a whole batch of values checked in one Spark job.
"""
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimlake.functions.text import path_basename, split_token, text_in_parens
from claimlake.operators.median import grouped_median
from claimlake.operators.rowindex import with_row_index
from claimlake.plans.links import filename_kind, link_kind

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab() _/.Z", max_size=14)), min_size=1, max_size=150)


def _tok(s, n, sep=" "):
    if s is None:
        return None
    parts = s.split(sep)
    try:
        return parts[n]
    except IndexError:
        return None


def _parens(s):
    if s is None or "(" not in s:
        return None
    return s.split("(", 1)[1].split(")")[0]


def _kind(text, child1):
    """The classification rules written out directly."""
    def fallback():
        return "zip_fallback" if _parens(child1) == "ZIP" else "ignored"
    if text is None or len(text.split(" ")) < 5:
        return fallback()
    t = text.split(" ")
    if t[4] == "Beneficiary":
        return "beneficiary"
    return {"Inpatient": "inpatient", "Outpatient": "outpatient",
            "Prescription": "drug_events"}.get(t[-3], "ignored")


@SETTINGS
@given(texts)
def test_text_rules_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select(split_token("s", 0), split_token("s", 4), split_token("s", -3),
                    split_token("s", 1, "_"), text_in_parens("s"), path_basename("s")).collect()
    for v, r in zip(values, got):
        assert tuple(r) == (_tok(v, 0), _tok(v, 4), _tok(v, -3), _tok(v, 1, "_"), _parens(v),
                            None if v is None else v.split("/")[-1])


words = st.sampled_from(["DE1.0", "Sample", "1", "Beneficiary", "Inpatient", "Outpatient",
                         "Prescription", "Claims", "", "x"])
anchor = st.tuples(st.one_of(st.none(), st.lists(words, max_size=8).map(" ".join)),
                   st.one_of(st.none(), st.sampled_from([" (ZIP)", "(ZIP)", " (ZIP, 4MB)", "ZIP", " (zip)", ""])))


@SETTINGS
@given(st.lists(anchor, min_size=1, max_size=150))
def test_link_kind_matches_rules(spark, rows):
    df = spark.createDataFrame(rows, "text string, child1 string")
    got = [r[0] for r in df.select(link_kind(F.col("text"), F.col("child1"))).collect()]
    assert got == [_kind(t, c) for t, c in rows]


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(["1DE1", "0", "2008", "to", "2010", "Inpatient", "Outpatient",
                                          "Beneficiary", "Claims"]), max_size=8).map("_".join),
                min_size=1, max_size=100))
def test_filename_kind_matches_rules(spark, names):
    def ref(n):
        if _tok(n, 5, "_") == "Inpatient":
            return "inpatient"
        if _tok(n, 5, "_") == "Outpatient":
            return "outpatient"
        return "beneficiary" if _tok(n, 3, "_") == "Beneficiary" else None
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(filename_kind(F.col("n"))).collect()] == [ref(n) for n in names]


@SETTINGS
@given(st.integers(min_value=0, max_value=10_000), st.sampled_from([10, 50, 10_000]))
def test_median_matches_brute_force(spark, seed, accuracy):
    rnd = random.Random(seed)
    rows = []
    for g in range(rnd.randint(1, 6)):
        hot = rnd.random() < 0.3
        for _ in range(rnd.randint(0, 400 if hot else 30)):
            rows.append((g, rnd.choice([None] + [float(rnd.randint(-20, 20))] * 3)))
    if not rows:
        rows = [(0, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.m for r in grouped_median(df, ["g"], "v", "m", accuracy=accuracy).collect()}
    exp = {}
    for g, v in rows:
        exp.setdefault(g, []).append(v)
    for g, vs in exp.items():
        v = sorted(x for x in vs if x is not None)
        exp[g] = None if not v else v[(len(v) - 1) // 2] + (v[len(v) // 2] - v[(len(v) - 1) // 2]) * 0.5
    assert got == exp


@SETTINGS
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=300),
       st.integers(min_value=1, max_value=7))
def test_row_index_matches_sorted_positions(spark, values, parts):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long").repartition(parts)
    got = {r.id: r.i for r in with_row_index(df, [F.col("v").desc(), F.col("id")], "i").collect()}
    order = sorted(range(len(values)), key=lambda i: (-values[i], i))
    assert got == {i: pos for pos, i in enumerate(order)}
