"""Model properties and physical-plan shape checks."""
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from claimlake.plans import catalogue as C
from claimlake.plans import standins as si
from claimlake.plans.model import fit, hash_split, run
from claimlake.schemas import DEDUPE_KEYS, PREDICTIONS
from tests.conftest import SF_ORACLE, SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_disjoint_complete_and_stable(spark):
    f = C.features(spark, SF_ORACLE)
    tr, te = hash_split(f)
    a = {(r.PATIENT_ID, r.AGE_YRS) for r in tr.select("PATIENT_ID", "AGE_YRS").collect()}
    b = {(r.PATIENT_ID, r.AGE_YRS) for r in te.select("PATIENT_ID", "AGE_YRS").collect()}
    assert not a & b and len(a) + len(b) == f.count()
    assert 0.6 < len(a) / (len(a) + len(b)) < 0.8
    tr2, _ = hash_split(f.repartition(13))
    assert {(r.PATIENT_ID, r.AGE_YRS) for r in tr2.select("PATIENT_ID", "AGE_YRS").collect()} == a


def test_full_model_beats_single_feature_and_residuals_centre(spark):
    m = run(C.features(spark, SF_ORACLE))
    r2_full = m.r2("train")
    one = VectorAssembler(inputCols=["AGE_YRS"], outputCol="x").transform(m.train)
    r2_one = fit(one, "x").evaluate(one).r2
    assert r2_full >= r2_one - 1e-12
    res = m.model.transform(m.train).select(F.avg(F.col("ANNUAL_COST") - F.col("prediction"))).first()[0]
    assert abs(res) < 1e-6 * max(1.0, abs(m.train.select(F.avg("ANNUAL_COST")).first()[0]))


def test_scored_table_shape_and_unique_keys(spark):
    out = C.QUERIES["annual_cost_predictions"](spark, SF_SMALL)
    assert out.columns == [n for n, _ in PREDICTIONS]
    assert dict(out.dtypes)["DX"] == "int" and dict(out.dtypes)["features"] == "string"
    assert out.count() == out.select(*DEDUPE_KEYS).distinct().count()
    assert "CollectLimit" not in _plan(out)


def test_feature_scan_reads_only_needed_columns(spark):
    plan = _plan(C.features(spark, SF_SMALL))
    # customer: 5 of 5 used; orders: o_orderdate, o_custkey, o_orderkey, o_orderpriority, o_orderstatus (not o_totalprice)
    orders_scan = [l for l in plan.splitlines() if "orders.parquet" in l or "o_orderkey" in l and "ReadSchema" in l]
    assert orders_scan, plan
    assert all("o_totalprice" not in l for l in plan.splitlines() if "ReadSchema" in l and "o_custkey" in l)


def test_filter_pushed_to_parquet(spark):
    df = si.inp(spark, SF_SMALL).where(F.col("CLM_ID") > 100)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,100)]" in plan


def test_join_aggregates_claims_before_joining(spark):
    plan = C.features(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    join_pos, agg_pos = plan.find("Join Inner"), plan.find("Aggregate [DESYNPUF_ID")
    assert 0 <= join_pos < agg_pos  # aggregate sits below (inside) the join


def test_earlier_model_variant(spark):
    from claimlake.plans.model import V1_CATEGORICALS, V1_FEATURES
    m = run(C.features(spark, SF_SMALL), categoricals=V1_CATEGORICALS, feature_cols=V1_FEATURES)
    assert len(m.model.coefficients) == 7
    assert "SP_CHF_index" not in m.scored.columns and "STATE_index" in m.scored.columns


def test_feature_table_edge_cases(spark):
    import datetime as dt

    from claimlake.plans.features import feature_table
    from claimlake.schemas import CONDITION_FLAGS
    flags = ", ".join(f"{c} smallint" for c in CONDITION_FLAGS)
    ben_schema = (f"DESYNPUF_ID string, BENE_BIRTH_DT date, BENE_SEX_IDENT_CD smallint, BENE_RACE_CD smallint, "
                  f"SP_STATE_CODE smallint, {flags}, BENRES_IP double")
    f1, f2 = [1] * len(CONDITION_FLAGS), [2] * len(CONDITION_FLAGS)
    ben = spark.createDataFrame([
        ("A", dt.date(1940, 1, 1), 1, 1, 5, *f1, 0.0),      # two years of one patient, other flags
        ("A", dt.date(1940, 1, 1), 1, 1, 5, *f2, 300.0),
        ("B", dt.date(1950, 6, 1), 2, 3, 7, *f1, 10.0),     # all claims blank-dated
        ("C", dt.date(1960, 1, 1), 2, 2, 9, *f1, 20.0),     # no claims
    ], ben_schema)
    inp = spark.createDataFrame([
        ("A", dt.date(2009, 1, 1), "4280", "nan", None),
        ("A", dt.date(2010, 1, 1), "nan", "9904", "nan"),
        ("A", None, None, "V5789", None),
        ("B", None, "V5789", None, None),
        ("Z", dt.date(2009, 1, 1), "4280", "1", "2"),        # claims without a beneficiary
    ], "DESYNPUF_ID string, CLM_FROM_DT date, ICD9_DGNS_CD_1 string, ICD9_PRCDR_CD_1 string, HCPCS_CD_1 string")
    rows = feature_table(ben, inp).collect()
    assert sorted(r.PATIENT_ID for r in rows) == ["A", "A", "B"]
    a = [r for r in rows if r.PATIENT_ID == "A"]
    assert {(r.DX, r.PX, r.HCPCS) for r in a} == {(1, 2, 0)}
    assert {r.ANNUAL_COST for r in a} == {0.0, 300.0} and {r.SP_CHF for r in a} == {1, 2}
    assert a[0].AGE_YRS == (dt.date(2010, 1, 1) - dt.date(1940, 1, 1)).days / 365.0
    b = next(r for r in rows if r.PATIENT_ID == "B")
    assert b.AGE_YRS == (dt.date(2008, 1, 1) - dt.date(1950, 6, 1)).days / 365.0  # filled claim date


def test_keep_top_combines_map_side(spark):
    from claimlake.operators.dedupe import keep_top
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 1.0).alias("p"), "id")
    plan = _plan(keep_top(df, ["k"], "p", ["id"]))
    assert "partial_min" in plan and "Window" not in plan


def test_median_combines_map_side_and_keeps_no_group_whole(spark):
    from claimlake.operators.median import grouped_median
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), (F.col("id") * 1.0).alias("v"))
    plan = _plan(grouped_median(df, ["g"], "v", "m"))
    assert "partial_percentile_approx" in plan and "partial_count" in plan
    assert " median(" not in plan and "percentile(" not in plan.replace("percentile_approx(", "")


def test_rows_without_inputs_are_kept_and_counted(spark):
    f = C.features(spark, SF_SMALL)
    n = f.count()
    k = F.col("PATIENT_ID").cast("long") % 10
    holes = f.withColumn("AGE_YRS", F.when(k != 0, F.col("AGE_YRS"))).withColumn("ANNUAL_COST", F.when(k != 1, F.col("ANNUAL_COST")))
    m = run(holes)
    assert m.train.count() + m.test.count() + m.rejected.count() == n
    assert m.rejected.where("AGE_YRS is not null and ANNUAL_COST is not null").count() == 0
    assert m.scored.where("prediction is null").count() == 0
    m.release()


def test_no_cache_is_left(spark):
    from claimlake.plans.model import annual_cost_predictions
    spark.catalog.clearCache()
    annual_cost_predictions(C.features(spark, SF_SMALL)).count()
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
