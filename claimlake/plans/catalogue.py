"""Named queries over the driver tables, each with its DuckDB twin.

``QUERIES[key](spark, sf_dir) -> DataFrame`` and ``ORACLES[key] -> SQL``.
Keys without an oracle are checked on rows only (model scores, run logs,
approximate counts).  Computed doubles whose value depends on summation
order are rounded to 4 places (sums) or 6 places (trend lines) on
both sides so the engines agree exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.plans import dashboards as dash
from claimlake.plans import standins as si
from claimlake.plans.features import (beneficiary_projection, claims_per_patient,
                                      feature_table)
from claimlake.session import scratch_path
from claimlake.schemas import (CONDITION_FLAGS, DASHBOARD_CONDITIONS, FEATURE_COLUMNS,
                               PREDICTIONS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def features(spark: SparkSession, sf: str) -> DataFrame:
    return feature_table(si.ben(spark, sf), si.inp(spark, sf))


def acp(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in scored table: features + deterministic prediction (oracle keys only)."""
    f = features(spark, sf)
    return f.withColumn("prediction", si.stand_in_prediction(F.col("AGE_YRS"), F.col("DX"), F.col("STATE")))


V = si.with_views
FLAG_LIST = ", ".join(CONDITION_FLAGS)
DASH_CONDS = [c for c, _ in DASHBOARD_CONDITIONS]


def _label_case(col: str) -> str:
    whens = " ".join(f"WHEN '{c}' THEN '{lbl.replace(chr(39), chr(39) * 2)}'"
                     for c, lbl in DASHBOARD_CONDITIONS)
    return f"CASE {col} {whens} END"


def _panes_sql(agg: str, alias: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS condition, {c} AS flag, prediction FROM acp" for c in DASH_CONDS)
    return V(f"""SELECT condition, flag, {agg} AS {alias}, {_label_case('condition')} AS label
FROM ({parts}) t GROUP BY condition, flag""", "acp")


# ------------------------------------------------------------ feature table
@register("feature_table", V("SELECT * FROM features", "features"))
def q_feature_table(spark, sf):
    return features(spark, sf)


@register("join_beneficiary_claims", V(
    """SELECT b.DESYNPUF_ID AS PATIENT_ID, b.BENRES_IP AS ANNUAL_COST, i.DESYNPUF_ID, i.CLM_ID,
  i.CLM_PMT_AMT FROM ben b JOIN inp i ON b.DESYNPUF_ID = i.DESYNPUF_ID""", "ben", "inp"))
def q_join_beneficiary_claims(spark, sf):
    """JO1 on raw claims: many claims per beneficiary, differently named keys."""
    from claimlake.operators.joins import join_on_keys
    b = si.ben(spark, sf).select(F.col("DESYNPUF_ID").alias("PATIENT_ID"),
                                 F.col("BENRES_IP").alias("ANNUAL_COST"))
    i = si.inp(spark, sf).select("DESYNPUF_ID", "CLM_ID", "CLM_PMT_AMT")
    return join_on_keys(b, i, "PATIENT_ID", "DESYNPUF_ID")


@register("agg_claims_by_patient", V(
    """SELECT DESYNPUF_ID,
  count(CASE WHEN ICD9_DGNS_CD_1 <> 'nan' THEN 1 END) AS DX,
  count(CASE WHEN ICD9_PRCDR_CD_1 <> 'nan' THEN 1 END) AS PX,
  count(CASE WHEN HCPCS_CD_1 <> 'nan' THEN 1 END) AS HCPCS,
  max(coalesce(CLM_FROM_DT, DATE '2008-01-01')) AS DATE
FROM inp GROUP BY DESYNPUF_ID""", "inp"))
def q_agg_claims_by_patient(spark, sf):
    return claims_per_patient(si.inp(spark, sf))


@register("agg_count_nonnull", V(
    """SELECT DESYNPUF_ID, count(ICD9_DGNS_CD_1) AS DX, count(ICD9_PRCDR_CD_1) AS PX,
  count(HCPCS_CD_1) AS HCPCS FROM inp GROUP BY DESYNPUF_ID""", "inp"))
def q_agg_count_nonnull(spark, sf):
    """AG2: the earlier model's counts of non-null codes ('nan' text counts)."""
    return si.inp(spark, sf).groupBy("DESYNPUF_ID").agg(
        F.count("ICD9_DGNS_CD_1").alias("DX"), F.count("ICD9_PRCDR_CD_1").alias("PX"),
        F.count("HCPCS_CD_1").alias("HCPCS"))


@register("agg_count_when", V(
    """SELECT ICD9_PRCDR_CD_1 AS PX_CODE, count(CASE WHEN ICD9_DGNS_CD_1 <> 'nan' THEN 1 END) AS DX,
  count(*) AS n_claims FROM inp GROUP BY ICD9_PRCDR_CD_1""", "inp"))
def q_agg_count_when(spark, sf):
    """AG3: conditional count (count of rows where the code is present)."""
    from claimlake.functions.clean import count_present
    return si.inp(spark, sf).groupBy(F.col("ICD9_PRCDR_CD_1").alias("PX_CODE")).agg(
        count_present("ICD9_DGNS_CD_1").alias("DX"), F.count(F.lit(1)).alias("n_claims"))


@register("agg_max_date", V(
    """SELECT DESYNPUF_ID, max(CLM_FROM_DT) AS last_claim_raw,
  max(coalesce(CLM_FROM_DT, DATE '2008-01-01')) AS DATE FROM inp GROUP BY DESYNPUF_ID""", "inp"))
def q_agg_max_date(spark, sf):
    from claimlake.functions.clean import fill_null_date
    return si.inp(spark, sf).groupBy("DESYNPUF_ID").agg(
        F.max("CLM_FROM_DT").alias("last_claim_raw"),
        F.max(fill_null_date("CLM_FROM_DT")).alias("DATE"))


@register("age_years", V("SELECT PATIENT_ID, AGE_YRS FROM features", "features"))
def q_age_years(spark, sf):
    return features(spark, sf).select("PATIENT_ID", "AGE_YRS")


@register("rounded_age_floor", V(
    "SELECT PATIENT_ID, CAST(floor(AGE_YRS) AS INTEGER) AS rounded_age FROM features", "features"))
def q_rounded_age_floor(spark, sf):
    from claimlake.functions.dates import rounded_age_floor
    return features(spark, sf).select("PATIENT_ID", rounded_age_floor("AGE_YRS").alias("rounded_age"))


@register("rounded_age_ceil", V(
    "SELECT PATIENT_ID, CAST(ceil(AGE_YRS) AS INTEGER) AS rounded_age FROM features", "features"))
def q_rounded_age_ceil(spark, sf):
    from claimlake.functions.dates import rounded_age_ceil
    return features(spark, sf).select("PATIENT_ID", rounded_age_ceil("AGE_YRS").alias("rounded_age"))


# --------------------------------------------------------------- dashboards
@register("sum_cost_by_age", V(
    """SELECT CAST(floor(AGE_YRS) AS INTEGER) AS rounded_age, round(sum(prediction), 4) AS sum_prediction
FROM acp GROUP BY 1""", "acp"))
def q_sum_cost_by_age(spark, sf):
    r = dash.sum_cost_by_age(acp(spark, sf))
    return r.withColumn("sum_prediction", F.round("sum_prediction", 4))


@register("median_cost_by_age", V(
    """SELECT CAST(ceil(AGE_YRS) AS INTEGER) AS rounded_age, median(prediction) AS median_prediction
FROM acp GROUP BY 1""", "acp"))
def q_median_cost_by_age(spark, sf):
    return dash.median_cost_by_age(acp(spark, sf))


@register("median_cost_by_race", V(
    "SELECT RACE, median(prediction) AS median_prediction FROM acp GROUP BY RACE", "acp"))
def q_median_cost_by_race(spark, sf):
    return dash.median_cost_by(acp(spark, sf), "RACE")


@register("median_cost_by_state", V(
    "SELECT STATE, median(prediction) AS median_prediction FROM acp GROUP BY STATE", "acp"))
def q_median_cost_by_state(spark, sf):
    return dash.median_cost_by(acp(spark, sf), "STATE")


@register("median_cost_by_condition", _panes_sql("median(prediction)", "median_prediction"))
def q_median_cost_by_condition(spark, sf):
    return dash.median_cost_by_condition(acp(spark, sf))


@register("median_cost_by_age_radix", ORACLES["median_cost_by_age"])
def q_median_cost_by_age_radix(spark, sf):
    """AG6 by radix selection: bins are shuffled, no rows."""
    return dash.median_cost_by_age(acp(spark, sf), method="radix")


@register("median_cost_by_race_radix", ORACLES["median_cost_by_race"])
def q_median_cost_by_race_radix(spark, sf):
    """AG7 by radix selection."""
    return dash.median_cost_by(acp(spark, sf), "RACE", method="radix")


@register("median_cost_by_state_radix", ORACLES["median_cost_by_state"])
def q_median_cost_by_state_radix(spark, sf):
    """AG8 by radix selection."""
    return dash.median_cost_by(acp(spark, sf), "STATE", method="radix")


@register("median_cost_by_condition_radix", ORACLES["median_cost_by_condition"])
def q_median_cost_by_condition_radix(spark, sf):
    """AG9 by radix selection."""
    return dash.median_cost_by_condition(acp(spark, sf), method="radix")


@register("median_cost_by_state_ranked", ORACLES["median_cost_by_state"])
def q_median_cost_by_state_ranked(spark, sf):
    """AG8 with a wide bracket, so that most values are ranked exactly."""
    return dash.median_cost_by(acp(spark, sf), "STATE", accuracy=10)


@register("median_cost_by_condition_ranked", ORACLES["median_cost_by_condition"])
def q_median_cost_by_condition_ranked(spark, sf):
    """AG9 with a wide bracket, so that most values are ranked exactly."""
    return dash.median_cost_by_condition(acp(spark, sf), accuracy=10)


@register("sum_cost_by_condition", _panes_sql("round(sum(prediction), 4)", "sum_prediction"))
def q_sum_cost_by_condition(spark, sf):
    r = dash.sum_cost_by_condition(acp(spark, sf))
    return r.withColumn("sum_prediction", F.round("sum_prediction", 4))


@register("condition_label", V(
    f"""SELECT condition, {_label_case('condition')} AS label, count(*) AS n_rows FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS condition FROM acp" for c in DASH_CONDS)}) t GROUP BY condition""",
    "acp"))
def q_condition_label(spark, sf):
    from claimlake.operators.aggregate import unpivot_panes
    long = unpivot_panes(acp(spark, sf).select("prediction", *DASH_CONDS), DASH_CONDS, "prediction")
    return (long.groupBy("condition").agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("label", dash.condition_label(F.col("condition"))))


@register("agg_record_count", V(
    "SELECT GENDER, CAST(sum(1) AS BIGINT) AS number_of_records FROM acp GROUP BY GENDER", "acp"))
def q_agg_record_count(spark, sf):
    return dash.records_by(acp(spark, sf), "GENDER")


@register("trend_cost_by_age", V(
    """SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
  round(regr_r2(y, x), 6) AS r2, CAST(regr_count(y, x) AS BIGINT) AS n_marks FROM (
  SELECT CAST(floor(AGE_YRS) AS INTEGER) AS x, round(sum(prediction), 4) AS y FROM acp GROUP BY 1) m""",
    "acp"))
def q_trend_cost_by_age(spark, sf):
    from claimlake.operators.aggregate import trend_line
    marks = dash.sum_cost_by_age(acp(spark, sf)).select(
        F.col("rounded_age"), F.round("sum_prediction", 4).alias("y"))
    t = trend_line(marks, "rounded_age", "y")
    return t.select(*[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2")], "n_marks")


@register("trend_median_cost_by_age", V(
    """SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
  round(regr_r2(y, x), 6) AS r2, CAST(regr_count(y, x) AS BIGINT) AS n_marks FROM (
  SELECT CAST(ceil(AGE_YRS) AS INTEGER) AS x, round(median(prediction), 6) AS y FROM acp GROUP BY 1) m""",
    "acp"))
def q_trend_median_cost_by_age(spark, sf):
    """AG12 on the second dashboard: trend over the median-by-rounded-up-age marks."""
    from claimlake.operators.aggregate import trend_line
    marks = dash.median_cost_by_age(acp(spark, sf)).select(
        F.col("rounded_age"), F.round("median_prediction", 6).alias("y"))
    t = trend_line(marks, "rounded_age", "y")
    return t.select(*[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2")], "n_marks")


@register("agg_default_measures", V(
    """SELECT round(sum(ANNUAL_COST), 4) AS sum_ANNUAL_COST, count(PATIENT_ID) AS count_PATIENT_ID,
  CAST(sum(DX) AS BIGINT) AS sum_DX, CAST(sum(STATE) AS BIGINT) AS sum_STATE FROM features""", "features"))
def q_agg_default_measures(spark, sf):
    from claimlake.operators.aggregate import default_measures
    r = default_measures(features(spark, sf).select("ANNUAL_COST", "PATIENT_ID", "DX", "STATE"))
    return r.withColumn("sum_ANNUAL_COST", F.round("sum_ANNUAL_COST", 4))


@register("approx_distinct_columns")
def q_approx_distinct_columns(spark, sf):
    from claimlake.operators.aggregate import approx_distinct_columns
    return approx_distinct_columns(acp(spark, sf))


# ------------------------------------------------- projections and filters
@register("project_rename", V(
    f"""SELECT DESYNPUF_ID AS PATIENT_ID, BENE_BIRTH_DT, BENE_SEX_IDENT_CD AS GENDER,
  BENE_RACE_CD AS RACE, SP_STATE_CODE AS STATE, {FLAG_LIST}, BENRES_IP AS ANNUAL_COST FROM ben""", "ben"))
def q_project_rename(spark, sf):
    return beneficiary_projection(si.ben(spark, sf))


@register("project_reorder", V(
    "SELECT ANNUAL_COST, PATIENT_ID, AGE_YRS, GENDER, RACE, STATE, DX, PX, HCPCS FROM features", "features"))
def q_project_reorder(spark, sf):
    return features(spark, sf).select("ANNUAL_COST", "PATIENT_ID", "AGE_YRS", "GENDER", "RACE",
                                      "STATE", "DX", "PX", "HCPCS")


@register("project_constant", V(
    "SELECT DESYNPUF_ID, CLM_ID, DATE '2008-01-01' AS CLM_FROM_DT FROM inp", "inp"))
def q_project_constant(spark, sf):
    """PR4: the earlier model overwrote every claim date with a constant."""
    import datetime as dt
    return si.inp(spark, sf).select("DESYNPUF_ID", "CLM_ID").withColumn(
        "CLM_FROM_DT", F.lit(dt.date(2008, 1, 1)))


@register("filter_nonzero_cost", V("SELECT * FROM features WHERE ANNUAL_COST <> 0", "features"))
def q_filter_nonzero_cost(spark, sf):
    return features(spark, sf).where(F.col("ANNUAL_COST") != 0)


@register("predicate_code_present", V(
    """SELECT CLM_ID, ICD9_DGNS_CD_1, (ICD9_DGNS_CD_1 IS NOT NULL AND ICD9_DGNS_CD_1 <> 'nan') AS dx_present,
  (ICD9_PRCDR_CD_1 IS NOT NULL AND ICD9_PRCDR_CD_1 <> 'nan') AS px_present FROM inp""", "inp"))
def q_predicate_code_present(spark, sf):
    from claimlake.functions.clean import code_present
    return si.inp(spark, sf).select("CLM_ID", "ICD9_DGNS_CD_1",
                                    code_present("ICD9_DGNS_CD_1").alias("dx_present"),
                                    code_present("ICD9_PRCDR_CD_1").alias("px_present"))


# ------------------------------------------------------- cleaning functions
def _raw_claim_dates(spark, sf):
    o = si.read_table(spark, sf, "orders")
    d = F.col("o_orderdate")
    raw = (F.when(F.col("o_orderkey") % 7 == 0, F.lit(""))
           .when(F.col("o_orderkey") % 11 == 0,
                 F.concat(F.date_format(d, "yyyy"), F.lit("XX"), F.date_format(d, "dd")))
           .otherwise(F.date_format(d, "yyyyMMdd")))
    return o.select(F.col("o_orderkey").alias("CLM_ID"), raw.alias("raw"))


RAW_DATES_SQL = """SELECT o_orderkey AS CLM_ID, CASE WHEN o_orderkey % 7 = 0 THEN ''
  WHEN o_orderkey % 11 = 0 THEN strftime(o_orderdate, '%Y') || 'XX' || strftime(o_orderdate, '%d')
  ELSE strftime(o_orderdate, '%Y%m%d') END AS raw FROM orders"""


@register("parse_yyyymmdd", f"""SELECT CLM_ID, raw, CAST(try_strptime(raw, '%Y%m%d') AS DATE) AS parsed
FROM ({RAW_DATES_SQL}) r""")
def q_parse_yyyymmdd(spark, sf):
    from claimlake.functions.clean import parse_yyyymmdd
    return _raw_claim_dates(spark, sf).withColumn("parsed", parse_yyyymmdd("raw"))


@register("fill_null_date", V(
    "SELECT CLM_ID, coalesce(CLM_FROM_DT, DATE '2008-01-01') AS CLM_FROM_DT FROM inp", "inp"))
def q_fill_null_date(spark, sf):
    from claimlake.functions.clean import fill_null_date
    return si.inp(spark, sf).select("CLM_ID", fill_null_date("CLM_FROM_DT").alias("CLM_FROM_DT"))


@register("fill_zero_short", """SELECT l_orderkey * 10 + l_linenumber AS PDE_ID,
  CASE WHEN l_linenumber = 1 THEN CAST(0 AS SMALLINT)
       ELSE TRY_CAST(trunc(l_quantity + l_discount) AS SMALLINT) END AS QTY_DSPNSD_NUM FROM lineitem""")
def q_fill_zero_short(spark, sf):
    """FN3: blank quantity -> 0; fractional quantity truncated (30.9 -> 30)."""
    from claimlake.functions.clean import fill_zero_short
    li = si.read_table(spark, sf, "lineitem")
    raw = F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("l_quantity") + F.col("l_discount"))
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("PDE_ID"),
                     fill_zero_short(raw).alias("QTY_DSPNSD_NUM"))


@register("cast_smallint", """SELECT l_orderkey * 10 + l_linenumber AS PDE_ID, l_orderkey AS raw,
  TRY_CAST(l_orderkey AS SMALLINT) AS value,
  (TRY_CAST(l_orderkey AS SMALLINT) IS NULL AND l_orderkey IS NOT NULL) AS quarantined FROM lineitem""")
def q_cast_smallint(spark, sf):
    """FN4: narrowing cast; values over 32,767 are flagged for quarantine, not wrapped."""
    from claimlake.functions.clean import cast_smallint
    li = si.read_table(spark, sf, "lineitem")
    v = cast_smallint(F.col("l_orderkey"))
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("PDE_ID"),
                     F.col("l_orderkey").alias("raw"), v.alias("value"),
                     (v.isNull() & F.col("l_orderkey").isNotNull()).alias("quarantined"))


@register("cast_string", V("SELECT PDE_ID, NULLIF(PROD_SRVC_ID, '') AS PROD_SRVC_ID FROM pde", "pde"))
def q_cast_string(spark, sf):
    from claimlake.functions.clean import cast_string
    return si.pde(spark, sf).select("PDE_ID", cast_string("PROD_SRVC_ID").alias("PROD_SRVC_ID"))


@register("normalise_npi", """SELECT c_custkey, NULLIF(CAST(CAST(trunc(coalesce(
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey * 1000003.0 + 0.25 END, -1)) AS BIGINT) AS VARCHAR), '-1')
  AS AT_PHYSN_NPI FROM customer""")
def q_normalise_npi(spark, sf):
    from claimlake.functions.clean import normalise_npi
    c = si.read_table(spark, sf, "customer")
    raw = F.when(F.col("c_custkey") % 3 == 0, F.lit(None)) \
        .otherwise(F.col("c_custkey") * F.lit(1000003.0) + F.lit(0.25))
    return c.select("c_custkey", normalise_npi(raw).alias("AT_PHYSN_NPI"))


@register("epoch_seconds", "SELECT o_orderkey, CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) AS seconds FROM orders")
def q_epoch_seconds(spark, sf):
    """FN7 on the order dates."""
    from claimlake.functions.dates import epoch_seconds
    return si.read_table(spark, sf, "orders").select("o_orderkey", epoch_seconds("o_orderdate").alias("seconds"))


# Cell texts by row number: missing spellings, over-wide, negative, fractional and plain values.
CELLS = ["nan", "NA", "", "1e30", "-1", "30.9", "1234567890.0", "x", "NULL", "99999"]
CELL_SQL = "CASE c_custkey % 10 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(CELLS)) + " END"


def _cell():
    return F.get(F.array(*map(F.lit, CELLS)), (F.col("c_custkey") % 10).cast("int"))


@register("fill_zero_short_cells", f"""SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 4 THEN -1
  WHEN 5 THEN 30 WHEN 6 THEN 1234567890 WHEN 8 THEN 0 WHEN 9 THEN 99999 END AS quantity,
  {CELL_SQL} AS cell FROM customer""")
def q_fill_zero_short_cells(spark, sf):
    """FN3 at the DDL width: missing spellings give 0, texts and over-wide numbers null."""
    from claimlake.functions.clean import fill_zero_short
    return si.read_table(spark, sf, "customer").select("c_custkey", fill_zero_short(_cell(), "int").alias("quantity"), _cell().alias("cell"))


@register("normalise_npi_cells", f"""SELECT c_custkey, CASE c_custkey % 10 WHEN 5 THEN '30' WHEN 6 THEN '1234567890' WHEN 9 THEN '99999' END AS npi,
  {CELL_SQL} AS cell FROM customer""")
def q_normalise_npi_cells(spark, sf):
    """FN6: missing spellings, -1, texts and over-wide numbers give null and never fail."""
    from claimlake.functions.clean import normalise_npi
    return si.read_table(spark, sf, "customer").select("c_custkey", normalise_npi(_cell()).alias("npi"), _cell().alias("cell"))


# ------------------------------------------------- links, text and paths
ANCHOR_RX = r'(?s)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
ANCHORS_SQL = f"""SELECT page_id, url, href,
    NULLIF(regexp_extract(body, '^([^<]*)', 1), '') AS text,
    CASE WHEN regexp_extract(body, '^([^<]*)', 1) = ''
         THEN NULLIF(regexp_extract(body, '(?s)^<[^>]+>[^<]*</[^>]+>([^<]*)', 1), '') END AS child1
  FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '{ANCHOR_RX}', 1)) AS href,
               unnest(regexp_extract_all(html, '{ANCHOR_RX}', 2)) AS body FROM pages) x"""

# Fixed made-up anchors that exercise every classification rule (the page
# table holds no claims-download links); always combined with the page anchors.
LINK_RULE_ROWS = [
    ("DE1.0 Sample 1", None, "/sample-1"),
    ("DE1.0 Sample 1 2008 Beneficiary Summary File", None, "/f/DE1_0_2008_Beneficiary_Summary_File_Sample_1.zip"),
    ("DE1.0 Sample 1 2008-2010 Inpatient Claims Sample", None, "/f/DE1_0_2008_to_2010_Inpatient_Claims_Sample_1.zip"),
    ("DE1.0 Sample 1 2008-2010 Outpatient Claims Sample", None, "/f/DE1_0_2008_to_2010_Outpatient_Claims_Sample_1.zip"),
    ("DE1.0 Sample 1 2008-2010 Prescription Drug Events", None, "https://files.example.org/DE1_0_2008_to_2010_Prescription_Drug_Events_Sample_1.zip"),
    ("Inpatient Claims Sample", None, "/f/short_link.zip"),
    ("Claims file", " (ZIP, 4MB)", "/f/DE1_0_2008_to_2010_Outpatient_Claims_Sample_2.zip"),
    ("Claims file", " (ZIP)", "/f/DE1_0_2008_to_2010_Inpatient_Claims_Sample_2.zip"),
    (None, " (ZIP)", "/f/DE1_0_2009_Beneficiary_Summary_File_Sample_2.zip"),
    ("a b c d e f g", " (ZIP)", "/f/DE1_0_2008_to_2010_Outpatient_Claims_Sample_3.zip"),
]
RULE_PAGE_URL = "https://www.example.org/sample-files"


def _sql_lit(v):
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


RULES_SQL = " UNION ALL ".join(
    f"SELECT CAST(-1 AS BIGINT) AS page_id, '{RULE_PAGE_URL}' AS url, {_sql_lit(h)} AS href, "
    f"CAST({_sql_lit(t)} AS VARCHAR) AS text, CAST({_sql_lit(c)} AS VARCHAR) AS child1"
    for t, c, h in LINK_RULE_ROWS)
ALL_ANCHORS_SQL = f"SELECT * FROM ({ANCHORS_SQL}) p UNION ALL {RULES_SQL}"

LINK_KIND_SQL = """CASE WHEN text IS NULL OR len(string_split(text, ' ')) < 5 THEN
    CASE WHEN CASE WHEN strpos(child1, '(') > 0 THEN split_part(substr(child1, strpos(child1, '(') + 1), ')', 1) END = 'ZIP'
         THEN 'zip_fallback' ELSE 'ignored' END
  WHEN string_split(text, ' ')[5] = 'Beneficiary' THEN 'beneficiary'
  WHEN string_split(text, ' ')[-3] = 'Inpatient' THEN 'inpatient'
  WHEN string_split(text, ' ')[-3] = 'Outpatient' THEN 'outpatient'
  WHEN string_split(text, ' ')[-3] = 'Prescription' THEN 'drug_events'
  ELSE 'ignored' END"""


def anchors(spark, sf):
    from claimlake.sources.html import page_anchors
    return page_anchors(si.read_table(spark, sf, "pages"))


def all_anchors(spark, sf):
    rules = spark.createDataFrame(
        [(-1, RULE_PAGE_URL, h, t, c) for t, c, h in LINK_RULE_ROWS],
        "page_id long, url string, href string, text string, child1 string")
    return anchors(spark, sf).unionByName(rules)


@register("page_links", f"SELECT page_id, href, text, child1 FROM ({ANCHORS_SQL}) a")
def q_page_links(spark, sf):
    return anchors(spark, sf).select("page_id", "href", "text", "child1")


# Fixed made-up pages with the forms an anchor can take, and what must be found in them.
FORM_PAGES = [
    ('<A HREF="/up">Upper</A> <a class=x href=\'/single\'>Single &amp; quoted</a><a href=/bare>Bare</a>',
     [("/up", "Upper", None), ("/single", "Single & quoted", None), ("/bare", "Bare", None)]),
    ('<a href="/q?a=1&amp;b=2"><img src="i.png"> (ZIP)</a><a href="/n"><b>x <i>y</i></b> (ZIP)</a><a\nhref = "/nl">t&#65;&#x42;&#233;</a>',
     [("/q?a=1&b=2", None, " (ZIP)"), ("/n", None, " (ZIP)"), ("/nl", "tAB\u00e9", None)]),
    ('<a name="top"></a><a href="/open">no end <a href="/next">next</a><a data-href="/no">no</a> <a href="/last">&amp;lt; end',
     [("/open", "no end ", None), ("/next", "next", None), ("/last", "&lt; end", None)]),
]


@register("page_links_forms", f"SELECT page_id, href, text, child1 FROM ({ANCHORS_SQL}) a UNION ALL " + " UNION ALL ".join(
    f"SELECT CAST({-k} AS BIGINT), {_sql_lit(h)}, {_sql_lit(t)}, {_sql_lit(c)}" for k, (_, found) in enumerate(FORM_PAGES, 1) for h, t, c in found))
def q_page_links_forms(spark, sf):
    """SC10: the anchors of all pages and of pages in every spelling of an anchor."""
    from claimlake.sources.html import page_anchors
    forms = spark.createDataFrame([(-k, "https://www.example.org/f", html) for k, (html, _) in enumerate(FORM_PAGES, 1)], "page_id long, url string, html string")
    pages = si.read_table(spark, sf, "pages").select("page_id", "url", "html").unionByName(forms)
    return page_anchors(pages).select("page_id", "href", "text", "child1")


@register("split_token", f"""SELECT page_id, href, text, string_split(text, ' ')[1] AS t0,
  string_split(text, ' ')[5] AS t4, string_split(text, ' ')[-3] AS t_3,
  CAST(len(string_split(text, ' ')) AS INTEGER) AS n_tokens FROM ({ALL_ANCHORS_SQL}) a""")
def q_split_token(spark, sf):
    from claimlake.functions.text import split_token, token_count
    t = F.col("text")
    return all_anchors(spark, sf).select(
        "page_id", "href", "text", split_token(t, 0).alias("t0"), split_token(t, 4).alias("t4"),
        split_token(t, -3).alias("t_3"), token_count(t).alias("n_tokens"))


@register("text_in_parens", """SELECT page_id,
  CASE WHEN strpos(html, '(') > 0 THEN split_part(substr(html, strpos(html, '(') + 1), ')', 1) END AS in_parens
  FROM pages""")
def q_text_in_parens(spark, sf):
    from claimlake.functions.text import text_in_parens
    return si.read_table(spark, sf, "pages").select("page_id", text_in_parens("html").alias("in_parens"))


@register("path_basename", "SELECT page_id, url, string_split(url, '/')[-1] AS base_name FROM pages")
def q_path_basename(spark, sf):
    from claimlake.functions.text import path_basename
    return si.read_table(spark, sf, "pages").select("page_id", "url", path_basename("url").alias("base_name"))


@register("path_restem", """SELECT page_id, split_part(string_split(url, '/')[-1], '.', 1) || '.parquet' AS parquet_name
  FROM pages""")
def q_path_restem(spark, sf):
    from claimlake.functions.text import path_basename, path_restem
    return si.read_table(spark, sf, "pages").select(
        "page_id", path_restem(path_basename("url"), ".parquet").alias("parquet_name"))


@register("path_concat", f"""SELECT page_id, href, regexp_extract(url, '^(https?://[^/]+)', 1) || href AS full_url
  FROM ({ANCHORS_SQL}) a""")
def q_path_concat(spark, sf):
    from claimlake.functions.text import path_concat
    from claimlake.sources.html import site_of
    return anchors(spark, sf).select("page_id", "href",
                                     path_concat(site_of(F.col("url")), F.col("href")).alias("full_url"))


@register("link_classify", f"SELECT page_id, href, text, child1, {LINK_KIND_SQL} AS link_kind FROM ({ALL_ANCHORS_SQL}) a")
def q_link_classify(spark, sf):
    from claimlake.plans.links import link_kind
    return all_anchors(spark, sf).select("page_id", "href", "text", "child1",
                                         link_kind(F.col("text"), F.col("child1")).alias("link_kind"))


# Fixed made-up pages whose markup holds what only looks like an anchor, and elements in each other, and what must be found in them.
MARKUP_PAGES = [
    ('<!-- <a href="/gone">old</a> --><a href="/kept">kept</a><!----><a href="/b">b</a><!--> <a href="/c">c</a> -->',
     [("/kept", "kept", None), ("/b", "b", None), ("/c", "c", None)]),
    ('<script>var s = "<a href=\'/js\'>x</a>";</script><style>a:after{content:"<a href=/css>"}</style ><TEXTAREA><a href="/t">t</a></textarea>'
     '<a href="/real"><script>"</a>"</script> (ZIP)</a>', [("/real", None, " (ZIP)")]),
    ('<a href="/nest"><span>x <span>y</span> z</span> (ZIP)</a><a href="/cross"><b>1<i>2</b> (ZIP)</i></a><a href="/self"><i/> (ZIP)</a>',
     [("/nest", None, " (ZIP)"), ("/cross", None, " (ZIP)"), ("/self", None, " (ZIP)")]),
    ('<a title="a > b <a href=\'/no\'>" href="/quoted">q</a><a href="/lt">1 < 2</a><a href="/stray">s</em>t</a><a href="/lead"><b>open (ZIP)</a>',
     [("/quoted", "q", None), ("/lt", "1 < 2", None), ("/stray", "s", None), ("/lead", None, None)]),
    ('<a href="/split">one<!-- two -->three</a><a href="/late"><!-- c -->text</a><a href="/end">end<!-- <a href="/never">never</a>',
     [("/split", "one", None), ("/late", "text", None), ("/end", "end", None)]),
]


@register("page_links_markup", f"SELECT page_id, href, text, child1 FROM ({ANCHORS_SQL}) a UNION ALL " + " UNION ALL ".join(
    f"SELECT CAST({-k} AS BIGINT), {_sql_lit(h)}, {_sql_lit(t)}, {_sql_lit(c)}" for k, (_, found) in enumerate(MARKUP_PAGES, 1) for h, t, c in found))
def q_page_links_markup(spark, sf):
    """SC10: the anchors of all pages, and of pages with comments, raw text, nesting and tags left open."""
    from claimlake.sources.html import page_anchors
    forms = spark.createDataFrame([(-k, "https://www.example.org/m", html) for k, (html, _) in enumerate(MARKUP_PAGES, 1)], "page_id long, url string, html string")
    pages = si.read_table(spark, sf, "pages").select("page_id", "url", "html").unionByName(forms)
    return page_anchors(pages).select("page_id", "href", "text", "child1")


FILE_KIND_SQL = """CASE WHEN string_split(file_name, '_')[6] = 'Inpatient' THEN 'inpatient'
  WHEN string_split(file_name, '_')[6] = 'Outpatient' THEN 'outpatient'
  WHEN string_split(file_name, '_')[4] = 'Beneficiary' THEN 'beneficiary' END"""


@register("filename_classify", f"""SELECT page_id, href, file_name, {FILE_KIND_SQL} AS file_kind FROM (
  SELECT page_id, href, string_split(href, '/')[-1] AS file_name FROM ({ALL_ANCHORS_SQL}) a) f""")
def q_filename_classify(spark, sf):
    from claimlake.functions.text import path_basename
    from claimlake.plans.links import filename_kind
    a = all_anchors(spark, sf).select("page_id", "href", path_basename("href").alias("file_name"))
    return a.withColumn("file_kind", filename_kind(F.col("file_name")))


@register("download_catalogue", f"""SELECT page_id, href, text, child1, link_kind,
  coalesce(string_split(text, ' ')[1] = 'DE1.0', false) AS sample_page,
  CASE WHEN link_kind = 'zip_fallback' THEN {FILE_KIND_SQL} WHEN link_kind = 'ignored' THEN NULL
       ELSE link_kind END AS table_kind,
  CASE WHEN link_kind = 'drug_events' THEN href ELSE regexp_extract(url, '^(https?://[^/]+)', 1) || href END
    AS download_url,
  file_name, split_part(file_name, '.', 1) || '.parquet' AS parquet_name
FROM (SELECT *, {LINK_KIND_SQL} AS link_kind, string_split(href, '/')[-1] AS file_name
      FROM ({ALL_ANCHORS_SQL}) a) k""")
def q_download_catalogue(spark, sf):
    from claimlake.plans.links import download_catalogue
    return download_catalogue(all_anchors(spark, sf))


STORED_PAGES_SQL = "(SELECT page_id, 'https://www.example.org/p/' || page_id AS url, html FROM pages) AS pages"


@register("catalogue_two_level", ORACLES["download_catalogue"].replace(ALL_ANCHORS_SQL, ANCHORS_SQL).replace("FROM pages", "FROM " + STORED_PAGES_SQL))
def q_catalogue_two_level(spark, sf):
    """JB5 with the walk: an index page names every stored page as a sample, and links by other
    names to as many pages that are none; only the samples' anchors are classified."""
    from claimlake.plans.links import catalogue_from_index
    site = "https://www.example.org"
    stored = si.read_table(spark, sf, "pages")

    def at(folder: str) -> F.Column:
        return F.concat(F.lit(f"{site}/{folder}/"), F.col("page_id").cast("string")).alias("url")

    pages = stored.select("page_id", at("p"), "html")
    others = stored.select((-F.col("page_id") - 1).alias("page_id"), at("other"), "html")
    index = stored.select(F.lit(None).cast("long").alias("page_id"), F.lit(f"{site}/index").alias("url"), F.format_string(
        "<a href='/p/%d'>DE1.0 Sample %d</a><a href='/other/%d'>Other page %d</a>", "page_id", "page_id", "page_id", "page_id").alias("html"))
    return catalogue_from_index(pages.unionByName(others).unionByName(index), f"{site}/index")


# ----------------------------------------------------------------- profiles
INP_COLS = ["DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_PMT_AMT", "ICD9_DGNS_CD_1",
            "ICD9_PRCDR_CD_1", "HCPCS_CD_1"]


@register("profile_distinct", V(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
    f" AS BIGINT) AS n_distinct FROM inp" for c in INP_COLS), "inp"))
def q_profile_distinct(spark, sf):
    from claimlake.operators.profile import distinct_profile
    return distinct_profile(si.inp(spark, sf), INP_COLS)


@register("profile_describe", V(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count,
  round(avg(TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)), 2) AS mean,
  round(stddev_samp(TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)), 2) AS stddev,
  min(CAST({c} AS VARCHAR)) AS min, max(CAST({c} AS VARCHAR)) AS max FROM inp_text"""
    for c in INP_COLS).replace("FROM inp_text", "FROM (SELECT " + ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" for c in INP_COLS) + " FROM inp) t"), "inp"))
def q_profile_describe(spark, sf):
    """PF2 on the claim rows read as text, as the notebook's untyped CSV scan gives them."""
    from claimlake.operators.profile import describe_profile
    text = si.inp(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in INP_COLS])
    d = describe_profile(text)
    return d.withColumn("mean", F.round("mean", 2)).withColumn("stddev", F.round("stddev", 2))


BEN_PROFILE_COLS = ["DESYNPUF_ID", "BENE_BIRTH_DT", "BENE_SEX_IDENT_CD", "BENE_RACE_CD",
                    "SP_STATE_CODE", *CONDITION_FLAGS, "MEDREIMB_IP", "BENRES_IP"]


@register("profile_group_mean", V(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, round(avg(MEDREIMB_IP), 4) AS avg_MEDREIMB_IP"
    f" FROM ben GROUP BY {c}" for c in BEN_PROFILE_COLS), "ben"))
def q_profile_group_mean(spark, sf):
    from claimlake.operators.profile import group_mean_profile
    g = group_mean_profile(si.ben(spark, sf), "MEDREIMB_IP", BEN_PROFILE_COLS)
    return g.withColumn("avg_MEDREIMB_IP", F.round("avg_MEDREIMB_IP", 4))


@register("preview_limit", V("SELECT * FROM features ORDER BY PATIENT_ID LIMIT 20", "features"))
def q_preview_limit(spark, sf):
    from claimlake.operators.profile import preview
    return preview(features(spark, sf), 20, ["PATIENT_ID"])


# ---------------------------------------------------- sort, dedupe, joins
@register("sort_predictions", V("SELECT PATIENT_ID, prediction FROM acp ORDER BY prediction DESC", "acp"))
def q_sort_predictions(spark, sf):
    from claimlake.operators.dedupe import sort_desc
    return sort_desc(acp(spark, sf).select("PATIENT_ID", "prediction"), "prediction", "PATIENT_ID")


@register("dedupe_keep_top", V("""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY PATIENT_ID, AGE_YRS, GENDER, RACE, STATE, DX, PX, HCPCS
  ORDER BY prediction DESC, ANNUAL_COST) AS rn FROM acp) t WHERE rn = 1""", "acp"))
def q_dedupe_keep_top(spark, sf):
    from claimlake.operators.dedupe import keep_top
    from claimlake.schemas import DEDUPE_KEYS
    return keep_top(acp(spark, sf), DEDUPE_KEYS, "prediction", ["ANNUAL_COST"])


CLAIM_SCORES_SQL = """SELECT b.BENE_SEX_IDENT_CD AS GENDER, b.BENE_RACE_CD AS RACE, b.SP_STATE_CODE AS STATE,
    i.ICD9_DGNS_CD_1 AS DX_CODE, i.ICD9_PRCDR_CD_1 AS PX_CODE, i.CLM_ID, i.CLM_PMT_AMT AS prediction
  FROM inp i JOIN ben b ON i.DESYNPUF_ID = b.DESYNPUF_ID"""


@register("dedupe_keep_top_claims", V(f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY GENDER, RACE, STATE, DX_CODE, PX_CODE ORDER BY prediction DESC, CLM_ID) AS rn
  FROM ({CLAIM_SCORES_SQL}) c) t WHERE rn = 1""", "ben", "inp"))
def q_dedupe_keep_top_claims(spark, sf):
    """SO2 where many rows share keys (one row per claim), null keys included."""
    from claimlake.operators.dedupe import keep_top
    b = si.ben(spark, sf).select("DESYNPUF_ID", F.col("BENE_SEX_IDENT_CD").alias("GENDER"),
                                 F.col("BENE_RACE_CD").alias("RACE"), F.col("SP_STATE_CODE").alias("STATE"))
    i = si.inp(spark, sf).select("DESYNPUF_ID", F.col("ICD9_DGNS_CD_1").alias("DX_CODE"),
                                 F.col("ICD9_PRCDR_CD_1").alias("PX_CODE"), "CLM_ID",
                                 F.col("CLM_PMT_AMT").alias("prediction"))
    c = i.join(b, "DESYNPUF_ID").drop("DESYNPUF_ID")
    return keep_top(c, ["GENDER", "RACE", "STATE", "DX_CODE", "PX_CODE"], "prediction", ["CLM_ID"])


@register("join_natural", V("""SELECT f.PATIENT_ID, f.AGE_YRS, f.DX, f.STATE, a.prediction
  FROM features f JOIN acp a ON f.AGE_YRS IS NOT DISTINCT FROM a.AGE_YRS
   AND f.DX IS NOT DISTINCT FROM a.DX AND f.STATE IS NOT DISTINCT FROM a.STATE""", "acp"))
def q_join_natural(spark, sf):
    """JO2: rejoin scores to rows on the shared feature columns (equal features match)."""
    from claimlake.operators.joins import natural_join
    left = features(spark, sf).select("PATIENT_ID", "AGE_YRS", "DX", "STATE")
    right = acp(spark, sf).select("AGE_YRS", "DX", "STATE", "prediction")
    return natural_join(left, right)


@register("join_natural_split", ORACLES["join_natural"])
def q_join_natural_split(spark, sf):
    """JO2 with the keys of more than a hundred rows dealt as blocks on both sides."""
    from claimlake.operators.joins import natural_join_split
    left = features(spark, sf).select("PATIENT_ID", "AGE_YRS", "DX", "STATE")
    right = acp(spark, sf).select("AGE_YRS", "DX", "STATE", "prediction")
    return natural_join_split(left, right, block_rows=100)


# ------------------------------------------------------ positional / types
@register("project_positional", "SELECT o_orderstatus, o_totalprice, o_orderdate FROM orders")
def q_project_positional(spark, sf):
    from claimlake.operators.project import select_slice
    return select_slice(si.read_table(spark, sf, "orders"), 2, 5)


@register("cast_by_type", """SELECT TRY_CAST(l_orderkey AS SMALLINT) AS l_orderkey,
  TRY_CAST(l_partkey AS SMALLINT) AS l_partkey, TRY_CAST(l_suppkey AS SMALLINT) AS l_suppkey, l_linenumber,
  CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
  CAST(l_discount AS VARCHAR) AS l_discount, CAST(l_tax AS VARCHAR) AS l_tax,
  l_returnflag, l_linestatus, l_shipdate FROM lineitem""")
def q_cast_by_type(spark, sf):
    from claimlake.operators.project import cast_by_type
    return cast_by_type(si.read_table(spark, sf, "lineitem"), "smallint", (4, 8))


# -------------------------------------------------------------------- model
def _index_sql() -> str:
    from claimlake.schemas import CATEGORICAL_COLUMNS
    parts = [f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value,
    CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS DOUBLE) AS label_index
  FROM features GROUP BY {c}""" for c in CATEGORICAL_COLUMNS]
    return V(" UNION ALL ".join(parts), "features")


@register("string_index", _index_sql())
def q_string_index(spark, sf):
    """ML1: the fitted label order of all 14 categorical columns (one multi-column fit)."""
    from claimlake.plans.model import string_indexer
    from claimlake.schemas import CATEGORICAL_COLUMNS
    f = features(spark, sf)
    idx = string_indexer().fit(f).transform(f)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                               F.col(f"{c}_index").alias("label_index")) for c in CATEGORICAL_COLUMNS])
    return idx.select(F.inline(pairs)).distinct()


def _assemble_sql() -> str:
    from claimlake.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS
    ctes, joins = [], []
    for i, c in enumerate(CATEGORICAL_COLUMNS):
        ctes.append(f"""ix{i} AS (SELECT CAST({c} AS VARCHAR) AS v,
    CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS DOUBLE) AS i
    FROM features GROUP BY {c})""")
        joins.append(f"JOIN ix{i} ON CAST(f.{c} AS VARCHAR) = ix{i}.v")
    pos = {c: i for i, c in enumerate(CATEGORICAL_COLUMNS)}
    vals = []
    for col in FEATURE_COLUMNS:
        if col.endswith("_index"):
            vals.append(f"CAST(ix{pos[col[:-len('_index')]]}.i AS VARCHAR)")
        else:
            vals.append(f"CAST(CAST(f.{col} AS DOUBLE) AS VARCHAR)")
    body = (", ".join(ctes) + f"""
SELECT f.PATIENT_ID, '[' || concat_ws(',', {', '.join(vals)}) || ']' AS features
FROM features f {' '.join(joins)}""")
    return V("SELECT 1", "features").replace("\nSELECT 1", ",\n" + body)


@register("assemble_features", _assemble_sql())
def q_assemble_features(spark, sf):
    from claimlake.plans.model import prepare, vector_text
    _, a = prepare(features(spark, sf))
    return a.select("PATIENT_ID", vector_text("features").alias("features"))


SPLIT_SQL = """CASE WHEN CAST('0x' || substr(md5('42:' || coalesce(PATIENT_ID, '') || ':' || coalesce(CAST(AGE_YRS AS VARCHAR), '')), 1, 8) AS BIGINT)
  % 10000 < 7000 THEN 'train' ELSE 'test' END"""


@register("train_test_split", V(f"SELECT PATIENT_ID, AGE_YRS, {SPLIT_SQL} AS split FROM features", "features"))
def q_train_test_split(spark, sf):
    from claimlake.plans.model import split_label
    return features(spark, sf).select("PATIENT_ID", "AGE_YRS", split_label().alias("split"))


def _one_feature_fit(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from claimlake.plans.model import fit
    f = VectorAssembler(inputCols=["AGE_YRS"], outputCol="x").transform(features(spark, sf))
    return f, fit(f, "x")


@register("linreg_fit", V("""SELECT round(regr_slope(ANNUAL_COST, AGE_YRS), 6) AS slope,
  round(regr_intercept(ANNUAL_COST, AGE_YRS), 6) AS intercept FROM features""", "features"))
def q_linreg_fit(spark, sf):
    """ML4 with one feature, checkable against SQL regression aggregates."""
    _, m = _one_feature_fit(spark, sf)
    return spark.range(1).select(F.round(F.lit(float(m.coefficients[0])), 6).alias("slope"),
                                 F.round(F.lit(float(m.intercept)), 6).alias("intercept"))


@register("linreg_r2", V("SELECT round(regr_r2(ANNUAL_COST, AGE_YRS), 6) AS r2 FROM features", "features"))
def q_linreg_r2(spark, sf):
    """ML5: R^2 of the one-feature fit on the rows it was trained on."""
    f, m = _one_feature_fit(spark, sf)
    return spark.range(1).select(F.round(F.lit(float(m.evaluate(f).r2)), 6).alias("r2"))


@register("linreg_normal_equations", V(
    "SELECT name, true AS orthogonal, (SELECT count(*) FROM features WHERE " + SPLIT_SQL + " = 'train') AS n_train FROM (VALUES "
    + ", ".join(f"('{c}')" for c in ["(intercept)", *FEATURE_COLUMNS]) + ") AS v(name)", "features"))
def q_linreg_normal_equations(spark, sf):
    """ML4 with all 18 features: the residuals of the training rows are orthogonal to
    every input, which only the least-squares solution satisfies."""
    from pyspark.ml.functions import vector_to_array

    from claimlake.plans.model import run
    m = run(features(spark, sf))
    rows = m.model.transform(m.train).select(
        F.concat(F.array(F.lit(1.0)), vector_to_array("features")).alias("x"), F.col("ANNUAL_COST").alias("y"),
        (F.col("ANNUAL_COST") - F.col("prediction")).alias("e"))
    names = ["(intercept)", *FEATURE_COLUMNS]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y") * F.col("y")).alias("yy"),
                    *[F.sum(F.col("x")[k] * F.col("e")).alias(f"d{k}") for k in range(len(names))],
                    *[F.sum(F.col("x")[k] * F.col("x")[k]).alias(f"s{k}") for k in range(len(names))])
    return sums.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("name"), (F.abs(F.col(f"d{k}")) <= 1e-6 * F.sqrt(F.col(f"s{k}") * F.col("yy")) + 1e-6).alias("orthogonal"),
        F.col("n").alias("n_train")) for k, c in enumerate(names)])))


@register("score_predictions_rows", V(
    f"SELECT PATIENT_ID, AGE_YRS, ANNUAL_COST, true AS scored FROM features WHERE {SPLIT_SQL} = 'test'", "features"))
def q_score_predictions_rows(spark, sf):
    """ML6: which rows are scored."""
    scored = q_score_predictions(spark, sf)
    return scored.select("PATIENT_ID", "AGE_YRS", "ANNUAL_COST", (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("scored"))


#: Columns of the scored table that do not come out of the fit.
SCORED_KEYS = [n for n, _ in PREDICTIONS if not n.endswith("_index") and n not in ("features", "prediction")]
SCORED_SQL = V(f"SELECT {', '.join(SCORED_KEYS)}, true AS scored FROM features WHERE {SPLIT_SQL} = 'test'", "features")


def scored_keys(df: DataFrame) -> DataFrame:
    return df.select(*SCORED_KEYS, (F.col("prediction").isNotNull() & F.col("features").startswith("[")).alias("scored"))


@register("annual_cost_predictions_rows", SCORED_SQL)
def q_annual_cost_predictions_rows(spark, sf):
    """JB7, ML7, ML8: rows and cast columns of the scored table."""
    return scored_keys(q_annual_cost_predictions(spark, sf))


@register("score_predictions")
def q_score_predictions(spark, sf):
    from claimlake.plans.model import run
    return run(features(spark, sf)).scored.select("PATIENT_ID", "AGE_YRS", "ANNUAL_COST", "prediction")


@register("annual_cost_predictions")
def q_annual_cost_predictions(spark, sf):
    from claimlake.plans.model import annual_cost_predictions
    return annual_cost_predictions(features(spark, sf))


@register("feature_table_v1", V("""SELECT b.BENRES_IP AS ANNUAL_COST, b.DESYNPUF_ID AS PATIENT_ID,
    CAST(date_diff('day', b.BENE_BIRTH_DT, a.DATE) AS DOUBLE) / 365.0 AS AGE_YRS,
    b.BENE_SEX_IDENT_CD AS GENDER, b.BENE_RACE_CD AS RACE, b.SP_STATE_CODE AS STATE, a.DX, a.PX, a.HCPCS
  FROM ben b JOIN (
    SELECT DESYNPUF_ID, count(ICD9_DGNS_CD_1) AS DX, count(ICD9_PRCDR_CD_1) AS PX,
      count(HCPCS_CD_1) AS HCPCS, DATE '2008-01-01' AS DATE
    FROM inp GROUP BY DESYNPUF_ID) a
  ON b.DESYNPUF_ID = a.DESYNPUF_ID""", "ben", "inp"))
def q_feature_table_v1(spark, sf):
    """The earlier feature table (constant claim date, non-null code counts)."""
    from claimlake.plans.features import feature_table_v1
    return feature_table_v1(si.ben(spark, sf), si.inp(spark, sf))


@register("annual_cost_predictions_v1")
def q_annual_cost_predictions_v1(spark, sf):
    """The earlier model end to end: constant claim date, non-null counts, 7 features."""
    from claimlake.plans.features import V1_ORDER, feature_table_v1
    from claimlake.plans.model import V1_CATEGORICALS, V1_FEATURES, run
    m = run(feature_table_v1(si.ben(spark, sf), si.inp(spark, sf)),
            categoricals=V1_CATEGORICALS, feature_cols=V1_FEATURES)
    return m.scored.select(*V1_ORDER, *[f"{c}_index" for c in V1_CATEGORICALS], "prediction")


@register("annual_cost_predictions_v1_rows", f"WITH v1 AS ({ORACLES['feature_table_v1']}) "
          f"SELECT PATIENT_ID, AGE_YRS, ANNUAL_COST, GENDER, RACE, STATE, DX, PX, HCPCS FROM v1 WHERE {SPLIT_SQL} = 'test'")
def q_annual_cost_predictions_v1_rows(spark, sf):
    """The earlier model: which rows are scored."""
    cols = ["PATIENT_ID", "AGE_YRS", "ANNUAL_COST", "GENDER", "RACE", "STATE", "DX", "PX", "HCPCS"]
    return q_annual_cost_predictions_v1(spark, sf).where("prediction is not null").select(*cols)


@register("approx_distinct_columns_bound", V(
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS exact, true AS within FROM acp"
                                          for c in ("PATIENT_ID", "AGE_YRS", "STATE", "RACE", "DX")) + ")", "acp"))
def q_approx_distinct_columns_bound(spark, sf):
    """AG14: the estimate is within four standard errors (of 5 %) of the exact count."""
    df = acp(spark, sf)
    cols = ("PATIENT_ID", "AGE_YRS", "STATE", "RACE", "DX")
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).unpivot([], list(cols), "column_name", "exact")
    estimate = q_approx_distinct_columns(spark, sf)
    close = F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.2 * F.col("exact")
    return exact.join(estimate, exact["column_name"] == estimate["column"]).select("column_name", "exact", close.alias("within"))


@register("approx_distinct_stored", ORACLES["approx_distinct_columns_bound"])
def q_approx_distinct_stored(spark, sf):
    """AG14 from stored sketches: two loads sketched apart, one of them twice, and united;
    within four standard errors of the exact count."""
    from claimlake.operators.sketches import column_sketches, distinct_counts, standard_error, store
    df = acp(spark, sf)
    cols = ["PATIENT_ID", "AGE_YRS", "STATE", "RACE", "DX"]
    path = f"{scratch_path(spark, 'sketches')}/acp"
    old = F.coalesce(F.col("AGE_YRS") >= 65, F.lit(False))
    for name, rows in (("a", df.where(old)), ("b", df.where(~old)), ("b", df.where(~old))):
        store(column_sketches(rows, cols).withColumn("load", F.lit(name)), path)
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).unpivot([], cols, "column_name", "exact")
    close = F.abs(F.col("approx_distinct") - F.col("exact")) <= 4 * standard_error() * F.col("exact") + 1
    found = distinct_counts(spark, path)
    return exact.join(found, exact["column_name"] == found["column"]).select("column_name", "exact", close.alias("within"))


@register("linreg_refit", ORACLES["linreg_normal_equations"])
def q_linreg_refit(spark, sf):
    """ML4 from stored sums of three loads: the residuals of the training rows are
    orthogonal to all 18 inputs, as only those of the least-squares solution are."""
    from pyspark.ml.functions import vector_to_array

    from claimlake.plans.model import complete, prepare, split_label
    from claimlake.plans.refit import add_load, refit
    f = features(spark, sf)
    path = f"{scratch_path(spark, 'refit')}/sums"
    part = F.pmod(F.xxhash64("PATIENT_ID"), F.lit(3))
    for k in range(3):
        add_load(f.where(part == k), path, f"load-{k}")
    fit = refit(spark, path)
    _, assembled = prepare(f)
    rows = assembled.where(complete() & F.col("ANNUAL_COST").isNotNull() & (split_label() == "train"))
    names = ["(intercept)", *FEATURE_COLUMNS]
    x = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))
    weights = F.array(*[F.lit(float(b)) for b in [fit.intercept, *fit.coefficients]])
    rows = rows.select(x.alias("x"), F.col("ANNUAL_COST").alias("y"))
    guess = F.aggregate(F.zip_with("x", weights, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    rows = rows.select("x", "y", (F.col("y") - guess).alias("e"))
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y") * F.col("y")).alias("yy"),
                    *[F.sum(F.col("x")[k] * F.col("e")).alias(f"d{k}") for k in range(len(names))],
                    *[F.sum(F.col("x")[k] * F.col("x")[k]).alias(f"s{k}") for k in range(len(names))])
    return sums.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("name"), (F.abs(F.col(f"d{k}")) <= 1e-6 * F.sqrt(F.col(f"s{k}") * F.col("yy")) + 1e-6).alias("orthogonal"),
        F.col("n").alias("n_train")) for k, c in enumerate(names)])))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Median predicted annual cost by state over the model's scored table."""
    from claimlake.plans.model import annual_cost_predictions
    scored = annual_cost_predictions(features(spark, sf))
    return dash.median_cost_by(scored, "STATE")
