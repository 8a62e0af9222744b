"""Claims-shaped views over the driver's sales tables (test inputs).

``ben`` <- customer, ``inp`` <- orders, ``pde`` <- lineitem.  Each view is a
projection of whole tables (no rows dropped); the modulo expressions only
derive column values.  Every view has a DuckDB SQL twin used by the oracle
checks, built from the same parameters so the two cannot drift apart.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.schemas import CONDITION_FLAGS

# Fixed values of the mapping.
BIRTH_BASE = _dt.date(1920, 1, 1)
BIRTH_SPREAD_DAYS = 20000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------- Spark
def ben(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beneficiary summary rows derived from ``customer``."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    flags = [
        F.when(k % (i + 2) == 0, 1).otherwise(2).cast("smallint").alias(name)
        for i, name in enumerate(CONDITION_FLAGS)
    ]
    return c.select(
        k.cast("string").alias("DESYNPUF_ID"),
        F.date_add(F.lit(BIRTH_BASE), (k * 37 % BIRTH_SPREAD_DAYS).cast("int")).alias("BENE_BIRTH_DT"),
        (k % 2 + 1).cast("smallint").alias("BENE_SEX_IDENT_CD"),
        (F.length("c_mktsegment") % 4 + 1).cast("smallint").alias("BENE_RACE_CD"),
        F.col("c_nationkey").cast("smallint").alias("SP_STATE_CODE"),
        *flags,
        F.col("c_acctbal").alias("MEDREIMB_IP"),
        F.when(k % 5 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("BENRES_IP"),
    )


def inp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inpatient claim rows derived from ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("DESYNPUF_ID"),
        F.col("o_orderkey").alias("CLM_ID"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(None).cast("date"))
         .otherwise(F.col("o_orderdate").cast("date")).alias("CLM_FROM_DT"),
        F.col("o_totalprice").alias("CLM_PMT_AMT"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("nan"))
         .otherwise(F.col("o_orderpriority")).alias("ICD9_DGNS_CD_1"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(F.col("o_orderstatus")).alias("ICD9_PRCDR_CD_1"),
        F.lit(None).cast("string").alias("HCPCS_CD_1"),
    )


def pde(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prescription drug events derived from ``lineitem``."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("DESYNPUF_ID"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("PDE_ID"),
        F.col("l_shipdate").cast("date").alias("SRVC_DT"),
        F.col("l_partkey").cast("string").alias("PROD_SRVC_ID"),
        F.col("l_quantity").alias("QTY_DSPNSD_NUM"),
        F.col("l_linenumber").alias("DAYS_SUPLY_NUM"),
        (F.col("l_discount") * F.col("l_extendedprice")).alias("PTNT_PAY_AMT"),
        F.col("l_extendedprice").alias("TOT_RX_CST_AMT"),
    )


def stand_in_prediction(age, dx, state):
    """Deterministic stand-in score for oracle checks, in cents: round(age*100 + dx*10 + state, 2).

    Cents keep the median of two scores (at most 3 decimals) well away from a
    rounding tie at the 6th decimal, so both engines report the same value.
    """
    return F.round(age * 100 + dx * 10 + state, 2)


# ---------------------------------------------------------------- DuckDB SQL
def ben_sql() -> str:
    flags = ",\n    ".join(
        f"CAST(CASE WHEN c_custkey % {i + 2} = 0 THEN 1 ELSE 2 END AS SMALLINT) AS {name}"
        for i, name in enumerate(CONDITION_FLAGS))
    return f"""SELECT CAST(c_custkey AS VARCHAR) AS DESYNPUF_ID,
    DATE '{BIRTH_BASE.isoformat()}' + CAST(c_custkey * 37 % {BIRTH_SPREAD_DAYS} AS INTEGER) AS BENE_BIRTH_DT,
    CAST(c_custkey % 2 + 1 AS SMALLINT) AS BENE_SEX_IDENT_CD,
    CAST(length(c_mktsegment) % 4 + 1 AS SMALLINT) AS BENE_RACE_CD,
    CAST(c_nationkey AS SMALLINT) AS SP_STATE_CODE,
    {flags},
    c_acctbal AS MEDREIMB_IP,
    CASE WHEN c_custkey % 5 = 0 THEN CAST(0.0 AS DOUBLE) ELSE c_acctbal END AS BENRES_IP
  FROM customer"""


def inp_sql() -> str:
    return """SELECT CAST(o_custkey AS VARCHAR) AS DESYNPUF_ID, o_orderkey AS CLM_ID,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS CLM_FROM_DT,
    o_totalprice AS CLM_PMT_AMT,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'nan' ELSE o_orderpriority END AS ICD9_DGNS_CD_1,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS ICD9_PRCDR_CD_1,
    CAST(NULL AS VARCHAR) AS HCPCS_CD_1
  FROM orders"""


def pde_sql() -> str:
    return """SELECT CAST(l_orderkey AS VARCHAR) AS DESYNPUF_ID,
    l_orderkey * 10 + l_linenumber AS PDE_ID,
    CAST(l_shipdate AS DATE) AS SRVC_DT,
    CAST(l_partkey AS VARCHAR) AS PROD_SRVC_ID,
    l_quantity AS QTY_DSPNSD_NUM,
    l_linenumber AS DAYS_SUPLY_NUM,
    l_discount * l_extendedprice AS PTNT_PAY_AMT,
    l_extendedprice AS TOT_RX_CST_AMT
  FROM lineitem"""


def feature_sql() -> str:
    """SQL twin of the feature table (JB6) over the ``ben`` / ``inp`` CTEs."""
    flags = ", ".join(f"b.{c}" for c in CONDITION_FLAGS)
    return f"""SELECT b.BENRES_IP AS ANNUAL_COST, b.DESYNPUF_ID AS PATIENT_ID,
    CAST(date_diff('day', b.BENE_BIRTH_DT, a.DATE) AS DOUBLE) / 365.0 AS AGE_YRS,
    b.BENE_SEX_IDENT_CD AS GENDER, b.BENE_RACE_CD AS RACE, b.SP_STATE_CODE AS STATE,
    a.DX, a.PX, a.HCPCS, {flags}
  FROM ben b JOIN (
    SELECT DESYNPUF_ID,
      count(CASE WHEN ICD9_DGNS_CD_1 <> 'nan' THEN 1 END) AS DX,
      count(CASE WHEN ICD9_PRCDR_CD_1 <> 'nan' THEN 1 END) AS PX,
      count(CASE WHEN HCPCS_CD_1 <> 'nan' THEN 1 END) AS HCPCS,
      max(coalesce(CLM_FROM_DT, DATE '2008-01-01')) AS DATE
    FROM inp GROUP BY DESYNPUF_ID) a
  ON b.DESYNPUF_ID = a.DESYNPUF_ID"""


def acp_sql() -> str:
    """SQL twin of the stand-in scored table: features + deterministic prediction."""
    return """SELECT *, round(AGE_YRS * 100 + DX * 10 + STATE, 2) AS prediction FROM features"""


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies included, in order)."""
    order = ["ben", "inp", "pde", "features", "acp"]
    deps = {"features": {"ben", "inp"}, "acp": {"features", "ben", "inp"}}
    need = set(names)
    for n in list(need):
        need |= deps.get(n, set())
    text = {"ben": ben_sql, "inp": inp_sql, "pde": pde_sql, "features": feature_sql, "acp": acp_sql}
    ctes = [f"{n} AS (\n  {text[n]()}\n)" for n in order if n in need]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
