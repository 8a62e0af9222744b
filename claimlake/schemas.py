"""Fixed table schemas (the warehouse DDL is the contract; no inference).

The column names, order and widths below are fixed values that must equal
the source system's DDL.  Repeating code slots are generated from their
slot counts (10 diagnosis, 6 procedure, 45 HCPCS).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: condition flags, in DDL order -------------------------
CONDITION_FLAGS = [
    "SP_ALZHDMTA", "SP_CHF", "SP_CHRNKIDN", "SP_CNCR", "SP_COPD", "SP_DEPRESSN",
    "SP_DIABETES", "SP_ISCHMCHT", "SP_OSTEOPRS", "SP_RA_OA", "SP_STRKETIA",
]

# ---- fixed values: the nine conditions charted on the dashboards, with the
# axis titles the dashboards show (spelling kept as published) -------------
DASHBOARD_CONDITIONS = [
    ("SP_ALZHDMTA", "Alzheimer's"),
    ("SP_CHF", "Heart Failure"),
    ("SP_CHRNKIDN", "Kidney Disease"),
    ("SP_DEPRESSN", "Depression"),
    ("SP_DIABETES", "Diabetes"),
    ("SP_ISCHMCHT", "Heart Disease"),
    ("SP_OSTEOPRS", "Osteoperosis"),
    ("SP_RA_OA", "Arthritis"),
    ("SP_STRKETIA", "Stroke"),
]

# ---- fixed values: categorical model inputs, in model order -------------
CATEGORICAL_COLUMNS = ["GENDER", "RACE", "STATE"] + CONDITION_FLAGS

# ---- fixed values: assembled feature order ------------------------------
FEATURE_COLUMNS = (
    ["AGE_YRS", "GENDER_index", "RACE_index", "STATE_index", "DX", "PX", "HCPCS"]
    + [f"{c}_index" for c in CONDITION_FLAGS]
)

# ---- fixed values: the eight de-duplication keys of the scored table ----
DEDUPE_KEYS = ["PATIENT_ID", "AGE_YRS", "GENDER", "RACE", "STATE", "DX", "PX", "HCPCS"]


def _slots(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(1, n + 1)]


DGNS = _slots("ICD9_DGNS_CD_", 10)
PRCDR = _slots("ICD9_PRCDR_CD_", 6)
HCPCS = _slots("HCPCS_CD_", 45)

S, D, SH, I, L, F = "string", "date", "short", "int", "long", "double"

# ---- fixed values: table layouts (name, type) in DDL order --------------
BENEFICIARY = (
    [("DESYNPUF_ID", S), ("BENE_BIRTH_DT", D), ("BENE_DEATH_DT", D),
     ("BENE_SEX_IDENT_CD", SH), ("BENE_RACE_CD", SH), ("BENE_ESRD_IND", S),
     ("SP_STATE_CODE", SH), ("BENE_COUNTY_CD", SH), ("BENE_HI_CVRAGE_TOT_MONS", SH),
     ("BENE_SMI_CVRAGE_TOT_MONS", SH), ("BENE_HMO_CVRAGE_TOT_MONS", SH),
     ("PLAN_CVRG_MOS_NUM", SH)]
    + [(c, SH) for c in CONDITION_FLAGS]
    + [(c, F) for c in ["MEDREIMB_IP", "BENRES_IP", "PPPYMT_IP", "MEDREIMB_OP", "BENRES_OP",
                        "PPPYMT_OP", "MEDREIMB_CAR", "BENRES_CAR", "PPPYMT_CAR"]]
)

INPATIENT = (
    [("DESYNPUF_ID", S), ("CLM_ID", L), ("SEGMENT", SH), ("CLM_FROM_DT", D),
     ("CLM_THRU_DT", D), ("PRVDR_NUM", S), ("CLM_PMT_AMT", F),
     ("NCH_PRMRY_PYR_CLM_PD_AMT", F), ("AT_PHYSN_NPI", S), ("OP_PHYSN_NPI", S),
     ("OT_PHYSN_NPI", S), ("CLM_ADMSN_DT", D), ("ADMTNG_ICD9_DGNS_CD", S),
     ("CLM_PASS_THRU_PER_DIEM_AMT", F), ("NCH_BENE_IP_DDCTBL_AMT", F),
     ("NCH_BENE_PTA_COINSRNC_LBLTY_AM", F), ("NCH_BENE_BLOOD_DDCTBL_LBLTY_AM", F),
     ("CLM_UTLZTN_DAY_CNT", I), ("NCH_BENE_DSCHRG_DT", D), ("CLM_DRG_CD", S)]
    + [(c, S) for c in DGNS + PRCDR + HCPCS]
)

OUTPATIENT = (
    [("DESYNPUF_ID", S), ("CLM_ID", L), ("SEGMENT", SH), ("CLM_FROM_DT", D),
     ("CLM_THRU_DT", D), ("PRVDR_NUM", S), ("CLM_PMT_AMT", F),
     ("NCH_PRMRY_PYR_CLM_PD_AMT", F), ("AT_PHYSN_NPI", S), ("OP_PHYSN_NPI", S),
     ("OT_PHYSN_NPI", S), ("NCH_BENE_BLOOD_DDCTBL_LBLTY_AM", F)]
    + [(c, S) for c in DGNS + PRCDR]
    + [("NCH_BENE_PTB_DDCTBL_AMT", F), ("NCH_BENE_PTB_COINSRNC_AMT", F),
       ("ADMTNG_ICD9_DGNS_CD", S)]
    + [(c, S) for c in HCPCS]
)

DRUG_EVENTS = [
    ("DESYNPUF_ID", S), ("PDE_ID", L), ("SRVC_DT", D), ("PROD_SRVC_ID", S),
    ("QTY_DSPNSD_NUM", I), ("DAYS_SUPLY_NUM", I), ("PTNT_PAY_AMT", F), ("TOT_RX_CST_AMT", F),
]

PREDICTIONS = (
    [("ANNUAL_COST", F), ("PATIENT_ID", S), ("AGE_YRS", F), ("GENDER", SH), ("RACE", SH),
     ("STATE", SH), ("DX", I), ("PX", I), ("HCPCS", I)]
    + [(c, SH) for c in CONDITION_FLAGS]
    + [(f"{c}_index", F) for c in CATEGORICAL_COLUMNS]
    + [("features", S), ("prediction", F)]
)

# Typed CSV of scored rows as the second dashboard reads it (leading row index).
PREDICTIONS_CSV = (
    [("F1", L), ("ANNUAL_COST", F), ("PATIENT_ID", S), ("AGE_YRS", F), ("GENDER", I),
     ("RACE", I), ("STATE", I), ("DX", I), ("PX", I), ("HCPCS", I)]
    + [(c, I) for c in CONDITION_FLAGS if c not in ("SP_CNCR", "SP_COPD")]
    + [("GENDER_index", F), ("RACE_index", F), ("STATE_index", F), ("features", S),
       ("prediction", F)]
)

TABLES = {
    "beneficiary_summary": BENEFICIARY,
    "inpatient_claims": INPATIENT,
    "outpatient_claims": OUTPATIENT,
    "prescription_drug_events": DRUG_EVENTS,
    "annual_cost_predictions": PREDICTIONS,
}

_SPARK_TYPES = {
    S: T.StringType(), D: T.DateType(), SH: T.ShortType(), I: T.IntegerType(),
    L: T.LongType(), F: T.DoubleType(),
}
_SQL_TYPES = {S: "STRING", D: "DATE", SH: "SMALLINT", I: "INT", L: "BIGINT", F: "DOUBLE"}


def struct(layout: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _SPARK_TYPES[t], True) for n, t in layout])


def raw_struct(layout: list[tuple[str, str]]) -> T.StructType:
    """All-text schema of a raw file with the same columns."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n, _ in layout])


def table_struct(name: str) -> T.StructType:
    return struct(TABLES[name])


def ddl_columns(layout: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {_SQL_TYPES[t]}" for n, t in layout)


def create_table_sql(qualified: str, layout: list[tuple[str, str]], location: str) -> str:
    return (f"CREATE TABLE {qualified} ({ddl_columns(layout)}) USING parquet "
            f"LOCATION '{location}'")
