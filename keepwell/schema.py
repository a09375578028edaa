"""Column groups, the raw record schema and the checks made against it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# --- fixed values: names, levels and order that results depend on ----------
ID = "customerID"
TARGET = "Churn"

NOMINAL = [
    "gender", "Partner", "Dependents", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "PaperlessBilling",
    "PaymentMethod",
]
ORDINAL = ["Contract"]
CONTRACT_LEVELS = ["Month-to-month", "One year", "Two year"]
NUMERIC = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
ENGINEERED_NUMERIC = ["num_addon_services", "avg_monthly_spend", "charges_ratio"]
ENGINEERED_NOMINAL = ["tenure_bucket", "spend_bucket"]
ENGINEERED = ENGINEERED_NUMERIC + ENGINEERED_NOMINAL
ADDON_SERVICES = [
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies",
]
TENURE_EDGES = [(6, "0-6m"), (12, "6-12m"), (24, "1-2y"), (48, "2-4y")]
TENURE_DEFAULT = "4y+"
SPEND_EDGES = [(35, "low"), (65, "medium"), (90, "high")]
SPEND_DEFAULT = "premium"
# --- end of fixed values ----------------------------------------------------

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()
RAW_SCHEMA = T.StructType([
    T.StructField(ID, _S),
    T.StructField("gender", _S),
    T.StructField("SeniorCitizen", _I),
    T.StructField("Partner", _S),
    T.StructField("Dependents", _S),
    T.StructField("tenure", _I),
    T.StructField("PhoneService", _S),
    T.StructField("MultipleLines", _S),
    T.StructField("InternetService", _S),
    T.StructField("OnlineSecurity", _S),
    T.StructField("OnlineBackup", _S),
    T.StructField("DeviceProtection", _S),
    T.StructField("TechSupport", _S),
    T.StructField("StreamingTV", _S),
    T.StructField("StreamingMovies", _S),
    T.StructField("Contract", _S),
    T.StructField("PaperlessBilling", _S),
    T.StructField("PaymentMethod", _S),
    T.StructField("MonthlyCharges", _D),
    T.StructField("TotalCharges", _S),
    T.StructField(TARGET, _S),
])
RAW_COLUMNS = RAW_SCHEMA.fieldNames()
CANONICAL_COLUMNS = RAW_COLUMNS + ENGINEERED

# One online record: the model inputs, no id and no outcome.
RECORD_SCHEMA = T.StructType(
    [T.StructField(f.name, _D if f.name == "TotalCharges" else f.dataType)
     for f in RAW_SCHEMA if f.name not in (ID, TARGET)]
    + [T.StructField(ID, _S)]
)


def active_groups(columns) -> tuple[list[str], list[str], list[str]]:
    """Nominal, ordinal and numeric model inputs present among ``columns``."""
    present = set(columns)
    keep = lambda names: [c for c in names if c in present]
    return (keep(NOMINAL + ENGINEERED_NOMINAL), keep(ORDINAL),
            keep(NUMERIC + ENGINEERED_NUMERIC))


def drop_non_features(df: DataFrame) -> DataFrame:
    return df.drop(TARGET, ID)


def align(df: DataFrame, trained: list[str]) -> DataFrame:
    """Project to the trained columns in trained order; absent ones raise."""
    missing = [c for c in trained if c not in df.columns]
    if missing:
        raise ValueError(f"scoring data lacks trained features: {missing}")
    return df.select(*trained)


def schema_findings(df: DataFrame, expected: T.StructType = RAW_SCHEMA) -> DataFrame:
    """One row per column of either schema with what was expected and found.

    A missing required column raises; a differing type is only a finding.
    """
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    missing = sorted(set(want) - set(have))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    rows = []
    for name in list(want) + sorted(set(have) - set(want)):
        if name not in want:
            status = "extra"
        else:
            status = "ok" if want[name] == have[name] else "type differs"
        rows.append((name, want.get(name), have.get(name), status))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, found_type string, status string")


def unknown_targets(df: DataFrame) -> DataFrame:
    """How many rows carry a target other than Yes/No (they count as 0)."""
    known = F.col(TARGET).isin("Yes", "No")
    return df.agg(F.count("*").alias("rows"),
                  F.count_if(~F.coalesce(known, F.lit(False))).alias("unknown_target"))
