"""Online scoring: validate, derive, score and band records of a stream.

The path is stateless per record, so the same function serves a batch frame
and a stream; the only fitted input is the model (and its level lists).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from keepwell.functions.features import with_engineered
from keepwell.functions.scoring import hard_prediction, risk_category
from keepwell.schema import ID, RECORD_SCHEMA

# --- fixed values: record limits --------------------------------------------
NON_NEGATIVE = ["tenure", "MonthlyCharges", "TotalCharges"]
SENIOR_VALUES = [0, 1]
# --- end of fixed values ----------------------------------------------------

REQUIRED = [f.name for f in RECORD_SCHEMA if f.name != ID]


def parse(values: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to typed columns; a wrong type or broken text fills ``_corrupt``."""
    schema = StructType([*RECORD_SCHEMA.fields, StructField("_corrupt", StringType())])
    parsed = F.from_json(column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return values.withColumn("_r", parsed).select("*", "_r.*").drop("_r")


def problems() -> Column:
    """Why a record is rejected; empty for a valid record."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in REQUIRED]
    checks += [F.when(F.col(c) < 0, F.lit(f"negative {c}")) for c in NON_NEGATIVE]
    checks.append(F.when(~F.col("SeniorCitizen").isin(SENIOR_VALUES), F.lit("SeniorCitizen out of range")))
    return F.array_compact(F.array(*checks))


def contract_split(records: DataFrame) -> DataFrame:
    """Adds ``problems`` and ``valid``; unseen category levels are accepted."""
    found = problems()
    if "_corrupt" in records.columns:
        found = F.when(F.col("_corrupt").isNotNull(), F.concat(F.array(F.lit("malformed")), found)).otherwise(found)
    return records.withColumn("problems", found).withColumn("valid", F.size("problems") == 0)


def score_records(records: DataFrame, score: Callable[[DataFrame], DataFrame], version: str, model_name: str) -> DataFrame:
    """Score valid records and attach band and provenance."""
    valid = contract_split(records).filter("valid").drop("problems", "valid", "_corrupt", "value")
    scored = score(with_engineered(valid))
    p = F.col("churn_probability")
    return scored.select(
        ID, p, hard_prediction(p).alias("prediction"), risk_category(p).alias("risk_category"),
        F.lit(version).alias("model_version"), F.lit(model_name).alias("model_name"))


def quarantine(records: DataFrame) -> DataFrame:
    return contract_split(records).filter("not valid")


def run_stream(records: DataFrame, score, version: str, model_name: str, sink: str, checkpoint: str):
    """Process what is available, write parquet exactly once, and stop.

    Rejected records go to ``<sink>-rejected`` with their problems, by a query of
    its own, so that each sink keeps its exactly-once log.
    """
    outputs = {sink: (score_records(records, score, version, model_name), checkpoint),
               f"{sink}-rejected": (quarantine(records), f"{checkpoint}-rejected")}
    queries = [frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", state)
               .outputMode("append").trigger(availableNow=True).start() for path, (frame, state) in outputs.items()]
    for query in queries:
        query.awaitTermination()
    return queries[0]
