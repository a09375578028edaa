"""Table, file and run storage.

Every artefact of a run carries a sortable ``run_ts``; it is the partition
column of parquet tables, so reading the newest run prunes all other folders.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from keepwell.schema import RAW_SCHEMA


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Customer CSV with a header; the total stays text until it is cleaned."""
    return spark.read.csv(path, header=True, schema=RAW_SCHEMA)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV parts with headers; nested columns are written as JSON text."""
    flat = df.select(*[
        F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else F.col(f.name)
        for f in df.schema])
    flat.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def load_table(df: DataFrame, name: str, mode: str = "overwrite") -> int:
    """Write a catalog table (replace or append) and report its rows added."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown write mode: {mode}")
    spark = df.sparkSession
    before = spark.table(name).count() if mode == "append" and spark.catalog.tableExists(name) else 0
    df.write.mode(mode).saveAsTable(name)
    return spark.table(name).count() - before


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("%Y%m%d-%H%M%S")


def write_run(df: DataFrame, path: str, run_ts: str) -> None:
    """Add one run; writing the same run again replaces only that run."""
    (df.withColumn("run_ts", F.lit(run_ts)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_ts").parquet(path))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs with ``run_ts`` kept as text."""
    return spark.read.option("basePath", path).parquet(path).withColumn("run_ts", F.col("run_ts").cast("string"))


def newest_run(runs: DataFrame) -> DataFrame:
    """Rows of the latest run; names that do not start with a digit are not runs.

    Raises when there is none.
    """
    stamped = runs.filter(F.col("run_ts").rlike("^[0-9]"))
    latest = stamped.agg(F.max("run_ts")).first()[0]
    if latest is None:
        raise FileNotFoundError("no run found")
    return stamped.filter(F.col("run_ts") == latest)


# --- run ledger --------------------------------------------------------------

LEDGER = "run_ts string, scope string, key string, number double, text string"


def ledger_rows(spark: SparkSession, run_ts: str, scope: str, entries: dict) -> DataFrame:
    """Parameters or metrics of one scope as ledger rows."""
    rows = []
    for key, value in entries.items():
        number = float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
        rows.append((run_ts, scope, key, number, None if number is not None else str(value)))
    return spark.createDataFrame(rows, LEDGER)


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def model_versions(ledger: DataFrame) -> DataFrame:
    """Winner per run with a version counting up over runs (one row per run)."""
    winners = ledger.filter((F.col("scope") == "winner") & (F.col("key") == "model_name"))
    return winners.select("run_ts", F.col("text").alias("model_name"), F.row_number().over(
        Window.orderBy("run_ts")).alias("version"))


def metric_table(ledger: DataFrame) -> DataFrame:
    """Metrics of every candidate: one row per run and model."""
    metrics = ledger.filter(F.col("scope").startswith("metrics/"))
    return (metrics.withColumn("model", F.substring_index("scope", "/", -1))
            .groupBy("run_ts", "model").pivot("key", ["roc_auc", "precision", "recall", "f1_score"])
            .agg(F.max("number")))


def promote(spark: SparkSession, path: str, run_ts: str, model_name: str, roc_auc: float) -> None:
    """Append a promotion record."""
    spark.createDataFrame([(run_ts, model_name, roc_auc)], "run_ts string, model_name string, roc_auc double"
                          ).withColumn("promoted_at", F.current_timestamp()).write.mode("append").parquet(path)
