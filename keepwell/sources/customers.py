"""Adapter: raw 21-column customer records from order-level tables.

All derived values use integer arithmetic, so any SQL engine gives the same
cells. The order table is reduced to one row per customer before the join
(map-side partial aggregation keeps a customer with very many orders cheap).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.schema import RAW_COLUMNS


# Declared so that opening a table needs no footer scan.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _yes(condition: str) -> str:
    return f"if({condition}, 'Yes', 'No')"


def _addon(condition: str) -> str:
    return f"if(noint, 'No internet service', if({condition}, 'Yes', 'No'))"


_RULES = {
    "customerID": "concat('C-', lpad(cast(c_custkey as string), 9, '0'))",
    "gender": "if(u1 % 2 = 0, 'Male', 'Female')",
    "SeniorCitizen": "if(u2 < 16, 1, 0)",
    "Partner": _yes("u3 < 48"),
    "Dependents": _yes("u4 < 30"),
    "tenure": "cast(3 * (n - 1) as int)",
    "PhoneService": _yes("u1 < 90"),
    "MultipleLines": "if(u1 >= 90, 'No phone service', if(u2 < 45, 'Yes', 'No'))",
    "InternetService": "case c_nationkey % 3 when 0 then 'DSL' when 1 then 'Fiber optic' else 'No' end",
    "OnlineSecurity": _addon("u1 + 2 * n > 75"),
    "OnlineBackup": _addon("u2 + 2 * n > 70"),
    "DeviceProtection": _addon("u3 + 2 * n > 70"),
    "TechSupport": _addon("u4 + 3 * n > 85"),
    "StreamingTV": _addon("(u1 + u2) % 100 < 50"),
    "StreamingMovies": _addon("(u1 + u3) % 100 < 50"),
    "Contract": ("case when u3 + 3 * n < 85 then 'Month-to-month' "
                 "when u3 + 3 * n < 110 then 'One year' else 'Two year' end"),
    "PaperlessBilling": _yes("u4 >= 40"),
    "PaymentMethod": ("case c_mktsegment when 'AUTOMOBILE' then 'Mailed check' "
                      "when 'MACHINERY' then 'Bank transfer (automatic)' "
                      "when 'HOUSEHOLD' then 'Credit card (automatic)' "
                      "else 'Electronic check' end"),
    "MonthlyCharges": "cast(mc as double) / 100",
    "TotalCharges": ("if(n = 1, ' ', concat(cast(tc div 100 as string), '.', "
                     "lpad(cast(tc % 100 as string), 2, '0')))"),
    "Churn": _yes("rec > 300"),
}


def customer_frame(spark: SparkSession, folder: str) -> DataFrame:
    """One raw record per customer with at least one order."""
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last_order"))
    )
    # customers grow like orders: as a broadcast they would pass whole through the driver at every reading
    joined = table(spark, folder, "customer").hint("shuffle_hash").join(
        per_customer, F.col("c_custkey") == F.col("o_custkey"))
    hashed = joined.selectExpr(
        "*",
        "((c_custkey + 1) * 48271) % 2147483647 as h1",
        "((c_custkey + 1) * 69621 + 7) % 2147483647 as h2",
    ).selectExpr(
        "*",
        "(h1 div 7) % 100 as u1", "(h2 div 11) % 100 as u2",
        "(h1 div 701) % 100 as u3", "(h2 div 1103) % 100 as u4",
        "c_nationkey % 3 = 2 as noint",
        "datediff(date'2001-08-01', to_date(last_order)) as rec",
        "1800 + (cast(round(c_acctbal * 100) as bigint) + 100000) div 110 as mc",
    ).selectExpr("*", "(mc * 3 * (n - 1) * (90 + u2 % 21)) div 100 as tc")
    return hashed.selectExpr(*[f"{_RULES[c]} as {c}" for c in RAW_COLUMNS])
