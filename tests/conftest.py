import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (SparkSession.builder.master("local[4]").appName("tests")
         .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from keepwell.session import ship_package
    ship_package(s)
    yield s
    s.stop()


RAW = {
    "gender": ["Male", "Female"], "Partner": ["Yes", "No"], "Dependents": ["No", "Yes"], "PhoneService": ["Yes"],
    "MultipleLines": ["No", "Yes"], "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": ["Yes", "No", "No internet service"], "OnlineBackup": ["No", "Yes", "No internet service"],
    "DeviceProtection": ["No", "No", "No internet service"], "TechSupport": ["Yes", "No", "No internet service"],
    "StreamingTV": ["Yes", "Yes", "No internet service"], "StreamingMovies": ["No", "No", "No internet service"],
    "Contract": ["Month-to-month", "One year", "Two year"], "PaperlessBilling": ["Yes", "No"],
    "PaymentMethod": ["Electronic check", "Mailed check"],
}


def raw_rows(n):
    """Records with cycled levels; the first has tenure 0 and a blank total."""
    rows = []
    for i in range(n):
        row = {c: v[i % len(v)] for c, v in RAW.items()}
        row.update(customerID=f"C{i:04d}", SeniorCitizen=i % 2, tenure=i * 6, MonthlyCharges=20.0 + 5 * i,
                   TotalCharges=" " if i == 0 else str((20.0 + 5 * i) * i * 6), Churn="Yes" if i % 3 == 0 else "No")
        rows.append(row)
    return rows


@pytest.fixture()
def raw(spark):
    from keepwell.schema import RAW_COLUMNS, RAW_SCHEMA
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in raw_rows(12)], RAW_SCHEMA)
