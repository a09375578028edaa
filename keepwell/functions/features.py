"""Cleaning and feature derivation as reusable Column expressions.

The batch path, the training path and the stream all call these functions, so
there is one definition of every derived column.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.schema import (
    ADDON_SERVICES, CANONICAL_COLUMNS, ENGINEERED, SPEND_DEFAULT, SPEND_EDGES,
    TARGET, TENURE_DEFAULT, TENURE_EDGES,
)


def text_to_double(name: str) -> Column:
    """Trimmed text as a number; blank or malformed text is NULL, never zero."""
    return F.expr(f"try_cast(nullif(trim(cast({name} as string)), '') as double)")


def target_flag(name: str = TARGET) -> Column:
    return F.when(F.col(name) == "Yes", 1).otherwise(0).cast("int")


def typed(df: DataFrame) -> DataFrame:
    return df.withColumns({"TotalCharges": text_to_double("TotalCharges"),
                           TARGET: target_flag()})


def is_yes(name: str, value: str = "Yes") -> Column:
    """1 when the column holds ``value``, otherwise 0 (NULL included)."""
    return F.coalesce((F.col(name) == value).cast("int"), F.lit(0))


def addon_count(services=ADDON_SERVICES) -> Column:
    return reduce(add, [is_yes(c) for c in services])


def lifetime_rate() -> Column:
    """Billed total per month; a zero tenure falls back to the current price."""
    return F.coalesce(F.try_divide("TotalCharges", F.col("tenure").cast("double")),
                      F.col("MonthlyCharges"))


def bucket(value: Column, edges, default: str, inclusive: bool) -> Column:
    """First label whose upper edge covers the value."""
    chain = None
    for edge, label in edges:
        test = value <= edge if inclusive else value < edge
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(default)


def with_engineered(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "num_addon_services": addon_count().cast("int"),
        "avg_monthly_spend": lifetime_rate(),
        "charges_ratio": F.try_divide(F.col("MonthlyCharges"), lifetime_rate()),
        "tenure_bucket": bucket(F.col("tenure"), TENURE_EDGES, TENURE_DEFAULT, True),
        "spend_bucket": bucket(F.col("MonthlyCharges"), SPEND_EDGES, SPEND_DEFAULT, False),
    })


def ensure_engineered(df: DataFrame, required) -> DataFrame:
    """Derive the engineered columns only when one is wanted and any is absent."""
    wanted = any(c in required for c in ENGINEERED)
    complete = all(c in df.columns for c in ENGINEERED)
    return with_engineered(df) if wanted and not complete else df


def canonical(df: DataFrame) -> DataFrame:
    """Restore mixed-case names, require every column and fix the order."""
    by_lower = {c.lower(): c for c in CANONICAL_COLUMNS}
    renamed = df.withColumnsRenamed(
        {c: by_lower[c.lower()] for c in df.columns if c.lower() in by_lower})
    missing = [c for c in CANONICAL_COLUMNS if c not in renamed.columns]
    if missing:
        raise ValueError(f"feature table lacks columns: {missing}")
    return renamed.select(*CANONICAL_COLUMNS)
