"""Segment reports, segment profiles and their names."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from keepwell.functions.features import is_yes
from keepwell.operators.quantiles import exact_medians
from keepwell.schema import TARGET

# --- fixed values: clustering inputs and naming limits ----------------------
CLUSTER_NUMERIC = [
    "tenure", "MonthlyCharges", "TotalCharges",
    "avg_monthly_spend", "charges_ratio", "num_addon_services",
]
CLUSTER_FLAGS = {
    "is_month_to_month": ("Contract", "Month-to-month"),
    "is_two_year": ("Contract", "Two year"),
    "has_fiber": ("InternetService", "Fiber optic"),
    "no_internet": ("InternetService", "No"),
    "is_paperless": ("PaperlessBilling", "Yes"),
    "pays_by_echeck": ("PaymentMethod", "Electronic check"),
    "has_partner": ("Partner", "Yes"),
    "has_dependents": ("Dependents", "Yes"),
}
CLUSTER_INPUTS = CLUSTER_NUMERIC + list(CLUSTER_FLAGS) + ["senior"]
HIGH_CHURN_FACTOR, LOW_CHURN_FACTOR, COMMITTED_BELOW = 1.25, 0.6, 0.5
TOP_DIFFERENCES = 4
# conditions hold together; the first row that holds names the segment
SEGMENT_NAMES = [
    (("high churn", "high spend"), "High-Value At Risk"),
    (("high churn", "short tenure"), "New and Unsettled"),
    (("high churn",), "Drifting Regulars"),
    (("low churn", "committed", "high spend"), "Premium Loyalists"),
    (("low churn", "committed"), "Locked-In Core"),
    (("low spend", "short tenure"), "Budget Newcomers"),
    (("high spend",), "Established Spenders"),
    ((), "Steady Mainstream"),
]
# --- end of fixed values ----------------------------------------------------

SEGMENT_DIMENSIONS = ["Contract", "tenure_bucket", "spend_bucket"]


def money_mean(c: str) -> Column:
    """Average of a money column, summed in cents so order cannot change it."""
    return (F.sum(F.col(c).cast("decimal(18,2)")) / F.count(c)).cast("double")


def churn_by_segment(df: DataFrame, min_customers: int = 20, with_addons: bool = True) -> DataFrame:
    """Customers, churned and averages per segment cell, small cells left out."""
    metrics = [
        F.count("*").alias("customers"),
        F.sum(TARGET).alias("churned"),
        F.round(F.avg(F.col(TARGET).cast("double")), 4).alias("churn_rate"),
        F.round(money_mean("MonthlyCharges"), 2).alias("avg_monthly_charges"),
    ]
    if with_addons:
        metrics.append(F.round(F.avg("num_addon_services"), 2).alias("avg_addons"))
    return df.groupBy(*SEGMENT_DIMENSIONS).agg(*metrics).filter(F.col("customers") >= min_customers)


def by_rate(report: DataFrame, limit: int | None = None) -> DataFrame:
    ordered = report.orderBy(F.desc("churn_rate"), *SEGMENT_DIMENSIONS)
    return ordered if limit is None else ordered.limit(limit)


def cluster_matrix(df: DataFrame, keep=(), medians: dict | None = None) -> DataFrame:
    """The fifteen clustering inputs as doubles, gaps filled with exact medians.

    Only the six numeric columns and the senior flag can hold gaps; a behaviour
    flag on a NULL is 0. The outcome never becomes an input.
    """
    if TARGET in CLUSTER_INPUTS:
        raise AssertionError("the target must not be a clustering input")
    numbers = {c: F.expr(f"try_cast({c} as double)") for c in CLUSTER_NUMERIC}
    numbers["senior"] = F.expr("try_cast(SeniorCitizen as double)")
    flags = {name: is_yes(c, v).cast("double") for name, (c, v) in CLUSTER_FLAGS.items()}
    kept = [F.col(c).alias(f"_{c}") for c in keep]
    raw = df.select(*kept, *[e.alias(n) for n, e in {**numbers, **flags}.items()])
    if medians is None:
        gaps = raw.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in numbers]).first()
        with_gaps = [c for c in numbers if gaps[c]]
        medians = exact_medians(raw, with_gaps) if with_gaps else {}
    filled = raw.fillna({c: m for c, m in medians.items() if m is not None})
    return filled.select(*[F.col(f"_{c}").alias(c) for c in keep], *CLUSTER_INPUTS)


def segment_profile(df: DataFrame, segment: str = "segment") -> DataFrame:
    """Size, churn, value and revenue at risk per segment; one shuffle."""
    share_of = lambda c, v: F.round(F.avg(is_yes(c, v).cast("double")), 4)
    base = df.groupBy(segment).agg(
        F.count("*").alias("customers"),
        F.avg(F.col(TARGET).cast("double")).alias("_rate"),
        F.round(F.avg("tenure"), 1).alias("avg_tenure"),
        F.round(money_mean("MonthlyCharges"), 2).alias("avg_monthly_charges"),
        F.round(money_mean("TotalCharges"), 2).alias("avg_total_charges"),
        F.round(F.avg("num_addon_services"), 2).alias("avg_addons"),
        share_of("Contract", "Month-to-month").alias("pct_month_to_month"),
        share_of("InternetService", "Fiber optic").alias("pct_fiber"),
        F.sum(F.col("MonthlyCharges").cast("decimal(18,2)")).cast("double").alias("_revenue"),
    )
    everything = Window.partitionBy()          # one row per segment
    return base.select(
        segment, "customers",
        F.round(F.col("customers") / F.sum("customers").over(everything), 4).alias("share"),
        F.round("_rate", 4).alias("churn_rate"),
        "avg_tenure", "avg_monthly_charges", "avg_total_charges", "avg_addons",
        "pct_month_to_month", "pct_fiber",
        F.round("_revenue", 2).alias("monthly_revenue"),
        F.round(F.col("_revenue") / F.sum("_revenue").over(everything), 4).alias("monthly_revenue_share"),
        F.round(F.col("_revenue") * F.col("_rate"), 2).alias("monthly_revenue_at_risk"),
    )


def segment_differences(matrix: DataFrame, segment: str = "segment",
                        top: int | None = TOP_DIFFERENCES) -> DataFrame:
    """Standardised distance of each segment's mean from the overall mean.

    Per-segment counts, sums and squared sums are one aggregate; the overall
    mean and sample deviation follow from the same few rows. Sums are centred
    on a rough mean first so the squares keep their precision.
    """
    rough = matrix.agg(*[F.avg(c).alias(c) for c in CLUSTER_INPUTS]).first()
    centred = {c: F.col(c) - F.lit(float(rough[c] or 0.0)) for c in CLUSTER_INPUTS}
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s_{c}").alias("s"),
                               F.col(f"q_{c}").alias("q")) for c in CLUSTER_INPUTS])
    sums = matrix.groupBy(segment).agg(
        F.count("*").alias("n"),
        *[e for c, x in centred.items() for e in (F.sum(x).alias(f"s_{c}"), F.sum(x * x).alias(f"q_{c}"))])
    long = (sums.select(segment, "n", F.explode(cells).alias("c"))
            .select(segment, "n", "c.*"))
    overall = Window.partitionBy("feature")    # one row per segment
    total = F.sum("n").over(overall)
    mean = F.sum("s").over(overall) / total
    variance = (F.sum("q").over(overall) - total * mean * mean) / (total - 1)
    scored = (
        long.withColumns({"mean": mean, "sd": F.sqrt(F.greatest(variance, F.lit(0.0)))})
        .withColumn("distance", F.try_divide(F.col("s") / F.col("n") - F.col("mean"), F.col("sd")))
        .filter("distance is not null")
        .withColumn("rank", F.row_number().over(
            Window.partitionBy(segment).orderBy(F.desc(F.abs("distance")), "feature")))
    )
    out = scored.select(segment, "feature", "distance", "rank")
    return out if top is None else out.filter(F.col("rank") <= top)


def differences_map(differences: DataFrame, segment: str = "segment") -> DataFrame:
    """Top differences of a segment as an ordered map."""
    entry = F.struct("rank", "feature", F.round("distance", 2).alias("distance"))
    return differences.groupBy(segment).agg(
        F.map_from_entries(F.transform(
            F.array_sort(F.collect_list(entry)),
            lambda e: F.struct(e["feature"], e["distance"]))).alias("distinguishing_features"))


def name_segments(profiles: DataFrame, segment: str = "segment") -> DataFrame:
    """Rule-based names from the profile; a repeated name gets its segment id.

    The profile has one row per segment, so its windows are tiny.
    """
    everything = Window.partitionBy()
    judged = profiles.withColumns({
        "_base": F.sum(F.col("churn_rate") * F.col("customers")).over(everything)
        / F.sum("customers").over(everything),
        "_tenure": F.median("avg_tenure").over(everything),
        "_spend": F.median("avg_monthly_charges").over(everything)})
    longer, dearer = F.col("avg_tenure") > F.col("_tenure"), F.col("avg_monthly_charges") > F.col("_spend")
    holds = {
        "high churn": F.col("churn_rate") > F.col("_base") * HIGH_CHURN_FACTOR,
        "low churn": F.col("churn_rate") < F.col("_base") * LOW_CHURN_FACTOR,
        "committed": F.col("pct_month_to_month") < COMMITTED_BELOW,
        "short tenure": ~longer, "high spend": dearer, "low spend": ~dearer}
    rules = [F.when(reduce(and_, [holds[c] for c in conditions], F.lit(True)), F.lit(name)) for conditions, name in SEGMENT_NAMES]
    label = F.coalesce(*rules)
    named = judged.withColumn("_label", label)
    repeat = F.row_number().over(Window.partitionBy("_label").orderBy(segment)) > 1
    suffix = F.format_string("%s (%d)", F.col("_label"), F.col(segment))
    return (named.withColumn("name", F.when(repeat, suffix).otherwise(F.col("_label")))
            .drop("_base", "_tenure", "_spend", "_label"))


def most_exposed(profiles: DataFrame) -> DataFrame:
    """The segment with the largest monthly revenue at risk."""
    row = F.struct(*profiles.columns)
    return profiles.agg(F.max_by(row, "monthly_revenue_at_risk").alias("r")).select("r.*")
