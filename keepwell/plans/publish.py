"""Published tables: customers, master, facts, dictionary and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keepwell.functions.scoring import (
    MONTHS, caption, hard_prediction, prediction_outcome, risk_category, sd_map_text,
)
from keepwell.operators.contributions import with_top_drivers
from keepwell.operators.quantiles import bin_index, quantile_edges
from keepwell.schema import ID, TARGET

# --- fixed values ------------------------------------------------------------
MIN_ROC_AUC = 0.78
DECILES = 10
BALANCE_LIMIT = 0.1
IDENTIFIER_COLUMNS = ["customerID", "model_version", "segment", "rank", "rank_within_customer", "risk_decile"]
# --- end of fixed values ----------------------------------------------------


def customer_table(scored: DataFrame, version: str, model_name: str,
                   segments: DataFrame | None = None) -> DataFrame:
    """One row per scored customer with band, decile, outcome, revenue, segment."""
    p = F.col("churn_probability")
    edges = quantile_edges(scored, "churn_probability", DECILES)
    if "prediction" not in scored.columns:
        scored = scored.withColumn("prediction", hard_prediction(p))
    out = scored.withColumns({
        "risk_category": risk_category(p),
        "risk_decile": (bin_index(p, edges) + 1).cast("int"),
        "model_version": F.lit(version), "model_name": F.lit(model_name)})
    if TARGET in scored.columns:
        actual = F.col(TARGET).cast("int")
        out = out.withColumns({"actual_churn": actual,
                               "prediction_outcome": prediction_outcome(F.col("prediction"), actual)})
    annual = F.col("MonthlyCharges") * MONTHS
    out = out.withColumns({"annual_revenue": annual, "revenue_at_risk": annual * p})
    return out if segments is None else out.join(segments, ID, "left")


def master_table(customers: DataFrame, top: int = 3) -> DataFrame:
    """Customer rows with their strongest drivers; unchanged without contributions."""
    return with_top_drivers(customers, top)


def gain_curve(customers: DataFrame) -> DataFrame:
    """Outcomes per decile and their running total, riskiest decile first."""
    from pyspark.sql import Window
    per = customers.groupBy("risk_decile").agg(
        F.count("*").alias("customers"), F.sum("actual_churn").alias("churned"))
    upto = Window.orderBy(F.desc("risk_decile")).rowsBetween(Window.unboundedPreceding, 0)   # <= 10 rows
    return per.withColumns({"cumulative_churned": F.sum("churned").over(upto),
                            "cumulative_customers": F.sum("customers").over(upto)})


def experiment_fact(retention: DataFrame, revenue: DataFrame, run: str) -> DataFrame:
    """Retention and revenue readout in one tidy shape."""
    shape = lambda d, metric, t, c, diff, effect, name: d.select(
        F.lit(run).alias("run"), F.lit(metric).alias("metric"), F.col(t).alias("treatment"),
        F.col(c).alias("control"), F.col(diff).alias("difference"), "ci_low", "ci_high", "p_value",
        "significant", F.col(effect).alias("effect_size"), F.lit(name).alias("effect_size_name"))
    return (shape(retention, "retention rate", "rate_treatment", "rate_control", "absolute_difference", "cohens_h", "Cohen's h")
            .unionByName(shape(revenue, "net revenue per customer", "mean_t", "mean_c", "difference", "cohens_d", "Cohen's d")))


def power_fact(verdicts: DataFrame, experiment: str) -> DataFrame:
    """Design and verdict of an experiment in one row per design."""
    return verdicts.select(
        F.lit(experiment).alias("experiment"), F.col("mde_absolute").alias("pre_registered_mde"),
        F.col("absolute_difference").alias("observed_effect"), "p_value", "required_n_per_arm", "available_n_per_arm",
        "adequately_powered", "verdict", F.col("detectable_mde").alias("detectable_mde_at_available_n"))


def causal_fact(naive: DataFrame, adjusted: DataFrame, instrument: DataFrame, did: DataFrame,
                interaction: DataFrame) -> DataFrame:
    """Naive and adjusted estimates of all designs, one row each.

    ``adjusted`` has (estimator, estimate, ci_low, ci_high, note); ``instrument``
    is the instrument readout; ``did`` the cell table; ``interaction`` its term.
    """
    null = F.lit(None).cast("double")
    row = lambda d, analysis, name, value, low, high, adj, note: d.select(
        F.lit(analysis).alias("analysis"), name.alias("estimator"), value.alias("estimate"),
        low.alias("ci_low"), high.alias("ci_high"), F.lit(adj).alias("adjusted"), note.alias("note"))
    no_note = F.lit("")
    out = row(naive, "Propensity scoring", F.lit("Naive difference"), F.col("naive_difference"), null, null, False,
              F.lit("confounded by who takes the treatment"))
    out = out.unionByName(row(adjusted, "Propensity scoring", F.replace("estimator", F.lit("_"), F.lit(" ")),
                              F.col("estimate"), F.col("ci_low"), F.col("ci_high"), True, F.col("note")))
    for key, name, adj in (("naive_ols", "Naive OLS", False), ("intention_to_treat", "Intention to treat", True),
                           ("two_stage_least_squares", "2SLS / LATE", True)):
        out = out.unionByName(row(instrument.filter(F.col("estimator") == key), "Instrumental variables", F.lit(name),
                                  F.col("estimate"), F.col("ci_low"), F.col("ci_high"), adj, no_note))
    for key, name in (("naive_post_period", "Naive post-period"), ("treated_change", "Naive before/after")):
        out = out.unionByName(row(did, "Difference-in-differences", F.lit(name), F.col(key), null, null, False, no_note))
    term = interaction.filter("term = 'did'").select("ci_low", "ci_high")
    return out.unionByName(row(did.join(term), "Difference-in-differences", F.lit("Difference-in-differences"),
                               F.col("did_estimate"), F.col("ci_low"), F.col("ci_high"), True, no_note))


def balance_fact(before: DataFrame, after: DataFrame, top: int | None = None) -> DataFrame:
    """Imbalance before and after matching, worst first (all, or the ``top``)."""
    out = before.select("covariate", F.col("smd").alias("smd_before")).join(
        after.select("covariate", F.col("smd").alias("smd_after")), "covariate")
    out = out.withColumn("balanced_after", F.abs("smd_after") <= BALANCE_LIMIT).orderBy(
        F.desc(F.abs("smd_before")), "covariate")
    return out if top is None else out.limit(top)


def segment_dimension(profile: DataFrame, names: DataFrame, differences: DataFrame) -> DataFrame:
    """Segment profile with its name and readable differences (row per segment)."""
    text = differences.select("segment", sd_map_text(F.col("distinguishing_features")).alias("distinguishing_features"))
    return profile.join(names.select("segment", "name"), "segment").join(text, "segment")


def data_dictionary(tables: dict[str, DataFrame], notes: dict[str, str] | None = None) -> DataFrame:
    """Row per published column: type, caption and dashboard role.

    Identifiers are dimensions even when numeric.
    """
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        n = df.count()
        for f in df.schema:
            kind = f.dataType.typeName()
            numeric = kind in ("integer", "long", "double", "float", "decimal", "short", "byte")
            measure = numeric and f.name not in IDENTIFIER_COLUMNS
            datatype = ("real" if kind in ("double", "float", "decimal") else "integer" if numeric
                        else "boolean" if kind == "boolean" else "datetime" if kind in ("timestamp", "date") else "string")
            rows.append((name, (notes or {}).get(name), n, len(df.columns), f.name, datatype,
                         "measure" if measure else "dimension",
                         "quantitative" if measure else "nominal"))
    return spark.createDataFrame(
        rows, "table_name string, note string, row_count long, column_count int, column_name string, "
        "datatype string, role string, kind string").withColumn("caption", caption(F.col("column_name")))


def model_gate(comparison: DataFrame, minimum: float = MIN_ROC_AUC) -> DataFrame:
    """Verdict on the deployed candidate; reaching the minimum passes."""
    passed = F.col("roc_auc") >= minimum
    return comparison.filter("deployed").select(
        "model", "roc_auc", F.lit(minimum).alias("threshold"), passed.alias("passed"),
        F.format_string("ROC-AUC %.4f %s the %.2f threshold", F.col("roc_auc"),
                        F.when(passed, "meets").otherwise("is below"), F.lit(minimum)).alias("reason"))


def require_no_drift(flagged: DataFrame) -> None:
    """Stop a run when any feature drifted."""
    names = [r["feature"] for r in flagged.select("feature").distinct().orderBy("feature").collect()]
    if names:
        raise RuntimeError(f"drift detected in: {', '.join(names)}")
