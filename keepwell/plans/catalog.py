"""Registered queries: every operator applied to the given tables.

Each function takes (spark, folder) and returns a DataFrame. Results are
rounded only here, so they can be compared across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from keepwell.functions import scoring as S
from keepwell.functions.features import canonical, is_yes, typed, with_engineered
from keepwell.operators import (
    causal, cluster, contributions as contrib, encode, experiment as ex, explain, interpret, lloyd, matching,
    metrics, models, power, profile, regression, segments as seg,
)
from keepwell.operators.quantiles import exact_median
from keepwell.operators.ranking import average_ranks, cumulative_by_value
from keepwell.plans import pipeline, publish, reports
from keepwell.schema import (
    ADDON_SERVICES, CONTRACT_LEVELS, ENGINEERED, ENGINEERED_NUMERIC, ID, NOMINAL, NUMERIC,
    ORDINAL, RAW_COLUMNS, TARGET, drop_non_features, unknown_targets as count_unknown,
)
from keepwell.session import for_iteration, scratch_folder
from keepwell.sources import store
from keepwell.sources.customers import customer_frame, table
from keepwell.sources.panels import activity_panel
from keepwell.streaming import scoring as online

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Coefficients of a fixed linear score, applied in this order.
INTERCEPT = -0.4
WEIGHTS = {
    "tenure": -0.045, "MonthlyCharges": 0.012, "is_month_to_month": 0.5, "is_two_year": -0.7,
    "has_fiber": 0.3, "pays_by_echeck": 0.25, "has_support": -0.3, "num_addon_services": -0.1,
    "SeniorCitizen": 0.2,
}
RIVAL_INTERCEPT = 0.2
RIVAL_WEIGHTS = {
    "tenure": -0.05, "is_month_to_month": 0.6, "is_two_year": -0.6, "has_fiber": 0.4,
    "num_addon_services": -0.1,
}
SEED = 42
TARGET_SCORE = 0.5


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def r(c: str | Column, digits: int = 6) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    out = F.round(column, digits)
    return out.alias(c) if isinstance(c, str) else out


# --- shared frames -----------------------------------------------------------

def clean(spark, d) -> DataFrame:
    frame = typed(customer_frame(spark, d))
    median = exact_median(frame, "TotalCharges")
    return frame.fillna({"TotalCharges": median})


def features(spark, d) -> DataFrame:
    return with_engineered(clean(spark, d))


def score_terms() -> dict[str, Column]:
    return {
        "tenure": F.col("tenure"), "MonthlyCharges": F.col("MonthlyCharges"),
        "is_month_to_month": is_yes("Contract", "Month-to-month"), "is_two_year": is_yes("Contract", "Two year"),
        "has_fiber": is_yes("InternetService", "Fiber optic"),
        "pays_by_echeck": is_yes("PaymentMethod", "Electronic check"), "has_support": is_yes("TechSupport"),
        "num_addon_services": F.col("num_addon_services"), "SeniorCitizen": F.col("SeniorCitizen"),
    }


def _score(weights, intercept) -> Column:
    total, terms = F.lit(intercept), score_terms()
    for name, w in weights.items():
        total = total + F.lit(w) * terms[name]
    return F.round(S.sigmoid(total), 6)


def with_score(df: DataFrame) -> DataFrame:
    p = F.col("churn_probability")
    return df.withColumn("churn_probability", _score(WEIGHTS, INTERCEPT)).withColumn("prediction", S.hard_prediction(p))


def scored(spark, d) -> DataFrame:
    # The score uses no column the median fill touches.
    return with_score(with_engineered(typed(customer_frame(spark, d))))


def ruled_segments(df: DataFrame) -> DataFrame:
    """A fixed rule-based labelling for the profile and quality operators."""
    monthly, fiber = F.col("Contract") == "Month-to-month", F.col("InternetService") == "Fiber optic"
    return df.withColumn("segment", F.when(monthly & fiber, 0).when(monthly, 1).when(F.col("tenure") <= 30, 2).otherwise(3))


# --- cleaning and features ---------------------------------------------------

@query
def clean_customers(spark, d):
    return clean(spark, d).select(*[r(c, 4) if c == "TotalCharges" else c for c in RAW_COLUMNS])


@query
def median_total_charges(spark, d):
    frame = typed(customer_frame(spark, d))
    return frame.agg(F.count("TotalCharges").alias("n"), F.count_if(F.col("TotalCharges").isNull()).alias("blank")
                     ).withColumn("median_total_charges", F.round(F.lit(exact_median(frame, "TotalCharges")), 4))


@query
def engineered_features(spark, d):
    return features(spark, d).select(ID, "num_addon_services", r("avg_monthly_spend"), r("charges_ratio"),
                                     "tenure_bucket", "spend_bucket")


@query
def canonical_export(spark, d):
    lower = features(spark, d)
    lower = lower.withColumnsRenamed({c: c.lower() for c in lower.columns})
    rounded = {"TotalCharges", "avg_monthly_spend", "charges_ratio"}
    out = canonical(lower)
    return out.select(*[r(c) if c in rounded else c for c in out.columns])


@query
def unknown_targets(spark, d):
    return count_unknown(customer_frame(spark, d))


@query
def contract_split(spark, d):
    """Records as JSON text, parsed and checked; blank totals are rejected."""
    frame = typed(customer_frame(spark, d)).drop(TARGET)
    records = online.parse(frame.select(F.to_json(F.struct("*")).alias("value")))
    return online.contract_split(records).groupBy(
        "valid", F.array_join("problems", "; ").alias("problem")).agg(F.count("*").alias("records"))


# --- segment reports ---------------------------------------------------------

@query
def churn_by_segment(spark, d):
    return seg.by_rate(seg.churn_by_segment(features(spark, d)))


@query
def top_segments(spark, d):
    return seg.by_rate(seg.churn_by_segment(features(spark, d), with_addons=False), 20)


# --- baselines and drift -----------------------------------------------------

def halves(spark, d):
    """Customers paying by check stand for training, automatic payers for scoring."""
    frame = features(spark, d)
    by_check = F.col("PaymentMethod").isin("Electronic check", "Mailed check")
    return drop_non_features(frame.filter(by_check)), drop_non_features(frame.filter(~by_check))


@query
def baseline_numeric(spark, d):
    return profile.numeric_baseline(features(spark, d)).select("feature", *[r(c, 4) for c in ("mean", "std", "min", "max")])


@query
def baseline_long(spark, d):
    return profile.baseline_stats(features(spark, d)).select("feature", "stat", r("value", 4))


@query
def baseline_categorical(spark, d):
    return profile.categorical_baseline(features(spark, d)).select("feature", "category", "n", r("share"))


@query
def drift_numeric(spark, d):
    train, batch = halves(spark, d)
    out = profile.numeric_drift(profile.numeric_baseline(train), profile.numeric_baseline(batch))
    return out.select("feature", *[r(c, 4) for c in (
        "train_mean", "scoring_mean", "mean_drift_percent", "train_std", "scoring_std", "std_drift_percent")], "drifted")


@query
def drift_categorical(spark, d):
    train, batch = halves(spark, d)
    out = profile.categorical_drift(profile.categorical_baseline(train), profile.categorical_baseline(batch), batch.columns)
    return out.select("feature", r("tvd", 4), "drifted", F.array_join("new_categories", "|").alias("new_categories"),
                      F.array_join("missing_categories", "|").alias("missing_categories"))


@query
def category_alignment(spark, d):
    train, batch = halves(spark, d)
    out = profile.aligned_shares(profile.categorical_baseline(train), profile.categorical_baseline(batch), batch.columns)
    return out.select("feature", "category", r("train_share"), r("scoring_share"))


@query
def drift_summary(spark, d):
    train, batch = halves(spark, d)
    out = profile.drift_report(train, batch.drop("charges_ratio").withColumn("channel", F.lit("branch")))["summary"]
    return out.withColumns({c: F.array_join(c, "|") for c in ("missing_features", "extra_features")})


@query
def drift_gate(spark, d):
    train, batch = halves(spark, d)
    report = profile.drift_report(train, batch)
    return profile.flagged_features(report["numeric"], report["categorical"])


@query
def event_drift(spark, d):
    """First against second half of the event month."""
    events = table(spark, d, "events")
    first = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    sides = [events.filter(first), events.filter(~first)]
    numeric = profile.numeric_drift(*[profile.numeric_baseline(s, ["value"]) for s in sides])
    types = profile.categorical_drift(*[profile.categorical_baseline(s, ["event_type"]) for s in sides])
    return numeric.select("feature", r("mean_drift_percent", 4).alias("shift"), "drifted").unionByName(
        types.select("feature", r("tvd", 6).alias("shift"), "drifted"))


# --- exploration -------------------------------------------------------------

EDA_LEVELS = [*NOMINAL, *ORDINAL, "SeniorCitizen"]
EDA_NUMBERS = ["tenure", "MonthlyCharges", "TotalCharges"]


@query
def eda_missing(spark, d):
    return profile.missing_counts(customer_frame(spark, d))


@query
def eda_describe(spark, d):
    out = profile.describe(clean(spark, d), NUMERIC)
    return out.select("feature", "n", *[r(c, 4) for c in ("mean", "std", "min", "max", "q25", "q50", "q75")])


@query
def eda_class_balance(spark, d):
    return profile.class_balance(customer_frame(spark, d), TARGET).select(TARGET, "n", r("percent", 4), r("imbalance_ratio", 4))


@query
def eda_churn_by_level(spark, d):
    frame = typed(customer_frame(spark, d))
    return profile.rate_by_level(frame, EDA_LEVELS, TARGET).select("feature", "category", "n", "positives", r("rate"))


@query
def eda_histogram(spark, d):
    out = profile.class_histogram(clean(spark, d), ["tenure", "MonthlyCharges", "TotalCharges"], TARGET)
    return out.select("feature", "class", "bin", r("lo", 4), r("hi", 4), "n", r("density"))


@query
def eda_correlation(spark, d):
    return profile.correlation_pairs(clean(spark, d), [*EDA_NUMBERS, "SeniorCitizen", TARGET]).select(
        "feature_a", "feature_b", r("r"))


@query
def eda_point_biserial(spark, d):
    from keepwell.functions import tails
    out = profile.point_biserial(clean(spark, d), [*EDA_NUMBERS, "SeniorCitizen"], TARGET)
    out = out.withColumn("p_value", tails.p_student(F.col("t"), F.col("dof")))
    return out.select("feature", "n", "dof", r("r"), r("t", 4), r("p_value"), profile.stars(F.col("p_value")).alias("stars"))


# --- scores ------------------------------------------------------------------

@query
def score_linear(spark, d):
    return scored(spark, d).select(ID, "churn_probability", "prediction")


@query
def risk_bands(spark, d):
    p = F.col("churn_probability")
    return scored(spark, d).groupBy(S.risk_category(p).alias("risk_category"), S.risk_band_sortable(p).alias("risk_band")).agg(
        F.count("*").alias("customers"))


@query
def confusion_labels(spark, d):
    out = S.prediction_outcome(F.col("prediction"), F.col(TARGET))
    right = (F.col("prediction") == F.col(TARGET)).cast("int")
    return scored(spark, d).select(ID, out.alias("prediction_outcome"), right.alias("correct_prediction"))


@query
def revenue_at_risk(spark, d):
    annual = F.col("MonthlyCharges") * S.MONTHS
    offer = annual * F.col("churn_probability") * 0.2 - 50
    return scored(spark, d).select(ID, r(annual, 2).alias("annual_revenue"),
                                   r(annual * F.col("churn_probability"), 8).alias("revenue_at_risk"),
                                   r(offer, 8).alias("expected_offer_value"))


@query
def top_risks(spark, d):
    return scored(spark, d).select(ID, "churn_probability").orderBy(F.desc("churn_probability"), ID).limit(10)


def customers_published(spark, d) -> DataFrame:
    return publish.customer_table(scored(spark, d), "v1", "linear_score")


@query
def customer_table(spark, d):
    segments = ruled_segments(features(spark, d)).select(ID, "segment")
    out = publish.customer_table(scored(spark, d), "v1", "linear_score", segments)
    return out.select(ID, "churn_probability", "prediction", "risk_category", "risk_decile", "model_version", "model_name",
                      "actual_churn", "prediction_outcome", r("annual_revenue", 2), r("revenue_at_risk", 8), "segment")


@query
def decile_outcome(spark, d):
    return customers_published(spark, d).groupBy("risk_decile").agg(
        F.count("*").alias("customers"), r(F.avg("actual_churn")).alias("churn_rate"),
        r(F.avg("churn_probability")).alias("mean_score"))


@query
def gain_curve(spark, d):
    return publish.gain_curve(customers_published(spark, d))


@query
def band_rollup(spark, d):
    band = S.risk_band_sortable(F.col("churn_probability")).alias("risk_band")
    annual = F.col("MonthlyCharges") * S.MONTHS
    return scored(spark, d).groupBy(band).agg(
        F.count_distinct(ID).alias("customers"), r(F.sum(annual * F.col("churn_probability")), 2).alias("revenue_at_risk"),
        r(F.avg(F.col(TARGET).cast("double"))).alias("churn_rate"))


@query
def segment_scatter(spark, d):
    """Segment positions with the overall rate as reference line."""
    rows = ruled_segments(scored(spark, d)).groupBy("segment").agg(
        F.count("*").alias("customers"), F.avg("MonthlyCharges").alias("m"), F.sum(TARGET).alias("churned"))
    everything = Window.partitionBy()          # one row per segment
    return rows.select("segment", "customers", r("m", 4).alias("avg_monthly_charges"),
                       r(F.col("churned") / F.col("customers")).alias("churn_rate"),
                       r(F.sum("churned").over(everything) / F.sum("customers").over(everything)).alias("overall_rate"))


@query
def extract_counts(spark, d):
    long = contrib.long_contributions(explained(spark, d))
    return long.agg(F.count("*").alias("contribution_rows"), F.count_distinct(ID).alias("customers"),
                    F.count_distinct("feature").alias("features"))


# --- metrics -----------------------------------------------------------------

@query
def classification_metrics(spark, d):
    return metrics.classification(scored(spark, d), TARGET, "prediction").select(
        "tp", "fp", "fn", "support", r("precision"), r("recall"), r("f1_score"))


@query
def class_weight(spark, d):
    return encode.positive_weight(typed(customer_frame(spark, d))).withColumn("scale_pos_weight", r("scale_pos_weight"))


@query
def roc_auc_exact(spark, d):
    return metrics.roc_auc(scored(spark, d), TARGET, "churn_probability").withColumn("roc_auc", r("roc_auc"))


@query
def score_agreement(spark, d):
    rows = scored(spark, d).select(TARGET, "churn_probability", _score(RIVAL_WEIGHTS, RIVAL_INTERCEPT).alias("rival"))
    out = metrics.score_agreement(rows, TARGET, "churn_probability", "rival")
    return out.select(*[r(c) for c in ("pearson_r", "spearman_rho", "first_auc", "second_auc", "auc_gap",
                                       "mean_abs_probability_gap")], "ranks_differ")


@query
def score_ranks(spark, d):
    return average_ranks(scored(spark, d), "churn_probability", "average_rank")


# --- contributions -----------------------------------------------------------

def explained(spark, d) -> DataFrame:
    return contrib.linear_contributions(scored(spark, d), score_terms(), WEIGHTS)


@query
def linear_contributions(spark, d):
    return contrib.long_contributions(explained(spark, d)).select(
        ID, "feature", r("shap_value"), r("feature_value"), r("abs_shap"), "direction", "rank_within_customer")


@query
def global_importance(spark, d):
    return contrib.global_importance(explained(spark, d)).select(
        "feature", r("mean_abs_shap"), "rank")


@query
def master_table(spark, d):
    frame = contrib.linear_contributions(scored(spark, d), score_terms(), WEIGHTS)
    out = publish.master_table(publish.customer_table(frame, "v1", "linear_score"))
    drivers = [c for k in (1, 2, 3) for c in (f"driver_{k}_feature", f"driver_{k}_direction")]
    return out.select(ID, "churn_probability", "risk_category", "risk_decile", *drivers,
                      *[r(f"driver_{k}_shap") for k in (1, 2, 3)])


@query
def drivers_by_pivot(spark, d):
    frame = explained(spark, d)
    out = contrib.drivers_from_long(contrib.long_contributions(frame), frame.select(ID, "churn_probability"))
    return out.select(ID, "churn_probability", "driver_1_feature", "driver_2_feature", "driver_3_feature")


# --- splits and experiment ---------------------------------------------------

@query
def stratified_split(spark, d):
    return encode.stratified_split(typed(customer_frame(spark, d)), ID, SEED).select(ID, TARGET, "split")


def assigned(spark, d) -> DataFrame:
    return ex.assign_arms(scored(spark, d), TARGET_SCORE, SEED)


def outcomes(spark, d) -> DataFrame:
    return ex.with_outcomes(assigned(spark, d), F.col(TARGET))


@query
def stratified_assignment(spark, d):
    return assigned(spark, d).select(ID, "risk_stratum", "group")


@query
def arm_summary(spark, d):
    return ex.arms_wide(outcomes(spark, d), ["retained", "revenue_net"]).select(
        "metric", "n_t", "n_c", *[r(c, 4) for c in ("sum_t", "sum_c", "mean_t", "mean_c", "var_t", "var_c")])


@query
def balance_check(spark, d):
    out = ex.welch_t(ex.arms_wide(assigned(spark, d), ["churn_probability"]))
    return out.select("n_t", "n_c", r("mean_t"), r("mean_c"), r("t_statistic"), r("degrees_of_freedom", 4), r("p_value"))


Z_COLUMNS = ("rate_treatment", "rate_control", "absolute_difference", "relative_lift", "z_statistic", "p_value",
             "ci_low", "ci_high", "cohens_h")


@query
def ab_retention_z(spark, d):
    arms = ex.arms_wide(outcomes(spark, d), ["retained"])
    return ex.two_proportion_z(arms).select("n_t", "n_c", *[r(c) for c in Z_COLUMNS], "significant")


@query
def aa_control(spark, d):
    halves_ = ex.same_arm_halves(outcomes(spark, d), SEED + 1)
    return ex.two_proportion_z(ex.arms_wide(halves_, ["retained"])).select(
        "n_t", "n_c", *[r(c) for c in ("rate_treatment", "rate_control", "z_statistic", "p_value")], "significant")


@query
def ab_contingency(spark, d):
    return ex.contingency(outcomes(spark, d)).select("group", F.col("0").alias("stayed"), F.col("1").alias("left_"))


@query
def ab_chi_square(spark, d):
    return ex.chi_square_2x2(ex.contingency(outcomes(spark, d))).select(
        "n", r("chi2_statistic"), "degrees_of_freedom", r("cramers_v"), r("p_value"), "significant")


@query
def ab_revenue_welch(spark, d):
    return ex.welch_t(ex.arms_wide(outcomes(spark, d), ["revenue_net"])).select(
        "n_t", "n_c", *[r(c, 4) for c in ("mean_t", "mean_c", "difference", "t_statistic", "degrees_of_freedom",
                                          "p_value", "cohens_d")], "significant")


@query
def ab_impact(spark, d):
    return ex.business_impact(ex.arms_wide(outcomes(spark, d), ["revenue_net"])).select(
        "n_treatment", r("net_revenue_gain", 2), r("campaign_cost", 2))


@query
def holm(spark, d):
    """Retention gap of each contract against the rest, corrected as a family."""
    frame = scored(spark, d)
    arms = None
    for level in CONTRACT_LEVELS:
        grouped = frame.select(F.when(F.col("Contract") == level, "treatment").otherwise("control").alias("group"),
                               (1 - F.col(TARGET)).alias("retained"))
        one = ex.arms_wide(grouped, ["retained"]).withColumn("metric", F.lit(level))
        arms = one if arms is None else arms.unionByName(one)
    return ex.holm(ex.two_proportion_z(arms)).select("metric", r("p_value"), r("adjusted_threshold"),
                                                     "significant_after_correction")


def designs(spark, d) -> DataFrame:
    targeted = S.target_population(scored(spark, d), 0.3)
    return power.design_table(power.design_inputs(targeted, ["Contract"]))


@query
def design_table(spark, d):
    return designs(spark, d).select("Contract", r("baseline_rate"), "available_n_per_arm", r("revenue_sd", 4),
                                    "required_n_per_arm", r("detectable_mde"), "adequately_powered",
                                    power.required_n_mean(F.col("revenue_sd"), F.lit(50.0)).alias("required_n_revenue"))


@query
def power_curve(spark, d):
    return power.power_curve(designs(spark, d)).select(
        "Contract", "n_per_arm", r("effect"), r("power"))


@query
def verdicts(spark, d):
    """Each contract's readout judged against that contract's own design."""
    arms = ex.two_proportion_z(ex.arms_wide(outcomes(spark, d), ["retained"], by=["Contract"]))
    out = power.verdict(arms.join(designs(spark, d), "Contract"))     # one row per contract on both sides
    return out.select("Contract", r("p_value"), "required_n_per_arm", "available_n_per_arm", "adequately_powered",
                      "verdict", "inflation_caveat",
                      r(power.power_at(F.col("available_n_per_arm"), F.col("baseline_rate"), F.col("mde_absolute"))).alias("achieved_power"))


# --- encoding ----------------------------------------------------------------

@query
def category_levels(spark, d):
    return encode.category_levels(features(spark, d), [*NOMINAL, "tenure_bucket", "spend_bucket"]).select(
        "feature", F.array_join("levels", "|").alias("levels"))


@query
def category_codes(spark, d):
    """Levels pinned on check payers; other payment methods are unseen (-1)."""
    frame = typed(customer_frame(spark, d))
    pinned = encode.pinned_levels(frame.filter(F.col("PaymentMethod").endswith("check")), NOMINAL)
    return encode.with_codes(frame, pinned).select(ID, *NOMINAL, encode.contract_code().alias("contract_code"))


@query
def one_hot(spark, d):
    """Column sums of the full one-hot design through the ML encoder."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    frame = typed(customer_frame(spark, d)).withColumn("Contract_code", encode.contract_code().cast("double"))
    names = list(NOMINAL)
    fitted = Pipeline(stages=encode.linear_stages(names, ["Contract"], ["tenure"])).fit(frame)
    labels = [f"{c}_{v}" for c, ls in zip(names, fitted.stages[0].labelsArray) for v in ls] + ["Contract_code", "tenure"]
    values = vector_to_array("features")
    pairs = F.array(*[F.struct(F.lit(n).alias("term"), values[i].alias("v")) for i, n in enumerate(labels)])
    return fitted.transform(frame).select(F.explode(pairs).alias("p")).groupBy("p.term").agg(F.sum("p.v").alias("total"))


@query
def reference_design(spark, d):
    frame = typed(customer_frame(spark, d))
    terms = encode.reference_design(frame, NOMINAL, ["Contract"], ["tenure"])
    return frame.select(ID, *[c.alias(n.replace(" ", "_").replace("(", "").replace(")", "").replace("-", "_")) for n, c in terms.items()])


@query
def standardised(spark, d):
    frame = clean(spark, d)
    terms = {c: F.col(c) for c in NUMERIC}
    z = encode.scaled(terms, encode.scaling(frame, terms))
    return frame.select(ID, *[r(e, 6).alias(n) for n, e in z.items()])


# --- segments ----------------------------------------------------------------

@query
def segment_profile(spark, d):
    return seg.segment_profile(ruled_segments(features(spark, d)))


@query
def segment_differences(spark, d):
    matrix = seg.cluster_matrix(ruled_segments(features(spark, d)), ["segment"])
    return seg.segment_differences(matrix).select("segment", "feature", r("distance", 4), "rank")


@query
def segment_names(spark, d):
    return seg.name_segments(seg.segment_profile(ruled_segments(features(spark, d)))).select("segment", "name", "customers")


@query
def most_exposed(spark, d):
    return seg.most_exposed(seg.segment_profile(ruled_segments(features(spark, d)))).select(
        "segment", "customers", "churn_rate", "monthly_revenue_at_risk")


@query
def median_filled(spark, d):
    """Clustering inputs of a frame with gaps: every ninth tenure has no total, every seventh no charge."""
    gap = lambda c, n: F.when(F.col("tenure") % n != 0, F.col(c))
    frame = features(spark, d).withColumns({"TotalCharges": gap("TotalCharges", 9), "MonthlyCharges": gap("MonthlyCharges", 7)})
    return seg.cluster_matrix(frame, [ID]).select(ID, r("TotalCharges", 4), r("MonthlyCharges", 4))


def labelled_points(spark, d) -> DataFrame:
    matrix = seg.cluster_matrix(ruled_segments(features(spark, d)), [ID, "segment"]).persist()
    return cluster.standardised(matrix, [ID, "segment"])


@query
def cluster_quality(spark, d):
    out = metrics.cluster_quality(labelled_points(spark, d), "segment", seg.CLUSTER_INPUTS)
    return out.select("k", "rows", *[r(c, 4) for c in ("inertia", "silhouette", "davies_bouldin", "calinski_harabasz", "smallest_share")])


@query
def adjusted_rand(spark, d):
    frame = ruled_segments(scored(spark, d)).withColumn("band", S.risk_category(F.col("churn_probability")))
    return metrics.adjusted_rand(frame, "segment", "band").select(r("adjusted_rand_index"))


@query
def dim_segment(spark, d):
    frame = ruled_segments(features(spark, d))
    prof = seg.segment_profile(frame)
    diffs = seg.differences_map(seg.segment_differences(seg.cluster_matrix(frame, ["segment"])))
    return publish.segment_dimension(prof, seg.name_segments(prof), diffs).select(
        "segment", "name", "customers", "share", "churn_rate", "distinguishing_features")


@query
def kmeans_sweep(spark, d):
    return cluster.sweep_k(labelled_points(spark, d).drop("segment"), restarts=cluster.RESTARTS)


@query
def kmeans_choice(spark, d):
    return metrics.choose_k(cluster.sweep_k(labelled_points(spark, d).drop("segment"), restarts=cluster.RESTARTS))


def kmeans_labels(spark, d, k=3):
    points = for_iteration(labelled_points(spark, d).drop("segment"), work=cluster.LABELLING)
    fit = cluster.fit_kmeans(points, k, restarts=cluster.RESTARTS)
    return points, fit, fit.assign(points, seg.CLUSTER_INPUTS)


@query
def kmeans_assign(spark, d):
    _, _, labels = kmeans_labels(spark, d)
    prof = seg.name_segments(seg.segment_profile(features(spark, d).join(labels.select(ID, "segment"), ID)))
    return labels.select(ID, "segment").join(F.broadcast(prof.select("segment", F.col("name").alias("segment_name"))), "segment")


@query
def kmeans_stationary(spark, d):
    """The best model of every k as a fixed point: rows nearer to another centre, and how far centres are from their means."""
    points = for_iteration(labelled_points(spark, d).drop("segment"), work=cluster.LABELLING)
    out = None
    for fit in cluster.sweep_models(points, restarts=cluster.RESTARTS):
        row = lloyd.fixed_point(points, fit, seg.CLUSTER_INPUTS)
        out = row if out is None else out.unionByName(row)
    return out


@query
def bisecting_agreement(spark, d):
    points, _, labels = kmeans_labels(spark, d)
    return cluster.second_opinion(points, labels, 3, ID)


@query
def resample_stability(spark, d):
    points, fit, labels = kmeans_labels(spark, d)
    return cluster.stability(cluster.second_opinion(points, labels, 3, ID), cluster.resample_agreement(points, fit, ID))


@query
def pca_projection(spark, d):
    return cluster.project(labelled_points(spark, d), [ID, "segment"])


# --- regression --------------------------------------------------------------

def fit_rows(spark, fit) -> DataFrame:
    return fit.table(spark).select("term", *[r(c) for c in ("coefficient", "std_error", "t_statistic", "p_value")], "significant")


@query
def ols_hc1(spark, d):
    frame = typed(customer_frame(spark, d))
    fit = regression.ols_hc1(frame, F.col(TARGET), {"const": F.lit(1.0), "paperless": is_yes("PaperlessBilling")})
    return fit_rows(spark, fit)


@query
def ols_saturated(spark, d):
    frame = typed(customer_frame(spark, d))
    a, b = is_yes("Partner").cast("double"), is_yes("PaperlessBilling").cast("double")
    return fit_rows(spark, regression.ols_hc1(frame, F.col(TARGET), {"const": F.lit(1.0), "partner": a, "paperless": b, "both": a * b}))


def encouragement(spark, d) -> DataFrame:
    """Paperless billing encourages support uptake and is hashed from the id."""
    return causal.prepare_observational(typed(customer_frame(spark, d))).select(
        F.col("outcome").alias("churned"), F.col("treated").alias("redeemed"), is_yes("PaperlessBilling").alias("offered"))


@query
def tsls_late(spark, d):
    fit = regression.tsls(encouragement(spark, d), F.col("churned"), ("redeemed", F.col("redeemed")),
                          {"offered": F.col("offered")}, {"const": F.lit(1.0)})
    return fit_rows(spark, fit.second)


@query
def iv_readout(spark, d):
    return causal.instrument_readout(encouragement(spark, d)).select(
        "estimator", r("estimate"), r("std_error"), r("f_statistic", 4), "weak_instrument", "n")


@query
def did(spark, d):
    cells = causal.panel_cells(activity_panel(spark, d))
    return cells.select(*[r(c) for c in cells.columns])


@query
def did_regression(spark, d):
    return fit_rows(spark, causal.did_regression(activity_panel(spark, d)))


@query
def pre_period_gaps(spark, d):
    return causal.pre_period_gaps(activity_panel(spark, d)).select("period", r("gap"))


@query
def parallel_trends(spark, d):
    return causal.parallel_trends(activity_panel(spark, d)).select(
        "pre_periods", "testable", *[r(c) for c in ("gap_drift", "interaction", "std_error", "t_statistic", "p_value")], "trends_parallel")


@query
def vif(spark, d):
    values = regression.variance_inflation(clean(spark, d), {"tenure": F.col("tenure"), "TotalCharges": F.col("TotalCharges")})
    return spark.createDataFrame(list(values.items()), "feature string, vif double").select("feature", r("vif"))


@query
def wald_odds(spark, d):
    frame = typed(customer_frame(spark, d))
    out = interpret.wald_table(frame, {"partner": is_yes("Partner").cast("double")}, TARGET)
    return out.select("feature", *[r(c, 4) for c in ("coefficient", "std_error", "odds_ratio")], "significant", r("vif", 4))


@query
def logistic_coefficients(spark, d):
    frame = for_iteration(features(spark, d))
    terms = encode.reference_design(frame, NOMINAL, ORDINAL, NUMERIC + ENGINEERED_NUMERIC)
    return interpret.wald_table(frame, terms, TARGET)


# --- causal estimates --------------------------------------------------------

CELL_COLUMNS = ["InternetService", "tenure_bucket"]


def observational(spark, d) -> DataFrame:
    return causal.prepare_observational(with_engineered(typed(customer_frame(spark, d))))


def saturated(spark, d) -> DataFrame:
    return causal.saturated_propensity(causal.design_cells(observational(spark, d), CELL_COLUMNS), CELL_COLUMNS)


def supported(spark, d) -> DataFrame:
    wide = saturated(spark, d)
    return causal.trim_to_support(wide, causal.overlap(causal.long_arms(wide, ["propensity"])))


@query
def prepare_observational(spark, d):
    return observational(spark, d).select(ID, "num_other_addons", "treated", "outcome")


@query
def naive_difference(spark, d):
    return causal.naive_difference(observational(spark, d)).select(
        "n", r("treated_rate"), r("control_rate"), r("naive_difference"))


@query
def propensity_cells(spark, d):
    return saturated(spark, d).select(*CELL_COLUMNS, *[F.col(c).cast("long").alias(c) for c in ("n_t", "n_c", "y_t", "y_c")], r("propensity"))


@query
def overlap(spark, d):
    return causal.overlap(causal.long_arms(saturated(spark, d), ["propensity"])).select(
        r("low"), r("high"), "n_total", "n_in_support", "n_dropped", r("share_dropped"))


@query
def ipw_ate(spark, d):
    return causal.ipw(causal.long_arms(supported(spark, d), ["propensity"])).select(
        F.col("n").cast("long").alias("n"), r("ipw_ate"), r("effective_sample_size", 3))


@query
def aipw_ate(spark, d):
    return causal.aipw_saturated(supported(spark, d)).select(r("aipw_ate"))


@query
def aipw_coarse(spark, d):
    """Outcome means per internet service, corrected by the residuals of the finer propensity cells."""
    return causal.aipw_strata(supported(spark, d), ["InternetService"]).select(r("aipw_ate"), r("correction"))


SMD_TERMS = {"tenure": F.col, "num_other_addons": F.col}


@query
def smd(spark, d):
    frame = observational(spark, d)
    terms = {"tenure": F.col("tenure"), "num_other_addons": F.col("num_other_addons"),
             "fiber": is_yes("InternetService", "Fiber optic"), "two_year": is_yes("Contract", "Two year")}
    return causal.standardised_differences(frame, terms, F.lit(1.0)).select("covariate", r("smd"))


@query
def smd_weighted(spark, d):
    """Balance of the cells after inverse weighting."""
    arms = causal.long_arms(supported(spark, d), [*CELL_COLUMNS, "propensity"])
    weight = F.col("n") * F.when(F.col("treated") == 1, 1 / S.clamp(F.col("propensity"), *causal.WEIGHT_CLIP)).otherwise(
        1 / (1 - S.clamp(F.col("propensity"), *causal.WEIGHT_CLIP)))
    terms = {"fiber": is_yes("InternetService", "Fiber optic"), "first_year": F.col("tenure_bucket").isin("0-6m", "6-12m").cast("int")}
    return causal.standardised_differences(arms, terms, weight).select("covariate", r("smd"))


@query
def e_value(spark, d):
    rates = causal.naive_difference(observational(spark, d))
    rr = F.col("treated_rate") / F.col("control_rate")
    return rates.select(r(rr).alias("risk_ratio"), r(causal.e_value(rr)).alias("e_value"))


def matched(spark, d):
    """Units inside the common support, scored by a propensity fitted on them, with pairs."""
    units = observational(spark, d).persist()
    numeric, categorical = causal.confounder_columns()
    cells = causal.design_cells(units, numeric + categorical).persist()
    terms = causal.confounder_terms(cells, numeric, categorical)
    first = causal.fit_logistic(cells, terms, F.col("treated"), F.col("n")).probability
    ends = causal.overlap(cells.withColumn("propensity", first)).first()
    inside = first.between(ends["low"], ends["high"])
    model = causal.fit_logistic(cells.filter(inside), terms, F.col("treated"), F.col("n"))
    # stored: otherwise the planner derives constraints from both models in every join of units with pairs
    scored_units = units.filter(inside).withColumn("score", S.logit(model.probability, causal.LOGIT_CLIP)).persist()
    return scored_units, terms, matching.match_pairs(scored_units, ID, "score", "treated", carry=["outcome"], seed=SEED).persist()


@query
def match_pairs(spark, d):
    return matched(spark, d)[2].select("treated_id", "control_id", r("distance"))


@query
def match_att(spark, d):
    return matching.att(matched(spark, d)[2])


@query
def match_balance(spark, d):
    units, terms, pairs = matched(spark, d)
    ids = pairs.select(F.explode(F.array("treated_id", "control_id")).alias(ID))
    return publish.balance_fact(causal.standardised_differences(units, terms, F.lit(1.0)),
                                causal.standardised_differences(units.join(ids, ID), terms, F.lit(1.0)))


@query
def att_lookup(spark, d):
    """Pairs built on exact tenure order, outcomes looked up by id."""
    units = observational(spark, d).withColumn("score", F.col("tenure").cast("double"))
    pairs = matching.match_pairs(units, ID, "score", "treated", caliper=0.0, seed=SEED)
    return matching.att(matching.outcome_from_pairs(pairs, units, ID, "outcome")).select(
        "n_pairs", r("att"), r("treated_rate"), r("control_rate"))


@query
def match_caliper(spark, d):
    """Pairs within a caliper on a line that SQL can walk too: months and charges in quarters."""
    units = observational(spark, d).withColumn("score", F.col("tenure") + F.floor(F.col("MonthlyCharges") * 4) / 64)
    flows = matching.match_flows(units, "score", "treated", 0.125)
    return flows.groupBy("t_score", "c_score").agg(F.sum("n").alias("pairs"))


def full_design(spark, d):
    """Cells over all confounders inside the common support, and their terms."""
    numeric, categorical = causal.confounder_columns()
    every = causal.design_cells(observational(spark, d), numeric + categorical).persist()
    model = causal.fit_logistic(every, causal.confounder_terms(every, numeric, categorical), F.col("treated"), F.col("n"))
    with_p = every.withColumn("propensity", model.probability)
    cells = causal.trim_to_support(with_p, causal.overlap(with_p)).drop("propensity").persist()
    return cells, causal.confounder_terms(cells, numeric, categorical), [*numeric, *categorical, "treated", "outcome"]


@query
def bootstrap_intervals(spark, d):
    cells, terms, key = full_design(spark, d)
    return causal.model_bootstrap(cells, terms, key, seed=SEED)


@query
def bootstrap_score_equations(spark, d):
    """What is left of the score equations of the propensity model in each of 200 draws."""
    cells, terms, key = full_design(spark, d)
    weighted = causal.replicate_weights(cells, terms, key, causal.BOOTSTRAP_DRAWS, SEED)
    fitted = causal.fit_replicates(weighted, list(terms), causal.BOOTSTRAP_DRAWS, outcomes=False)
    return causal.score_equations(fitted).groupBy("replicate").agg(
        F.abs(F.round(F.max(F.abs("residual")), 8)).alias("largest_residual"))


def runs(spark, d, kind):
    numeric, categorical = causal.confounder_columns()
    units = observational(spark, d).select(ID, *numeric, *categorical, "treated", "outcome")
    make = causal.placebo_treatments if kind == "placebo" else causal.subset_samples
    return causal.run_effects(make(units, ID, causal.PLACEBO_RUNS, SEED), numeric, categorical)


@query
def placebo_assignment(spark, d):
    """The permuted treatments of all twelve placebo runs, a digit per run."""
    out = causal.placebo_treatments(observational(spark, d), ID, causal.PLACEBO_RUNS, SEED)
    return out.select(ID, F.array_join(F.transform("arms", lambda a: a.cast("string")), "").alias("arms"))


@query
def subset_assignment(spark, d):
    """The members of all twelve random subsets, a digit per run."""
    out = causal.subset_samples(observational(spark, d), ID, causal.PLACEBO_RUNS, SEED)
    return out.select(ID, F.array_join(F.transform("w", lambda a: a.cast("string")), "").alias("members"))


@query
def refute_placebo(spark, d):
    return runs(spark, d, "placebo")


@query
def refute_subset(spark, d):
    return runs(spark, d, "subset")


@query
def refutation_verdict(spark, d):
    cells, terms, _ = full_design(spark, d)
    effect = causal.fit_replicates(causal.single(cells, terms), list(terms), 1, outcomes=False).matched()
    return causal.refutation(effect.first()["matching_att"], runs(spark, d, "placebo"), runs(spark, d, "subset"))


@query
def observational_run(spark, d):
    from keepwell.plans.observational import run_observational
    return run_observational(observational(spark, d), ID, draws=causal.BOOTSTRAP_DRAWS, seed=SEED)["estimates"]


@query
def mediator_sensitivity(spark, d):
    from keepwell.plans.observational import run_observational
    return run_observational(observational(spark, d), ID, mediators=True, draws=causal.MEDIATOR_DRAWS, seed=SEED)["estimates"]


# --- models ------------------------------------------------------------------

def splits(spark, d):
    frame = for_iteration(encode.stratified_split(features(spark, d), ID, SEED))
    return [frame.filter(F.col("split") == s).drop("split") for s in ("train", "validation", "test")]


@query
def train_compare(spark, d):
    train, validation, test = splits(spark, d)
    matrix = models.tree_matrix(train, validation)
    best = models.search_trees(train, validation, models.search_space(seed=SEED), matrix)[1]
    trees = [("boosted_trees", models.FIRST_TREES), ("boosted_trees_deep", models.SECOND_TREES), ("boosted_trees_tuned", best)]
    candidates = [models.fit_linear(train), *(models.fit_trees(train, validation, name, matrix=matrix, **p) for name, p in trees)]
    return models.winner(models.candidate_metrics(candidates, test))


@query
def param_search(spark, d):
    train, validation, _ = splits(spark, d)
    return models.search_trees(train, validation, models.search_space(seed=SEED))[0]


@query
def batch_score(spark, d):
    train, _, test = splits(spark, d)
    scorer = models.fit_linear(train)
    path = scratch_folder(spark, "scorer")
    scorer.save(path)
    return models.Scorer.load(spark, path).score(test).select(ID, "churn_probability", "prediction")


@query
def deployed_explanations(spark, d):
    """A stored linear model, loaded and explained: its contributions add up to its own margin."""
    train, _, test = splits(spark, d)
    path = scratch_folder(spark, "scorer")
    models.fit_linear(train).save(path)
    scorer = models.Scorer.load(spark, path)
    out = explain.additivity(explain.explain(scorer, test), explain.margins(scorer, test))
    return out.select(ID, F.abs(F.round("gap", 6)).alias("gap"))


@query
def tree_contributions(spark, d):
    train, validation, test = splits(spark, d)
    scorer = models.fit_trees(train, validation, "boosted_trees", **models.FIRST_TREES)
    path = scratch_folder(spark, "trees")
    scorer.pipeline.stages[-1].write().overwrite().save(path)
    nodes = contrib.tree_nodes(spark, path)
    columns = scorer.shape.code_columns
    names = [c.removesuffix("_code") for c in columns]
    rows = scorer.shape.prepare(test)
    return contrib.long_contributions(contrib.tree_contributions(
        rows, nodes, scorer.pipeline.stages[-1].treeWeights, names, columns))


@query
def model_gate(spark, d):
    """Gate over the exact AUC of two fixed scores."""
    rows = scored(spark, d).withColumn("rival", _score(RIVAL_WEIGHTS, RIVAL_INTERCEPT))
    auc = lambda name, c: metrics.roc_auc(rows, TARGET, c).select(F.lit(name).alias("model"), "roc_auc")
    comparison = models.winner(auc("linear_score", "churn_probability").unionByName(auc("rival_score", "rival")))
    return publish.model_gate(comparison).select("model", r("roc_auc"), "threshold", "passed", "reason")


@query
def run_ledger(spark, d):
    """Metrics of two scores written as ledger rows and read back as a fact."""
    rows = scored(spark, d).withColumn("rival", _score(RIVAL_WEIGHTS, RIVAL_INTERCEPT))
    path = scratch_folder(spark, "ledger")
    for name, c in (("linear_score", "churn_probability"), ("rival_score", "rival")):
        m = metrics.classification(rows.withColumn("_p", S.hard_prediction(F.col(c))), TARGET, "_p").join(
            metrics.roc_auc(rows, TARGET, c).select("roc_auc")).first()
        store.append_ledger(store.ledger_rows(spark, "20260101-000000", f"metrics/{name}", {
            k: m[k] for k in ("roc_auc", "precision", "recall", "f1_score")}), path)
    return store.metric_table(spark.read.parquet(path)).select(
        "run_ts", "model", *[r(c) for c in ("roc_auc", "precision", "recall", "f1_score")])


@query
def newest_run(spark, d):
    """Order days as runs; only the newest is kept."""
    orders = table(spark, d, "orders").withColumn("run_ts", F.date_format("o_orderdate", "yyyyMMdd"))
    return store.newest_run(orders).select("run_ts", "o_orderkey", "o_custkey")


# --- published facts ---------------------------------------------------------

@query
def fact_experiment(spark, d):
    def block(frame, run):
        arms = ex.arms_wide(frame, ["retained", "revenue_net"])
        return publish.experiment_fact(ex.two_proportion_z(arms.filter("metric = 'retained'")),
                                       ex.welch_t(arms.filter("metric = 'revenue_net'")), run)
    observed = outcomes(spark, d)
    out = block(observed, "A/B test").unionByName(block(ex.same_arm_halves(observed, SEED + 1), "A/A control"))
    return out.select("run", "metric", *[r(c, 4) for c in ("treatment", "control", "difference", "p_value", "effect_size")],
                      "significant", "effect_size_name")


@query
def fact_causal(spark, d):
    naive = causal.naive_difference(observational(spark, d))
    wide = supported(spark, d)
    null = F.lit(None).cast("double")
    adjusted = causal.ipw(causal.long_arms(wide, ["propensity"])).select(
        F.lit("ipw_ate").alias("estimator"), F.col("ipw_ate").alias("estimate"), null.alias("ci_low"), null.alias("ci_high"),
        F.lit("stabilised weights").alias("note")).unionByName(causal.aipw_saturated(wide).select(
            F.lit("aipw_ate").alias("estimator"), F.col("aipw_ate").alias("estimate"), null.alias("ci_low"),
            null.alias("ci_high"), F.lit("doubly robust").alias("note")))
    panel = activity_panel(spark, d)
    out = publish.causal_fact(naive, adjusted, causal.instrument_readout(encouragement(spark, d)),
                              causal.panel_cells(panel), causal.did_regression(panel).table(spark))
    return out.select("analysis", "estimator", r("estimate"), "adjusted", "note")


@query
def report_flatten(spark, d):
    """Segment reports written as nested JSON text and flattened again."""
    rows = seg.segment_profile(ruled_segments(features(spark, d)))
    document = rows.agg(F.to_json(F.struct(F.collect_list(F.struct(*rows.columns)).alias("segments"))).alias("doc"))
    schema = f"struct<segments:array<{rows.schema.simpleString()}>>"
    parsed = document.select(F.from_json("doc", schema).alias("d"))
    return parsed.select(F.inline("d.segments")).select("segment", "customers", "share", "churn_rate", "monthly_revenue")


#: Sections of the six reports: the registered query whose rows they hold, and its key.
REPORTS = {
    "drift": ("numeric", "drift_numeric", ["feature"]),
    "experiment": ("readout", "fact_experiment", ["run", "metric"]),
    "power": ("designs", "verdicts", ["Contract"]),
    "segmentation": ("segments", "segment_profile", ["segment"]),
    "causal": ("estimates", "fact_causal", ["analysis", "estimator"]),
    "coefficients": ("terms", "wald_odds", ["feature"]),
}


@query
def reports_flat(spark, d):
    """All six reports assembled, written as JSON, read back and flattened by their schemas."""
    root, out = scratch_folder(spark, "reports"), None
    for kind, (name, source, key) in REPORTS.items():
        one = reports.report(kind, {name: reports.section(QUERIES[source](spark, d), key)})
        schema = reports.write_report(one, root, "20260101-000000")
        flat = reports.flatten(reports.read_report(spark, root, kind, "20260101-000000", schema))
        out = flat if out is None else out.unionByName(flat)
    return out.filter("number is not null").select("report", "path", "number")


@query
def registered_designs(spark, d):
    """Designs stored by month, read back as of the first outcome of their experiment.

    An experiment is an order priority; its outcomes are the orders from 1997 on.
    """
    orders = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("experiment"), F.to_timestamp("o_orderdate").alias("at"), (F.col("o_orderstatus") == "F").cast("int").alias("done"))
    monthly = orders.groupBy("experiment", (F.trunc("at", "MM") + F.expr("interval 1 month")).cast("timestamp").alias("registered_at")).agg(
        F.count("*").alias("available_n"), F.sum("done").alias("finished"))
    path = scratch_folder(spark, "designs")
    early = F.col("registered_at") < F.lit("1995-01-01").cast("timestamp")
    power.store_designs(monthly.filter(early), path)
    power.store_designs(monthly.filter(~early), path)
    first = orders.filter(F.col("at") >= F.lit("1997-01-01").cast("timestamp")).groupBy("experiment").agg(F.min("at").alias("first_outcome"))
    out = power.designs_as_of(spark.read.parquet(path), first)
    return out.select("experiment", F.date_format("first_outcome", "yyyy-MM-dd").alias("first_outcome"),
                      F.date_format("registered_at", "yyyy-MM-dd").alias("registered_at"), "available_n", "finished", "refused")


@query
def table_chain(spark, d):
    """Raw CSV to the chain of catalog tables; the segment table is read back."""
    folder, prefix = scratch_folder(spark, "raw"), f"chain_{uuid.uuid4().hex}_"
    store.write_csv(customer_frame(spark, d), folder)
    pipeline.feature_stage(store.read_raw_csv(spark, folder), prefix)
    copy = scratch_folder(spark, "segments")
    store.write_parquet(spark.table(f"{prefix}churn_by_segment"), copy)
    for name in ("clean_customers", "customer_features", "churn_by_segment"):
        spark.sql(f"drop table {prefix}{name}")
    return spark.read.parquet(copy)


@query
def table_loads(spark, d):
    """Replace and append loads of a catalog table with the rows each reports, and what the table holds then."""
    name = f"load_{uuid.uuid4().hex}"
    rows = scored(spark, d).select(ID, "churn_probability")
    steps = [("replace", store.load_table(rows, name)), ("append", store.load_table(rows.filter("churn_probability >= 0.5"), name, "append")),
             ("replace again", store.load_table(rows.filter("churn_probability >= 0.5"), name)), ("held", spark.table(name).count())]
    spark.sql(f"drop table {name}")
    return spark.createDataFrame(steps, "step string, rows long")


@query
def published_predictions(spark, d):
    """Two stored runs of predictions; the newest is published as a catalog table and read back."""
    root, name = scratch_folder(spark, "runs"), f"published_{uuid.uuid4().hex}"
    rows = scored(spark, d).select(ID, "churn_probability", "prediction")
    store.write_run(rows.withColumn("churn_probability", F.lit(0.0)), f"{root}/predictions", "20260101-000000")
    store.write_run(rows, f"{root}/predictions", "20260102-000000")
    pipeline.upload_predictions(spark, root, name)
    copy = scratch_folder(spark, "published")
    store.write_parquet(spark.table(name), copy)
    spark.sql(f"drop table {name}")
    return spark.read.parquet(copy)


@query
def data_dictionary(spark, d):
    frame = customers_published(spark, d)
    return publish.data_dictionary({"dim_customer": frame, "dim_segment": seg.segment_profile(ruled_segments(features(spark, d)))})


# --- stream ------------------------------------------------------------------

@query
def stream_score(spark, d):
    """Score the customer records through the streaming path."""
    folder = scratch_folder(spark, "stream")
    frame = typed(customer_frame(spark, d)).drop(TARGET)
    frame.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{folder}/in")
    records = online.parse(spark.readStream.schema("value string").text(f"{folder}/in"))
    online.run_stream(records, with_score, "v1", "linear_score", f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out")


@query
def stream_quarantine(spark, d):
    """Records that the contract rejects, with their problems, from the second sink of the stream."""
    folder = scratch_folder(spark, "stream")
    frame = typed(customer_frame(spark, d)).drop(TARGET)
    broken = F.when(F.col("tenure") % 11 == 3, F.lit(-1)).otherwise(F.col("tenure"))
    senior = F.when(F.col("tenure") % 13 == 5, F.lit(2)).otherwise(F.col("SeniorCitizen"))
    frame = frame.withColumns({"tenure": broken, "SeniorCitizen": senior})
    frame.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{folder}/in")
    records = online.parse(spark.readStream.schema("value string").text(f"{folder}/in"))
    online.run_stream(records, with_score, "v1", "linear_score", f"{folder}/out", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out-rejected").select(ID, F.array_join("problems", "; ").alias("problems"))
