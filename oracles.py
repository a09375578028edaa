"""ANSI SQL for the registered queries, written independently of the library.

One text per query; the shared parts are common table expressions. Tail
probabilities come from series and numeric integration inside SQL.
"""

from __future__ import annotations

from keepwell.plans.catalog import INTERCEPT, RIVAL_INTERCEPT, RIVAL_WEIGHTS, SEED, WEIGHTS
from keepwell.schema import (
    CONTRACT_LEVELS, ENGINEERED, NOMINAL, NUMERIC, ORDINAL, RAW_COLUMNS,
)

_RAW = """
per AS (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey),
h AS (SELECT c.*, p.n, p.last_order,
        ((c_custkey + 1) * 48271) % 2147483647 AS h1, ((c_custkey + 1) * 69621 + 7) % 2147483647 AS h2
      FROM customer c JOIN per p ON p.o_custkey = c.c_custkey),
u AS (SELECT *, (h1 // 7) % 100 AS u1, (h2 // 11) % 100 AS u2, (h1 // 701) % 100 AS u3, (h2 // 1103) % 100 AS u4,
        c_nationkey % 3 = 2 AS noint, date_diff('day', CAST(last_order AS DATE), DATE '2001-08-01') AS rec,
        1800 + (CAST(round(c_acctbal * 100) AS BIGINT) + 100000) // 110 AS mc FROM h),
v AS (SELECT *, (mc * 3 * (n - 1) * (90 + u2 % 21)) // 100 AS tc FROM u),
raw AS (SELECT
    'C-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS customerID,
    CASE WHEN u1 % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CAST(CASE WHEN u2 < 16 THEN 1 ELSE 0 END AS INTEGER) AS SeniorCitizen,
    CASE WHEN u3 < 48 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN u4 < 30 THEN 'Yes' ELSE 'No' END AS Dependents,
    CAST(3 * (n - 1) AS INTEGER) AS tenure,
    CASE WHEN u1 < 90 THEN 'Yes' ELSE 'No' END AS PhoneService,
    CASE WHEN u1 >= 90 THEN 'No phone service' WHEN u2 < 45 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    CASE c_nationkey % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS InternetService,
    CASE WHEN noint THEN 'No internet service' WHEN u1 + 2 * n > 75 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
    CASE WHEN noint THEN 'No internet service' WHEN u2 + 2 * n > 70 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
    CASE WHEN noint THEN 'No internet service' WHEN u3 + 2 * n > 70 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
    CASE WHEN noint THEN 'No internet service' WHEN u4 + 3 * n > 85 THEN 'Yes' ELSE 'No' END AS TechSupport,
    CASE WHEN noint THEN 'No internet service' WHEN (u1 + u2) % 100 < 50 THEN 'Yes' ELSE 'No' END AS StreamingTV,
    CASE WHEN noint THEN 'No internet service' WHEN (u1 + u3) % 100 < 50 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
    CASE WHEN u3 + 3 * n < 85 THEN 'Month-to-month' WHEN u3 + 3 * n < 110 THEN 'One year' ELSE 'Two year' END AS Contract,
    CASE WHEN u4 >= 40 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Mailed check' WHEN 'MACHINERY' THEN 'Bank transfer (automatic)'
         WHEN 'HOUSEHOLD' THEN 'Credit card (automatic)' ELSE 'Electronic check' END AS PaymentMethod,
    CAST(mc AS DOUBLE) / 100 AS MonthlyCharges,
    CASE WHEN n = 1 THEN ' ' ELSE CAST(tc // 100 AS VARCHAR) || '.' || lpad(CAST(tc % 100 AS VARCHAR), 2, '0') END AS TotalCharges,
    CASE WHEN rec > 300 THEN 'Yes' ELSE 'No' END AS Churn
  FROM v),
typed AS (SELECT * REPLACE (
    TRY_CAST(NULLIF(trim(TotalCharges), '') AS DOUBLE) AS TotalCharges,
    CAST(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS INTEGER) AS Churn) FROM raw),
med AS (SELECT median(TotalCharges) AS m FROM typed),
clean AS (SELECT t.* REPLACE (coalesce(t.TotalCharges, med.m) AS TotalCharges) FROM typed t CROSS JOIN med)
"""

_ENGINEERED = """
    CAST((OnlineSecurity = 'Yes')::INT + (OnlineBackup = 'Yes')::INT + (DeviceProtection = 'Yes')::INT
       + (TechSupport = 'Yes')::INT + (StreamingTV = 'Yes')::INT + (StreamingMovies = 'Yes')::INT AS INTEGER) AS num_addon_services,
    coalesce(TotalCharges / nullif(CAST(tenure AS DOUBLE), 0), MonthlyCharges) AS avg_monthly_spend,
    MonthlyCharges / nullif(coalesce(TotalCharges / nullif(CAST(tenure AS DOUBLE), 0), MonthlyCharges), 0) AS charges_ratio,
    CASE WHEN tenure <= 6 THEN '0-6m' WHEN tenure <= 12 THEN '6-12m' WHEN tenure <= 24 THEN '1-2y'
         WHEN tenure <= 48 THEN '2-4y' ELSE '4y+' END AS tenure_bucket,
    CASE WHEN MonthlyCharges < 35 THEN 'low' WHEN MonthlyCharges < 65 THEN 'medium'
         WHEN MonthlyCharges < 90 THEN 'high' ELSE 'premium' END AS spend_bucket
"""
_FEAT = _RAW + f", feat AS (SELECT *, {_ENGINEERED} FROM clean)"

_VALUE = {
    "tenure": "tenure", "MonthlyCharges": "MonthlyCharges",
    "is_month_to_month": "(Contract = 'Month-to-month')::INT", "is_two_year": "(Contract = 'Two year')::INT",
    "has_fiber": "(InternetService = 'Fiber optic')::INT", "pays_by_echeck": "(PaymentMethod = 'Electronic check')::INT",
    "has_support": "(TechSupport = 'Yes')::INT", "num_addon_services": "num_addon_services", "SeniorCitizen": "SeniorCitizen",
}


def _logit(intercept, weights):
    return f"{intercept!r}::DOUBLE" + "".join(f" + {w!r}::DOUBLE * {_VALUE[k]}" for k, w in weights.items())


def _p(intercept, weights):
    return f"round(1 / (1 + exp(-({_logit(intercept, weights)}))), 6)"


_SCORED = _FEAT + f""",
scored0 AS (SELECT *, {_p(INTERCEPT, WEIGHTS)} AS p, {_p(RIVAL_INTERCEPT, RIVAL_WEIGHTS)} AS rival FROM feat),
scored AS (SELECT *, p AS churn_probability, CAST(p >= 0.5 AS INTEGER) AS prediction FROM scored0)
"""
_SEGMENT = """CAST(CASE WHEN Contract = 'Month-to-month' AND InternetService = 'Fiber optic' THEN 0
    WHEN Contract = 'Month-to-month' THEN 1 WHEN tenure <= 30 THEN 2 ELSE 3 END AS INTEGER)"""
_SEG = _FEAT + f", segd AS (SELECT *, {_SEGMENT} AS segment FROM feat)"


def _edges(source, bins=10):
    """Distinct bin edges of ``source.p`` from exact order statistics."""
    return f"""
os AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS rn, count(*) OVER () AS n FROM {source}),
pos AS (SELECT DISTINCT i, (i * (n - 1)) // {bins} AS lo, ((i * (n - 1)) % {bins}) / {bins}.0::DOUBLE AS frac, n
        FROM os, (SELECT unnest(range(0, {bins} + 1)) AS i)),
ed AS (SELECT DISTINCT a.p + (b.p - a.p) * pos.frac AS e FROM pos
       JOIN os a ON a.rn = pos.lo JOIN os b ON b.rn = least(pos.lo + CASE WHEN pos.frac > 0 THEN 1 ELSE 0 END, pos.n - 1)),
inner_ed AS (SELECT e FROM ed WHERE e > (SELECT min(e) FROM ed) AND e < (SELECT max(e) FROM ed)),
binned AS (SELECT s.*, CAST((SELECT count(*) FROM inner_ed WHERE s.p > e) AS INTEGER) AS bin FROM {source} s)
"""


_PUBLISHED = _SCORED + "," + _edges("scored")


def _seeded(key, seed):
    return f"md5({key} || ':{seed}')"


_ASSIGNED = _SCORED + ", targeted AS (SELECT * FROM scored WHERE p >= 0.5)," + _edges("targeted") + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY {_seeded('customerID', SEED)}, customerID) AS rk,
           count(*) OVER (PARTITION BY bin) AS sz FROM binned),
assigned AS (SELECT *, CASE WHEN rk <= sz // 2 THEN 'treatment' ELSE 'control' END AS grp FROM ranked),
outcomes AS (SELECT *, Churn AS churned, 1 - Churn AS retained,
             (1 - Churn) * MonthlyCharges * 12 - CASE WHEN grp = 'treatment' THEN 50.0 ELSE 0.0 END AS revenue_net FROM assigned)
"""
_AA = _ASSIGNED + f""",
ctl AS (SELECT *, row_number() OVER (ORDER BY {_seeded('customerID', SEED + 1)}, customerID) AS rk2, count(*) OVER () AS sz2
        FROM outcomes WHERE grp = 'control'),
aa AS (SELECT * REPLACE (CASE WHEN rk2 <= sz2 // 2 THEN 'treatment' ELSE 'control' END AS grp) FROM ctl)
"""


def _norm_p(z):
    """Two-sided normal tail by the series of the central area."""
    a = f"greatest(abs({z}), 1e-12)"
    return (f"(SELECT greatest(0, 1 - 2 * exp(-{a} * {a} / 2) / sqrt(2 * pi()) * sum(exp((2 * k + 1) * ln({a}) "
            f"- ((k + 1) * ln(2) + lgamma(k + 1.5) - 0.5 * ln(pi()))))) FROM (SELECT unnest(range(0, 300)) AS k))")


def _t_p(t, dof):
    """Two-sided Student tail by Simpson's rule on [0, |t|]."""
    steps = 2000
    x = f"(abs({t}) * i / {steps})"
    w = f"(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    return (f"(SELECT greatest(0, 1 - 2 * abs({t}) / {steps} / 3 * sum({w} * exp(lgamma(({dof} + 1) / 2.0) - lgamma({dof} / 2.0) "
            f"- 0.5 * ln({dof} * pi()) - ({dof} + 1) / 2.0 * ln(1 + {x} * {x} / {dof})))) "
            f"FROM (SELECT unnest(range(0, {steps} + 1)) AS i))")


_ZA, _ZB = "1.959963984540054::DOUBLE", "0.8416212335729143::DOUBLE"

# Arm statistics and the z readout from a table (key columns, st, nt, sc, nc).
_Z = f"""
zz AS (SELECT *, st::DOUBLE / nullif(nt, 0) AS pt, sc::DOUBLE / nullif(nc, 0) AS pc, (st + sc)::DOUBLE / (nt + nc) AS pp FROM arms),
z2 AS (SELECT *, pt - pc AS diff, sqrt(pp * (1 - pp) * (1.0::DOUBLE / nullif(nt, 0) + 1.0::DOUBLE / nullif(nc, 0))) AS sep,
       sqrt(pt * (1 - pt) / nt + pc * (1 - pc) / nc) AS seu FROM zz),
z3 AS (SELECT *, CASE WHEN sep = 0 THEN 0 ELSE diff / sep END AS z FROM z2),
z4 AS (SELECT *, CASE WHEN z IS NOT NULL THEN {_norm_p('z')} END AS pv FROM z3)
"""
_ARM_RET = """arms AS (SELECT {by} sum(CASE WHEN grp = 'treatment' THEN retained ELSE 0 END) AS st,
  count(*) FILTER (grp = 'treatment') AS nt, sum(CASE WHEN grp = 'control' THEN retained ELSE 0 END) AS sc,
  count(*) FILTER (grp = 'control') AS nc FROM {src} {group})"""


def _welch(source, column):
    return f"""
w1 AS (SELECT count(*) FILTER (grp = 'treatment') AS n_t, count(*) FILTER (grp = 'control') AS n_c,
  avg({column}) FILTER (grp = 'treatment') AS mt, avg({column}) FILTER (grp = 'control') AS mc,
  var_samp({column}) FILTER (grp = 'treatment') AS vt, var_samp({column}) FILTER (grp = 'control') AS vc FROM {source}),
w2 AS (SELECT *, mt - mc AS diff, vt / n_t AS a, vc / n_c AS b,
  sqrt(((n_t - 1) * vt + (n_c - 1) * vc) / (n_t + n_c - 2)) AS psd FROM w1),
w3 AS (SELECT *, diff / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (n_t - 1) + b * b / (n_c - 1)) AS dof FROM w2),
w4 AS (SELECT *, {_t_p('t', 'dof')} AS pv FROM w3)
"""


def _long(source, columns, extra=""):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category{extra} FROM {source} WHERE {c} IS NOT NULL" for c in columns)


_CATEGORICAL = [*NOMINAL, "tenure_bucket", "spend_bucket", *ORDINAL]
_NUMBERS = [*NUMERIC, "num_addon_services", "avg_monthly_spend", "charges_ratio"]
_HALVES = _FEAT + """,
train AS (SELECT * FROM feat WHERE PaymentMethod IN ('Electronic check', 'Mailed check')),
batch AS (SELECT * FROM feat WHERE PaymentMethod NOT IN ('Electronic check', 'Mailed check'))
"""


def _numeric(source, columns=_NUMBERS):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM {source}" for c in columns)


def _shares(source, columns=_CATEGORICAL):
    return (f"SELECT feature, category, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY feature) AS share "
            f"FROM ({_long(source, columns)}) GROUP BY feature, category")


_NDRIFT = """
nd AS (SELECT t.feature, t.mean AS train_mean, b.mean AS scoring_mean, t.std AS train_std, b.std AS scoring_std,
   abs(b.mean - t.mean) / greatest(abs(t.mean), 1e-8) * 100 AS md, abs(b.std - t.std) / greatest(abs(t.std), 1e-8) * 100 AS sd
   FROM nt t JOIN nb b USING (feature)),
nf AS (SELECT *, md > 10 OR sd > 10 AS drifted FROM nd)"""
_CDRIFT = """
al AS (SELECT coalesce(t.feature, b.feature) AS feature, coalesce(t.category, b.category) AS category,
   coalesce(t.share, 0) AS train_share, coalesce(b.share, 0) AS scoring_share
   FROM ct t FULL OUTER JOIN cb b ON t.feature = b.feature AND t.category = b.category),
cd AS (SELECT feature, 0.5 * sum(abs(train_share - scoring_share)) AS tvd,
   coalesce(string_agg(category, '|' ORDER BY category) FILTER (train_share = 0), '') AS new_categories,
   coalesce(string_agg(category, '|' ORDER BY category) FILTER (scoring_share = 0), '') AS missing_categories
   FROM al GROUP BY feature),
cf AS (SELECT *, tvd > 0.1 AS drifted FROM cd)"""


def _drift(skip=()):
    numbers = [c for c in _NUMBERS if c not in skip]
    return (_HALVES + f", nt AS ({_numeric('train', numbers)}), nb AS ({_numeric('batch', numbers)}), "
            f"ct AS ({_shares('train')}), cb AS ({_shares('batch')}), " + _NDRIFT + ", " + _CDRIFT)


def _contrib():
    rows = " UNION ALL ".join(
        f"SELECT customerID, {i} AS position, '{k if '__' not in k else k.split('__', 1)[1]}' AS feature, "
        f"{w!r}::DOUBLE * (({_VALUE[k]})::DOUBLE - (SELECT avg({_VALUE[k]}) FROM scored)) AS shap_value, "
        f"({_VALUE[k]})::DOUBLE AS feature_value FROM scored" for i, (k, w) in enumerate(WEIGHTS.items()))
    return _SCORED + f""", cr AS ({rows}),
lc AS (SELECT *, abs(shap_value) AS abs_shap, CASE WHEN shap_value >= 0 THEN 'increases churn' ELSE 'decreases churn' END AS direction,
   CAST(row_number() OVER (PARTITION BY customerID ORDER BY abs(shap_value) DESC, position) AS INTEGER) AS rk FROM cr)"""


def _profile_cols():
    money = lambda c: f"CAST(round(CAST(sum(CAST({c} AS DECIMAL(18,2)))::DOUBLE / count(*) AS DECIMAL(28,8)), 2) AS DOUBLE)"
    flag = lambda c, v: f"round(avg(({c} = '{v}')::INT), 4)"
    return f""" prof0 AS (SELECT segment, count(*) AS customers, avg(Churn) AS rate, round(avg(tenure), 1) AS avg_tenure,
   {money('MonthlyCharges')} AS avg_monthly_charges, {money('TotalCharges')} AS avg_total_charges,
   round(avg(num_addon_services), 2) AS avg_addons, {flag('Contract', 'Month-to-month')} AS pct_month_to_month,
   {flag('InternetService', 'Fiber optic')} AS pct_fiber, sum(CAST(MonthlyCharges AS DECIMAL(18,2)))::DOUBLE AS rev
   FROM segd GROUP BY segment),
prof AS (SELECT segment, customers, round(customers::DOUBLE / sum(customers) OVER (), 4) AS share, round(rate, 4) AS churn_rate,
   avg_tenure, avg_monthly_charges, avg_total_charges, avg_addons, pct_month_to_month, pct_fiber, round(rev, 2) AS monthly_revenue,
   round(rev / sum(rev) OVER (), 4) AS monthly_revenue_share, round(rev * rate, 2) AS monthly_revenue_at_risk FROM prof0)"""


_PROFILE = _SEG + "," + _profile_cols()
_NAMES = _PROFILE + """,
jd AS (SELECT *, sum(churn_rate * customers) OVER () / sum(customers) OVER () AS base, median(avg_tenure) OVER () AS mt,
   median(avg_monthly_charges) OVER () AS ms FROM prof),
nm0 AS (SELECT *, CASE
   WHEN churn_rate > base * 1.25 AND avg_monthly_charges > ms THEN 'High-Value At Risk'
   WHEN churn_rate > base * 1.25 AND NOT avg_tenure > mt THEN 'New and Unsettled'
   WHEN churn_rate > base * 1.25 THEN 'Drifting Regulars'
   WHEN churn_rate < base * 0.6 AND pct_month_to_month < 0.5 AND avg_monthly_charges > ms THEN 'Premium Loyalists'
   WHEN churn_rate < base * 0.6 AND pct_month_to_month < 0.5 THEN 'Locked-In Core'
   WHEN NOT avg_monthly_charges > ms AND NOT avg_tenure > mt THEN 'Budget Newcomers'
   WHEN avg_monthly_charges > ms THEN 'Established Spenders' ELSE 'Steady Mainstream' END AS label FROM jd),
nm AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY segment) > 1
   THEN label || ' (' || segment || ')' ELSE label END AS name FROM nm0)"""

_INPUTS = {
    "tenure": "tenure", "MonthlyCharges": "MonthlyCharges", "TotalCharges": "TotalCharges",
    "avg_monthly_spend": "avg_monthly_spend", "charges_ratio": "charges_ratio", "num_addon_services": "num_addon_services",
    "is_month_to_month": "(Contract = 'Month-to-month')::INT", "is_two_year": "(Contract = 'Two year')::INT",
    "has_fiber": "(InternetService = 'Fiber optic')::INT", "no_internet": "(InternetService = 'No')::INT",
    "is_paperless": "(PaperlessBilling = 'Yes')::INT", "pays_by_echeck": "(PaymentMethod = 'Electronic check')::INT",
    "has_partner": "(Partner = 'Yes')::INT", "has_dependents": "(Dependents = 'Yes')::INT", "senior": "SeniorCitizen",
}
_MATRIX = _SEG + ", mx AS (SELECT customerID, segment, " + ", ".join(
    f"({e})::DOUBLE AS {n}" for n, e in _INPUTS.items()) + " FROM segd)"
_DISTANCE = _MATRIX + ", ml AS (" + " UNION ALL ".join(
    f"SELECT segment, '{n}' AS feature, (avg({n}) - (SELECT avg({n}) FROM mx)) / nullif((SELECT stddev_samp({n}) FROM mx), 0) AS distance "
    f"FROM mx GROUP BY segment" for n in _INPUTS) + """),
mr AS (SELECT *, CAST(row_number() OVER (PARTITION BY segment ORDER BY abs(distance) DESC, feature) AS INTEGER) AS rank
       FROM ml WHERE distance IS NOT NULL)"""
_ZPOINTS = _MATRIX + ", zp AS (SELECT customerID, segment, " + ", ".join(
    f"({n} - (SELECT avg({n}) FROM mx)) / coalesce(nullif((SELECT stddev_pop({n}) FROM mx), 0), 1) AS {n}" for n in _INPUTS) + " FROM mx)"

_OBS = _FEAT + """,
obs AS (SELECT *, CAST(num_addon_services - (TechSupport = 'Yes')::INT AS INTEGER) AS num_other_addons,
   CAST((TechSupport = 'Yes') AS INTEGER) AS treated, Churn AS outcome FROM feat WHERE TechSupport IN ('Yes', 'No'))
"""
_CELLS = _OBS + """,
cells AS (SELECT InternetService, tenure_bucket, sum(treated)::BIGINT AS n_t, sum(1 - treated)::BIGINT AS n_c,
   sum(treated * outcome)::BIGINT AS y_t, sum((1 - treated) * outcome)::BIGINT AS y_c,
   sum(treated)::DOUBLE / count(*) AS e FROM obs GROUP BY ALL),
ends AS (SELECT greatest((SELECT min(e) FROM cells WHERE n_t > 0), (SELECT min(e) FROM cells WHERE n_c > 0), 0.02) AS low,
   least((SELECT max(e) FROM cells WHERE n_t > 0), (SELECT max(e) FROM cells WHERE n_c > 0), 0.98) AS high),
sup AS (SELECT cells.*, least(0.99, greatest(0.01, e)) AS q FROM cells, ends WHERE e BETWEEN low AND high)
"""
_NAIVE = _OBS + """, nv AS (SELECT count(*) AS n, avg(outcome) FILTER (treated = 1) AS t, avg(outcome) FILTER (treated = 0) AS c FROM obs)"""
_IPW = """ip0 AS (SELECT sum(n_t) AS n1, sum(n_c) AS n0, sum(n_t + n_c) AS n, sum(n_t / q) AS w1, sum(n_c / (1 - q)) AS w0,
   sum(y_t / q) AS wy1, sum(y_c / (1 - q)) AS wy0, sum(n_t / (q * q)) AS ww1, sum(n_c / ((1 - q) * (1 - q))) AS ww0 FROM sup),
ip AS (SELECT n::BIGINT AS n, wy1 / w1 - wy0 / w0 AS ate, n1 / n AS m, w1, w0, ww1, ww0 FROM ip0)"""
_AIPW = """ai AS (SELECT sum((n_t + n_c) * (y_t::DOUBLE / n_t - y_c::DOUBLE / n_c)) / sum(n_t + n_c) AS ate FROM sup WHERE n_t > 0 AND n_c > 0)"""

_PANEL = """
oh AS (SELECT o_custkey, o_orderdate::DATE AS day, (year(o_orderdate) - 2001) * 2 + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END AS h FROM orders),
act AS (SELECT o_custkey, list(DISTINCT h) AS hs FROM oh GROUP BY 1),
fp AS (SELECT min(h) + CASE WHEN day(min(day)) = 1 AND month(min(day)) IN (1, 7) THEN 0 ELSE 1 END AS p FROM oh),
pn AS (SELECT CASE WHEN c_nationkey % 3 = 1 THEN 1 ELSE 0 END AS g, CAST(period AS INTEGER) AS period, CASE WHEN period = 0 THEN 1 ELSE 0 END AS post,
   CASE WHEN list_contains(hs, period) THEN 0 ELSE 1 END AS y FROM customer JOIN act ON c_custkey = o_custkey, (SELECT unnest(range(p, 1)) AS period FROM fp)),
dc AS (SELECT avg(y) FILTER (g = 1 AND post = 0 AND period = -1) AS tp, avg(y) FILTER (g = 1 AND post = 1) AS tq,
   avg(y) FILTER (g = 0 AND period = -1) AS cp, avg(y) FILTER (g = 0 AND post = 1) AS cq FROM pn)
"""
# Saturated 2x2 regression with HC1 errors: every coefficient is a contrast of
# cell means and its variance the sum of the cells' mean squared residuals.
_GRID = """
gc AS (SELECT a, b, count(*) AS n, avg(y) AS m, var_pop(y) AS v FROM src GROUP BY a, b),
g2 AS (SELECT sum(n) AS nn,
   max(m) FILTER (a = 0 AND b = 0) AS m00, max(m) FILTER (a = 1 AND b = 0) AS m10, max(m) FILTER (a = 0 AND b = 1) AS m01, max(m) FILTER (a = 1 AND b = 1) AS m11,
   max(v / n) FILTER (a = 0 AND b = 0) AS v00, max(v / n) FILTER (a = 1 AND b = 0) AS v10, max(v / n) FILTER (a = 0 AND b = 1) AS v01, max(v / n) FILTER (a = 1 AND b = 1) AS v11 FROM gc),
g3 AS (SELECT nn, nn::DOUBLE / (nn - 4) AS f, * EXCLUDE (nn) FROM g2),
g4 AS (SELECT {0} AS term, m00 AS b, sqrt(f * v00) AS s, nn - 4 AS dof FROM g3
   UNION ALL SELECT {1}, m10 - m00, sqrt(f * (v00 + v10)), nn - 4 FROM g3
   UNION ALL SELECT {2}, m01 - m00, sqrt(f * (v00 + v01)), nn - 4 FROM g3
   UNION ALL SELECT {3}, m11 - m10 - m01 + m00, sqrt(f * (v00 + v10 + v01 + v11)), nn - 4 FROM g3),
g5 AS (SELECT *, b / s AS t FROM g4), g6 AS (SELECT *, """ + _t_p("t", "dof") + """ AS pv FROM g5)
SELECT term, round(b, 6) AS coefficient, round(s, 6) AS std_error, round(t, 6) AS t_statistic, round(pv, 6) AS p_value, pv < 0.05 AS significant FROM g6
"""
# One binary regressor: slope = gap of means, robust variance from both arms.
_BINARY = """
b1 AS (SELECT count(*) AS n, count(*) FILTER (x = 1) AS n1, count(*) FILTER (x = 0) AS n0, avg(y) FILTER (x = 1) AS m1, avg(y) FILTER (x = 0) AS m0,
   var_pop(y) FILTER (x = 1) AS v1, var_pop(y) FILTER (x = 0) AS v0 FROM src),
b2 AS (SELECT *, n::DOUBLE / (n - 2) AS f FROM b1)
"""
_IV = _OBS + """, iv AS (SELECT outcome AS y, treated AS d, CASE WHEN PaperlessBilling = 'Yes' THEN 1 ELSE 0 END AS z FROM obs),
i1 AS (SELECT count(*) AS n, avg(y) FILTER (z = 1) - avg(y) FILTER (z = 0) AS itt, avg(d) FILTER (z = 1) - avg(d) FILTER (z = 0) AS fs,
   avg(y) FILTER (d = 1) - avg(y) FILTER (d = 0) AS naive, sum(d) AS sd, count(*) FILTER (z = 1) AS n1, count(*) FILTER (z = 0) AS n0,
   avg(d) FILTER (z = 1) AS d1, avg(d) FILTER (z = 0) AS d0, avg(y) AS ym, avg(d) AS dm,
   var_pop(y) FILTER (z = 1) AS yv1, var_pop(y) FILTER (z = 0) AS yv0, var_pop(d) FILTER (z = 1) AS dv1, var_pop(d) FILTER (z = 0) AS dv0,
   var_pop(y) FILTER (d = 1) AS ydv1, var_pop(y) FILTER (d = 0) AS ydv0, count(*) FILTER (d = 1) AS nd1, count(*) FILTER (d = 0) AS nd0,
   var_pop(d) AS dv FROM iv),
i2 AS (SELECT *, itt / fs AS late, n::DOUBLE / (n - 2) AS f, n * dv AS ssr_r, n1 * dv1 + n0 * dv0 AS ssr_f FROM i1),
i3 AS (SELECT *, ym - late * dm AS c FROM i2),
i4 AS (SELECT i3.*, (SELECT sum(power((y - c - late * d) * ((CASE WHEN z = 1 THEN d1 ELSE d0 END) - dm), 2)) FROM iv, i3) AS meat,
   n1 * power(d1 - dm, 2) + n0 * power(d0 - dm, 2) AS sxx FROM i3)
"""


def _with(body):
    return "WITH " + body


ORACLES: dict[str, str] = {}


def _add(name, body):
    ORACLES[name] = _with(body)


# --- cleaning and features ---------------------------------------------------
_add("clean_customers", _RAW + " SELECT * REPLACE (round(TotalCharges, 4) AS TotalCharges) FROM clean")
_add("median_total_charges", _RAW + " SELECT count(TotalCharges) AS n, count(*) - count(TotalCharges) AS blank, "
     "round(median(TotalCharges), 4) AS median_total_charges FROM typed")
_add("engineered_features", _FEAT + " SELECT customerID, num_addon_services, round(avg_monthly_spend, 6) AS avg_monthly_spend, "
     "round(charges_ratio, 6) AS charges_ratio, tenure_bucket, spend_bucket FROM feat")
_add("canonical_export", _FEAT + " SELECT * REPLACE (round(TotalCharges, 6) AS TotalCharges, round(avg_monthly_spend, 6) AS avg_monthly_spend, "
     "round(charges_ratio, 6) AS charges_ratio) FROM feat")
_add("unknown_targets", _RAW + " SELECT count(*) AS rows, count(*) FILTER (Churn NOT IN ('Yes', 'No') OR Churn IS NULL) AS unknown_target FROM raw")
_add("contract_split", _RAW + """ SELECT TotalCharges IS NOT NULL AS valid,
  CASE WHEN TotalCharges IS NULL THEN 'missing TotalCharges' ELSE '' END AS problem, count(*) AS records FROM typed GROUP BY 1, 2""")

# --- segment reports ---------------------------------------------------------
_MONEY = "CAST(round(CAST(sum(CAST(MonthlyCharges AS DECIMAL(18,2)))::DOUBLE / count(*) AS DECIMAL(28,8)), 2) AS DOUBLE)"
_add("churn_by_segment", _FEAT + f""" SELECT Contract, tenure_bucket, spend_bucket, count(*) AS customers, sum(Churn)::BIGINT AS churned,
  round(avg(Churn), 4) AS churn_rate, {_MONEY} AS avg_monthly_charges, round(avg(num_addon_services), 2) AS avg_addons
  FROM feat GROUP BY 1, 2, 3 HAVING count(*) >= 20""")
_add("top_segments", _FEAT + f""" SELECT Contract, tenure_bucket, spend_bucket, count(*) AS customers, sum(Churn)::BIGINT AS churned,
  round(avg(Churn), 4) AS churn_rate, {_MONEY} AS avg_monthly_charges
  FROM feat GROUP BY 1, 2, 3 HAVING count(*) >= 20 ORDER BY churn_rate DESC, 1, 2, 3 LIMIT 20""")

# --- baselines and drift -----------------------------------------------------
_add("baseline_numeric", _FEAT + f", b AS ({_numeric('feat')}) SELECT feature, round(mean, 4) AS mean, round(std, 4) AS std, round(min, 4) AS min, round(max, 4) AS max FROM b")
_add("baseline_long", _FEAT + f""", b AS ({_numeric('feat')}), l AS (SELECT feature, 'mean' AS stat, mean AS v FROM b
  UNION ALL SELECT feature, 'std', std FROM b UNION ALL SELECT feature, 'min', min FROM b UNION ALL SELECT feature, 'max', max FROM b)
  SELECT feature, stat, round(v, 4) AS value FROM l""")
_add("baseline_categorical", _FEAT + f", s AS ({_shares('feat')}) SELECT feature, category, n, round(share, 6) AS share FROM s")
_add("drift_numeric", _drift() + """ SELECT feature, round(train_mean, 4) AS train_mean, round(scoring_mean, 4) AS scoring_mean,
  round(md, 4) AS mean_drift_percent, round(train_std, 4) AS train_std, round(scoring_std, 4) AS scoring_std,
  round(sd, 4) AS std_drift_percent, drifted FROM nf""")
_add("drift_categorical", _drift() + " SELECT feature, round(tvd, 4) AS tvd, drifted, new_categories, missing_categories FROM cf")
_add("category_alignment", _drift() + " SELECT feature, category, round(train_share, 6) AS train_share, round(scoring_share, 6) AS scoring_share FROM al")
_add("drift_summary", _drift(["charges_ratio"]) + """ SELECT (SELECT count(*) FROM nf) AS numeric_features, (SELECT count(*) FROM nf WHERE drifted) AS numeric_drifted,
  (SELECT count(*) FROM cf) AS categorical_features, (SELECT count(*) FROM cf WHERE drifted) AS categorical_drifted,
  (SELECT count(*) FROM nf WHERE drifted) + (SELECT count(*) FROM cf WHERE drifted) > 0 AS drift_detected,
  'charges_ratio' AS missing_features, 'channel' AS extra_features""")
_add("drift_gate", _drift() + " SELECT feature, 'numeric' AS kind FROM nf WHERE drifted UNION ALL SELECT feature, 'categorical' FROM cf WHERE drifted")
_add("event_drift", "e1 AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16'), e2 AS (SELECT * FROM events WHERE NOT ts < TIMESTAMP '2024-01-16'), "
     f"nt AS ({_numeric('e1', ['value'])}), nb AS ({_numeric('e2', ['value'])}), ct AS ({_shares('e1', ['event_type'])}), cb AS ({_shares('e2', ['event_type'])}),"
     + _NDRIFT + "," + _CDRIFT + " SELECT feature, round(md, 4) AS shift, drifted FROM nf UNION ALL SELECT feature, round(tvd, 6), drifted FROM cf")

# --- exploration -------------------------------------------------------------
_TEXT = [c for c in RAW_COLUMNS if c not in ("SeniorCitizen", "tenure", "MonthlyCharges")]
_add("eda_missing", _RAW + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, "
    + (f"count(*) FILTER (trim({c}) = '')" if c in _TEXT else "0::BIGINT") + " AS blanks FROM raw" for c in RAW_COLUMNS))
_add("eda_describe", _RAW + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min, "
    f"round(max({c})::DOUBLE, 4) AS max, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50, "
    f"round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75 FROM clean" for c in NUMERIC))
_add("eda_class_balance", _RAW + """, c AS (SELECT Churn, count(*) AS n FROM raw GROUP BY 1)
  SELECT Churn, n, round(100 * n / sum(n) OVER (), 4) AS percent, round(max(n) OVER () / min(n) OVER (), 4) AS imbalance_ratio FROM c""")
_add("eda_churn_by_level", _RAW + f""", l AS ({_long('typed', [*NOMINAL, *ORDINAL, 'SeniorCitizen'], ', Churn')})
  SELECT feature, category, count(*) AS n, sum(Churn)::BIGINT AS positives, round(avg(Churn), 6) AS rate FROM l GROUP BY 1, 2""")
_add("eda_histogram", _RAW + """, l AS (SELECT 'tenure' AS feature, Churn AS class, tenure::DOUBLE AS v FROM clean
   UNION ALL SELECT 'MonthlyCharges', Churn, MonthlyCharges FROM clean UNION ALL SELECT 'TotalCharges', Churn, TotalCharges FROM clean),
  s AS (SELECT *, min(v) OVER w AS lo, max(v) OVER w AS hi, count(*) OVER w AS total FROM l WINDOW w AS (PARTITION BY feature, class)),
  b AS (SELECT *, CAST(CASE WHEN hi > lo THEN least(floor((v - lo) * 30 / (hi - lo)), 29) ELSE 0 END AS INTEGER) AS bin FROM s)
  SELECT feature, class, bin, round(lo, 4) AS lo, round(hi, 4) AS hi, count(*) AS n,
   round(count(*) * 30.0::DOUBLE / (total * (hi - lo)), 6) AS density FROM b GROUP BY feature, class, bin, lo, hi, total""")
_EDA = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen", "Churn"]
_add("eda_correlation", _RAW + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r FROM clean" for a in _EDA for b in _EDA))
_add("eda_point_biserial", _RAW + ", p AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS n, corr({c}, Churn) AS r FROM clean" for c in _EDA[:-1]) + f"""),
  q AS (SELECT *, n - 2 AS dof, r * sqrt((n - 2) / (1 - r * r)) AS t FROM p), s AS (SELECT *, {_t_p('t', 'dof')} AS pv FROM q)
  SELECT feature, n, dof, round(r, 6) AS r, round(t, 4) AS t, round(greatest(pv, 0), 6) AS p_value,
  CASE WHEN pv < 0.001 THEN '***' WHEN pv < 0.01 THEN '**' WHEN pv < 0.05 THEN '*' ELSE '' END AS stars FROM s""")

# --- scores ------------------------------------------------------------------
_BAND = "CASE WHEN p > 0.6 THEN 'High' WHEN p > 0.4 THEN 'Medium' ELSE 'Low' END"
_BAND2 = "CASE WHEN p >= 0.6 THEN '1 - High' WHEN p >= 0.4 THEN '2 - Medium' ELSE '3 - Low' END"
_OUT = """CASE WHEN prediction = 1 AND Churn = 1 THEN 'true positive' WHEN prediction = 1 AND Churn = 0 THEN 'false positive'
  WHEN prediction = 0 AND Churn = 1 THEN 'false negative' ELSE 'true negative' END"""
_add("score_linear", _SCORED + " SELECT customerID, churn_probability, prediction FROM scored")
_add("risk_bands", _SCORED + f" SELECT {_BAND} AS risk_category, {_BAND2} AS risk_band, count(*) AS customers FROM scored GROUP BY 1, 2")
_add("confusion_labels", _SCORED + f" SELECT customerID, {_OUT} AS prediction_outcome, CAST(prediction = Churn AS INTEGER) AS correct_prediction FROM scored")
_add("revenue_at_risk", _SCORED + """ SELECT customerID, round(MonthlyCharges * 12, 2) AS annual_revenue,
  round(MonthlyCharges * 12 * p, 8) AS revenue_at_risk, round(MonthlyCharges * 12 * p * 0.2::DOUBLE - 50, 8) AS expected_offer_value FROM scored""")
_add("top_risks", _SCORED + " SELECT customerID, churn_probability FROM scored ORDER BY churn_probability DESC, customerID LIMIT 10")
_add("customer_table", _PUBLISHED + f""" SELECT customerID, churn_probability, prediction, {_BAND} AS risk_category, CAST(bin + 1 AS INTEGER) AS risk_decile,
  'v1' AS model_version, 'linear_score' AS model_name, Churn AS actual_churn, {_OUT} AS prediction_outcome,
  round(MonthlyCharges * 12, 2) AS annual_revenue, round(MonthlyCharges * 12 * p, 8) AS revenue_at_risk, {_SEGMENT} AS segment FROM binned""")
_add("decile_outcome", _PUBLISHED + """ SELECT CAST(bin + 1 AS INTEGER) AS risk_decile, count(*) AS customers, round(avg(Churn), 6) AS churn_rate,
  round(avg(p), 6) AS mean_score FROM binned GROUP BY bin""")
_add("gain_curve", _PUBLISHED + """, g AS (SELECT CAST(bin + 1 AS INTEGER) AS risk_decile, count(*) AS customers, sum(Churn)::BIGINT AS churned FROM binned GROUP BY bin)
  SELECT risk_decile, customers, churned, sum(churned) OVER (ORDER BY risk_decile DESC)::BIGINT AS cumulative_churned,
  sum(customers) OVER (ORDER BY risk_decile DESC)::BIGINT AS cumulative_customers FROM g""")
_add("band_rollup", _SCORED + f""" SELECT {_BAND2} AS risk_band, count(DISTINCT customerID) AS customers,
  round(sum(MonthlyCharges * 12 * p), 2) AS revenue_at_risk, round(avg(Churn), 6) AS churn_rate FROM scored GROUP BY 1""")
_add("segment_scatter", _SEG + """, s AS (SELECT segment, count(*) AS customers, avg(MonthlyCharges) AS m, sum(Churn) AS churned FROM segd GROUP BY 1)
  SELECT segment, customers, round(m, 4) AS avg_monthly_charges, round(churned / customers, 6) AS churn_rate,
  round(sum(churned) OVER () / sum(customers) OVER (), 6) AS overall_rate FROM s""")
_add("extract_counts", _contrib() + " SELECT count(*) AS contribution_rows, count(DISTINCT customerID) AS customers, count(DISTINCT feature) AS features FROM lc")

# --- metrics -----------------------------------------------------------------
_CLS = """c AS (SELECT count(*) FILTER (Churn = 1 AND prediction = 1) AS tp, count(*) FILTER (Churn = 0 AND prediction = 1) AS fp,
  count(*) FILTER (Churn = 1 AND prediction = 0) AS fn, count(*) FILTER (Churn = 1) AS support FROM {0}),
m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS pr, coalesce(tp / nullif(tp + fn, 0), 0) AS rc FROM c)"""
_add("classification_metrics", _SCORED + "," + _CLS.format("scored") + """ SELECT tp, fp, fn, support, round(pr, 6) AS precision, round(rc, 6) AS recall,
  round(coalesce(2 * pr * rc / nullif(pr + rc, 0), 0), 6) AS f1_score FROM m""")
_add("class_weight", _RAW + """ SELECT count(*) FILTER (Churn = 0) AS n_negative, count(*) FILTER (Churn = 1) AS n_positive,
  round(count(*) FILTER (Churn = 0) / count(*) FILTER (Churn = 1), 6) AS scale_pos_weight FROM typed""")


def _auc(score):
    return f"""(SELECT (sum(rk) FILTER (Churn = 1) - count(*) FILTER (Churn = 1) * (count(*) FILTER (Churn = 1) + 1) / 2.0::DOUBLE)
   / (count(*) FILTER (Churn = 1)::DOUBLE * count(*) FILTER (Churn = 0)) FROM (
   SELECT Churn, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0::DOUBLE AS rk FROM scored))"""


_add("roc_auc_exact", _SCORED + f" SELECT count(*) FILTER (Churn = 1) AS n_positive, count(*) FILTER (Churn = 0) AS n_negative, round({_auc('p')}, 6) AS roc_auc FROM scored")
_add("score_agreement", _SCORED + f""", rr AS (SELECT rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS a,
   rank() OVER (ORDER BY rival) + (count(*) OVER (PARTITION BY rival) - 1) / 2.0::DOUBLE AS b FROM scored)
  SELECT round(corr(p, rival), 6) AS pearson_r, round((SELECT corr(a, b) FROM rr), 6) AS spearman_rho, round({_auc('p')}, 6) AS first_auc,
  round({_auc('rival')}, 6) AS second_auc, round(abs({_auc('p')} - {_auc('rival')}), 6) AS auc_gap,
  round(avg(abs(p - rival)), 6) AS mean_abs_probability_gap, (SELECT corr(a, b) FROM rr) < 0.95 AS ranks_differ FROM scored""")
_add("score_ranks", _SCORED + """ SELECT p AS churn_probability, avg(rn) AS average_rank
  FROM (SELECT p, row_number() OVER (ORDER BY p) AS rn FROM scored) GROUP BY p""")

# --- contributions -----------------------------------------------------------
_add("linear_contributions", _contrib() + """ SELECT customerID, feature, round(shap_value, 6) + 0.0::DOUBLE AS shap_value, round(feature_value, 6) AS feature_value,
  round(abs_shap, 6) AS abs_shap, direction, rk AS rank_within_customer FROM lc""")
_add("global_importance", _contrib() + """, g AS (SELECT feature, avg(abs_shap) AS m FROM lc GROUP BY 1)
  SELECT feature, round(m, 6) AS mean_abs_shap, CAST(row_number() OVER (ORDER BY m DESC, feature) AS INTEGER) AS rank FROM g""")
_driver = lambda k, c: f"max({c}) FILTER (rk = {k})"
_add("master_table", _contrib() + "," + _edges("scored") + ", dr AS (SELECT customerID, " + ", ".join(
    f"{_driver(k, 'feature')} AS driver_{k}_feature, {_driver(k, 'direction')} AS driver_{k}_direction, round({_driver(k, 'shap_value')}, 6) AS driver_{k}_shap"
    for k in (1, 2, 3)) + f""" FROM lc GROUP BY 1) SELECT customerID, churn_probability, {_BAND} AS risk_category, CAST(bin + 1 AS INTEGER) AS risk_decile,
  dr.* EXCLUDE (customerID) FROM binned JOIN dr USING (customerID)""")
_add("drivers_by_pivot", _contrib() + ", dr AS (SELECT customerID, " + ", ".join(
    f"{_driver(k, 'feature')} AS driver_{k}_feature" for k in (1, 2, 3))
    + " FROM lc GROUP BY 1) SELECT customerID, churn_probability, dr.* EXCLUDE (customerID) FROM scored JOIN dr USING (customerID)")

# --- splits and experiment ---------------------------------------------------
_add("stratified_split", _RAW + f""", k AS (SELECT customerID, Churn, row_number() OVER (PARTITION BY Churn ORDER BY {_seeded('customerID', SEED)}, customerID) AS rk,
   count(*) OVER (PARTITION BY Churn) AS sz FROM typed), q AS (SELECT *, (2 * sz + 5) // 10 AS t FROM k)
  SELECT customerID, Churn, CASE WHEN rk <= t THEN 'test' WHEN rk <= 2 * t THEN 'validation' ELSE 'train' END AS split FROM q""")
_add("stratified_assignment", _ASSIGNED + ' SELECT customerID, bin AS risk_stratum, grp AS "group" FROM assigned')
_arm = lambda m: f"""SELECT '{m}' AS metric, count(*) FILTER (grp = 'treatment') AS n_t, count(*) FILTER (grp = 'control') AS n_c,
  round(sum({m}::DOUBLE) FILTER (grp = 'treatment'), 4) AS sum_t, round(sum({m}::DOUBLE) FILTER (grp = 'control'), 4) AS sum_c,
  round(avg({m}) FILTER (grp = 'treatment'), 4) AS mean_t, round(avg({m}) FILTER (grp = 'control'), 4) AS mean_c,
  round(var_samp({m}) FILTER (grp = 'treatment'), 4) AS var_t, round(var_samp({m}) FILTER (grp = 'control'), 4) AS var_c FROM outcomes"""
_add("arm_summary", _ASSIGNED + " " + _arm("retained") + " UNION ALL " + _arm("revenue_net"))
_add("balance_check", _ASSIGNED + "," + _welch("assigned", "p") + """ SELECT n_t, n_c, round(mt, 6) AS mean_t, round(mc, 6) AS mean_c, round(t, 6) AS t_statistic,
  round(dof, 4) AS degrees_of_freedom, round(pv, 6) AS p_value FROM w4""")
_add("ab_retention_z", _ASSIGNED + "," + _ARM_RET.format(by="", src="outcomes", group="") + "," + _Z + f""" SELECT nt AS n_t, nc AS n_c, round(pt, 6) AS rate_treatment,
  round(pc, 6) AS rate_control, round(diff, 6) AS absolute_difference, round(diff / nullif(pc, 0), 6) AS relative_lift, round(z, 6) AS z_statistic,
  round(pv, 6) AS p_value, round(diff - {_ZA} * seu, 6) AS ci_low, round(diff + {_ZA} * seu, 6) AS ci_high,
  round(2 * asin(sqrt(pt)) - 2 * asin(sqrt(pc)), 6) AS cohens_h, pv < 0.05 AS significant FROM z4""")
_add("aa_control", _AA + "," + _ARM_RET.format(by="", src="aa", group="") + "," + _Z + """ SELECT nt AS n_t, nc AS n_c, round(pt, 6) AS rate_treatment,
  round(pc, 6) AS rate_control, round(z, 6) AS z_statistic, round(pv, 6) AS p_value, pv < 0.05 AS significant FROM z4""")
_add("ab_contingency", _ASSIGNED + """ SELECT grp AS "group", count(*) FILTER (churned = 0) AS stayed, count(*) FILTER (churned = 1) AS left_ FROM outcomes GROUP BY 1""")
_CHI = """ct AS (SELECT count(*) AS n, count(*) FILTER (grp = 'control' AND churned = 0) AS a, count(*) FILTER (grp = 'control' AND churned = 1) AS b,
  count(*) FILTER (grp = 'treatment' AND churned = 0) AS c, count(*) FILTER (grp = 'treatment' AND churned = 1) AS d FROM outcomes),
cx AS (SELECT *, n * power(greatest(abs(a * d - b * c) - n / 2.0::DOUBLE, 0), 2) / ((a + b)::DOUBLE * (c + d) * (a + c) * (b + d)) AS chi FROM ct),
"""
_add("ab_chi_square", _ASSIGNED + "," + _CHI + f"""cy AS (SELECT *, {_norm_p('sqrt(chi)')} AS pv FROM cx)
  SELECT n, round(chi, 6) AS chi2_statistic, 1 AS degrees_of_freedom, round(sqrt(chi / n), 6) AS cramers_v, round(pv, 6) AS p_value, pv < 0.05 AS significant FROM cy""")
_add("ab_revenue_welch", _ASSIGNED + "," + _welch("outcomes", "revenue_net") + """ SELECT n_t, n_c, round(mt, 4) AS mean_t, round(mc, 4) AS mean_c, round(diff, 4) AS difference,
  round(t, 4) AS t_statistic, round(dof, 4) AS degrees_of_freedom, round(pv, 4) AS p_value, round(diff / psd, 4) AS cohens_d, pv < 0.05 AS significant FROM w4""")
_add("ab_impact", _ASSIGNED + "," + _welch("outcomes", "revenue_net") + " SELECT n_t AS n_treatment, round(diff * n_t, 2) AS net_revenue_gain, round(50.0::DOUBLE * n_t, 2) AS campaign_cost FROM w4")
_add("holm", _SCORED + ", fam AS (" + " UNION ALL ".join(
    f"SELECT '{l}' AS metric, CASE WHEN Contract = '{l}' THEN 'treatment' ELSE 'control' END AS grp, 1 - Churn AS retained FROM scored" for l in CONTRACT_LEVELS)
    + ")," + _ARM_RET.format(by="metric,", src="fam", group="GROUP BY metric") + "," + _Z + """,
  hh AS (SELECT metric, pv, 0.05::DOUBLE / (count(*) OVER () - row_number() OVER (ORDER BY pv, metric) + 1) AS th FROM z4)
  SELECT metric, round(pv, 6) AS p_value, round(th, 6) AS adjusted_threshold, bool_and(pv < th) OVER (ORDER BY pv, metric) AS significant_after_correction FROM hh""")
_DESIGN = f""" ds0 AS (SELECT Contract, 1 - avg(p) AS base, count(*) // 2 AS avail, stddev_samp(MonthlyCharges * 12) AS rsd FROM scored WHERE p >= 0.3 GROUP BY 1),
ds1 AS (SELECT *, least(1 - 1e-9, greatest(1e-9, base + 0.05)) AS p2 FROM ds0),
ds AS (SELECT *, (base + p2) / 2 AS mid, CAST(ceil(power({_ZA} * sqrt(2 * (base + p2) / 2 * (1 - (base + p2) / 2)) + {_ZB} * sqrt(base * (1 - base) + p2 * (1 - p2)), 2)
  / power(p2 - base, 2)) AS BIGINT) AS req, ({_ZA} + {_ZB}) * sqrt(2 * base * (1 - base) / avail) AS mde FROM ds1)"""
_add("design_table", _SCORED + "," + _DESIGN + f""" SELECT Contract, round(base, 6) AS baseline_rate, avail AS available_n_per_arm, round(rsd, 4) AS revenue_sd,
  req AS required_n_per_arm, round(mde, 6) AS detectable_mde, avail >= req AS adequately_powered,
  CAST(ceil(2 * power(({_ZA} + {_ZB}) * rsd / 50, 2)) AS BIGINT) AS required_n_revenue FROM ds""")


def _power(n, base, effect):
    p2 = f"least(1 - 1e-9, greatest(1e-9, {base} + {effect}))"
    mid = f"(({base} + {p2}) / 2)"
    z = (f"((abs({p2} - {base}) - {_ZA} * sqrt(2 * {mid} * (1 - {mid}) / {n})) / sqrt(({base} * (1 - {base}) + {p2} * (1 - {p2})) / {n}))")
    return z


def _cdf(z):
    return f"(CASE WHEN {z} >= 0 THEN 1 - {_norm_p(z)} / 2 ELSE {_norm_p(z)} / 2 END)"


_add("power_curve", _SCORED + "," + _DESIGN + f""",
  tp AS (SELECT *, greatest(floor(req * 1.6::DOUBLE), 2 * avail, 51) AS top FROM ds),
  gr AS (SELECT DISTINCT Contract, base, CAST(floor(50 + (top - 50) * i / 199) AS BIGINT) AS n_per_arm FROM tp, (SELECT unnest(range(0, 200)) AS i)),
  ge AS (SELECT *, m * 0.05::DOUBLE AS effect FROM gr, (SELECT unnest([1.0::DOUBLE, 1.5::DOUBLE, 2.0::DOUBLE]) AS m)),
  gz AS (SELECT *, {_power('n_per_arm', 'base', 'effect')} AS z FROM ge)
  SELECT Contract, n_per_arm, round(effect, 6) AS effect, round({_cdf('z')}, 6) AS power FROM gz""")
_add("verdicts", _ASSIGNED + "," + _ARM_RET.format(by="Contract,", src="outcomes", group="GROUP BY Contract") + "," + _Z + "," + _DESIGN + f""",
  vj AS (SELECT Contract, pv, req, avail, {_power('avail', 'base', '0.05::DOUBLE')} AS pz FROM z4 JOIN ds USING (Contract))
  SELECT Contract, round(pv, 6) AS p_value, req AS required_n_per_arm, avail AS available_n_per_arm, avail >= req AS adequately_powered,
  CASE WHEN pv < 0.05 THEN 'significant' WHEN avail >= req THEN 'null' ELSE 'inconclusive' END AS verdict,
  pv < 0.05 AND NOT avail >= req AS inflation_caveat, round({_cdf('pz')}, 6) AS achieved_power FROM vj""")

# --- encoding ----------------------------------------------------------------
_add("category_levels", _FEAT + f""", l AS ({_long('feat', [*NOMINAL, 'tenure_bucket', 'spend_bucket'])})
  SELECT feature, string_agg(DISTINCT category, '|' ORDER BY category) AS levels FROM l GROUP BY 1""")
_add("category_codes", _RAW + ", " + ", ".join(
    f"code_{c} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT {c} FROM typed WHERE PaymentMethod LIKE '%check'))"
    for c in NOMINAL) + " SELECT customerID, " + ", ".join(
    f"coalesce((SELECT code FROM code_{c} WHERE v = typed.{c}), -1) AS {c}" for c in NOMINAL) + """,
  CAST(CASE Contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 ELSE -1 END AS INTEGER) AS contract_code FROM typed""")
_add("one_hot", _RAW + " " + " UNION ALL ".join(f"SELECT '{c}_' || {c} AS term, count(*)::DOUBLE AS total FROM typed GROUP BY 1" for c in NOMINAL) + """
  UNION ALL SELECT 'tenure', sum(tenure)::DOUBLE FROM typed
  UNION ALL SELECT 'Contract_code', sum(CASE Contract WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 ELSE 0 END)::DOUBLE FROM typed""")
_OTHER_LEVELS = {c: {"gender": ["Male"], "MultipleLines": ["No phone service", "Yes"], "InternetService": ["Fiber optic", "No"],
                     "PaymentMethod": ["Credit card (automatic)", "Electronic check", "Mailed check"]}.get(
    c, ["Yes"] if c in ("Partner", "Dependents", "PhoneService", "PaperlessBilling") else ["No internet service", "Yes"]) for c in NOMINAL}
_ind = lambda c, v: f"(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END)::DOUBLE"
_add("reference_design", _RAW + " SELECT customerID, " + ", ".join(
    f"{_ind(c, v)} AS \"{c}_{v.replace(' ', '_').replace('(', '').replace(')', '').replace('-', '_')}\"" for c, v in [
        *[(c, v) for c in NOMINAL for v in _OTHER_LEVELS[c]], ("Contract", "One year"), ("Contract", "Two year")])
    + ", tenure::DOUBLE AS tenure FROM typed")
_add("standardised", _RAW + " SELECT customerID, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM clean)) / (SELECT stddev_pop({c}) FROM clean), 6) AS {c}" for c in NUMERIC) + " FROM clean")

# --- segments ----------------------------------------------------------------
_add("segment_profile", _PROFILE + " SELECT * FROM prof")
_add("segment_differences", _DISTANCE + " SELECT segment, feature, round(distance, 4) AS distance, rank FROM mr WHERE rank <= 4")
_add("segment_names", _NAMES + " SELECT segment, name, customers FROM nm")
_add("most_exposed", _PROFILE + " SELECT segment, customers, churn_rate, monthly_revenue_at_risk FROM prof ORDER BY monthly_revenue_at_risk DESC LIMIT 1")
_dims = list(_INPUTS)
_d2 = lambda a, b: " + ".join(f"power({a}.{c} - {b}.{c}, 2)" for c in _dims)
_add("cluster_quality", _ZPOINTS + ", cen AS (SELECT segment, count(*) AS n, " + ", ".join(f"avg({c}) AS {c}" for c in _dims)
     + ", " + " + ".join(f"avg({c} * {c})" for c in _dims) + f""" AS s2 FROM zp GROUP BY 1),
  tot AS (SELECT """ + ", ".join(f"avg({c}) AS {c}" for c in _dims) + f""" FROM zp),
  own AS (SELECT zp.segment, {_d2('zp', 'cen')} AS d2 FROM zp JOIN cen USING (segment)),
  spr AS (SELECT segment, avg(sqrt(d2)) AS sp, sum(d2) AS ss FROM own GROUP BY 1),
  md AS (SELECT zp.customerID, zp.segment, cen.segment AS other, cen.n, """ + " + ".join(f"zp.{c} * zp.{c}" for c in _dims)
     + " + cen.s2 - 2 * (" + " + ".join(f"zp.{c} * cen.{c}" for c in _dims) + """) AS m2 FROM zp, cen),
  ab AS (SELECT customerID, max(n * m2 / nullif(n - 1, 0)) FILTER (segment = other) AS a, min(m2) FILTER (segment <> other) AS b, max(n) FILTER (segment = other) AS n FROM md GROUP BY 1),
  db AS (SELECT a.segment, max((sa.sp + sb.sp) / sqrt(""" + _d2("a", "b") + """)) AS r FROM cen a JOIN cen b ON a.segment <> b.segment
     JOIN spr sa ON sa.segment = a.segment JOIN spr sb ON sb.segment = b.segment GROUP BY 1),
  bt AS (SELECT sum(cen.n * (""" + _d2("cen", "tot") + """)) AS between_ss FROM cen, tot)
  SELECT CAST((SELECT count(*) FROM cen) AS INTEGER) AS k, (SELECT count(*) FROM zp) AS rows, round((SELECT sum(ss) FROM spr), 4) AS inertia,
  round((SELECT avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) FROM ab), 4) AS silhouette, round((SELECT avg(r) FROM db), 4) AS davies_bouldin,
  round((SELECT between_ss FROM bt) * ((SELECT count(*) FROM zp) - (SELECT count(*) FROM cen)) / ((SELECT sum(ss) FROM spr) * ((SELECT count(*) FROM cen) - 1)), 4) AS calinski_harabasz,
  round((SELECT min(n) FROM cen) / (SELECT count(*) FROM zp), 4) AS smallest_share""")
_add("adjusted_rand", _SCORED + f""", j AS (SELECT {_SEGMENT} AS a, {_BAND} AS b, count(*) AS n FROM scored GROUP BY 1, 2),
  x AS (SELECT (SELECT sum(n * (n - 1) / 2.0::DOUBLE) FROM j) AS ij, (SELECT sum(s * (s - 1) / 2.0::DOUBLE) FROM (SELECT sum(n) AS s FROM j GROUP BY a)) AS ai,
   (SELECT sum(s * (s - 1) / 2.0::DOUBLE) FROM (SELECT sum(n) AS s FROM j GROUP BY b)) AS bj, (SELECT sum(n) * (sum(n) - 1) / 2.0::DOUBLE FROM j) AS t)
  SELECT round((ij - ai * bj / t) / ((ai + bj) / 2 - ai * bj / t), 6) AS adjusted_rand_index FROM x""")
_add("dim_segment", _NAMES + ", " + _DISTANCE.split(", mx AS", 1)[1].join(["mx AS", ""]) + """,
  tx AS (SELECT segment, string_agg(feature || ' (' || printf('%+.1f', round(distance, 2)) || ' SD)', ', ' ORDER BY rank) AS distinguishing_features FROM mr WHERE rank <= 4 GROUP BY 1)
  SELECT nm.segment, name, customers, share, churn_rate, distinguishing_features FROM nm JOIN tx USING (segment)""")

# --- regression --------------------------------------------------------------
_add("ols_hc1", _RAW + ", src AS (SELECT Churn AS y, CASE WHEN PaperlessBilling = 'Yes' THEN 1 ELSE 0 END AS x FROM typed)," + _BINARY + f""",
  b3 AS (SELECT 'const' AS term, m0 AS b, sqrt(f * v0 / n0) AS s, n - 2 AS dof FROM b2 UNION ALL SELECT 'paperless', m1 - m0, sqrt(f * (v1 / n1 + v0 / n0)), n - 2 FROM b2),
  b4 AS (SELECT *, b / s AS t FROM b3), b5 AS (SELECT *, {_t_p('t', 'dof')} AS pv FROM b4)
  SELECT term, round(b, 6) AS coefficient, round(s, 6) AS std_error, round(t, 6) AS t_statistic, round(pv, 6) AS p_value, pv < 0.05 AS significant FROM b5""")
_add("ols_saturated", _RAW + """, src AS (SELECT Churn AS y, CASE WHEN Partner = 'Yes' THEN 1 ELSE 0 END AS a,
   CASE WHEN PaperlessBilling = 'Yes' THEN 1 ELSE 0 END AS b FROM typed),""" + _GRID.format("'const'", "'partner'", "'paperless'", "'both'"))
_add("iv_readout", _IV + """ SELECT 'naive_ols' AS estimator, round(naive, 6) AS estimate, round(sqrt(f * (ydv1 / nd1 + ydv0 / nd0)), 6) AS std_error, NULL::DOUBLE AS f_statistic, NULL::BOOLEAN AS weak_instrument, n FROM i4
  UNION ALL SELECT 'intention_to_treat', round(itt, 6), round(sqrt(f * (yv1 / n1 + yv0 / n0)), 6), NULL, NULL, n FROM i4
  UNION ALL SELECT 'first_stage', round(fs, 6), round(sqrt(f * (dv1 / n1 + dv0 / n0)), 6), round((ssr_r - ssr_f) / (ssr_f / (n - 2)), 4), (ssr_r - ssr_f) / (ssr_f / (n - 2)) < 10, n FROM i4
  UNION ALL SELECT 'two_stage_least_squares', round(late, 6), round(sqrt(f * meat) / sxx, 6), NULL, NULL, n FROM i4
  UNION ALL SELECT 'wald_late', round(late, 6), NULL, NULL, NULL, n FROM i4""")
_add("did", _PANEL + """ SELECT round(tp, 6) AS treated_pre, round(tq, 6) AS treated_post, round(cp, 6) AS control_pre, round(cq, 6) AS control_post,
  round(tq - tp, 6) AS treated_change, round(cq - cp, 6) AS control_change, round(tq - cq, 6) AS naive_post_period, round(tq - tp - (cq - cp), 6) AS did_estimate FROM dc""")
_add("did_regression", _PANEL + ", src AS (SELECT y, g AS a, post AS b FROM pn WHERE period IN (-1, 0))," + _GRID.format("'const'", "'treated_group'", "'post'", "'did'"))
_add("pre_period_gaps", _PANEL + " SELECT period, round(avg(y) FILTER (g = 1) - avg(y) FILTER (g = 0), 6) AS gap FROM pn WHERE period < 0 GROUP BY period")
# The interaction is the difference of the two groups' slopes over all periods before the event.
_add("parallel_trends", _PANEL + f""", src AS (SELECT y::DOUBLE AS y, g AS a, period::DOUBLE AS t FROM pn WHERE period < 0),
  gm AS (SELECT a, avg(t) AS tm, avg(y) AS ym FROM src GROUP BY a),
  sl AS (SELECT a, tm, ym, sum((t - tm) * (t - tm)) AS sxx, sum((t - tm) * (y - ym)) / sum((t - tm) * (t - tm)) AS b FROM src JOIN gm USING (a) GROUP BY a, tm, ym),
  vr AS (SELECT a, any_value(b) AS b, sum(power((t - tm) * (y - ym - b * (t - tm)), 2)) / power(any_value(sxx), 2) AS v, count(*) AS n FROM src JOIN sl USING (a) GROUP BY a),
  k AS (SELECT sum(n) AS nn, sum(v) AS vv, max(b) FILTER (a = 1) - max(b) FILTER (a = 0) AS i FROM vr),
  gp AS (SELECT max(gap) - min(gap) AS drift, count(*) AS periods FROM (SELECT t, avg(y) FILTER (a = 1) - avg(y) FILTER (a = 0) AS gap FROM src GROUP BY t)),
  k2 AS (SELECT *, sqrt(nn::DOUBLE / (nn - 4) * vv) AS s, nn - 4 AS dof FROM k, gp), k3 AS (SELECT *, i / s AS t FROM k2), k4 AS (SELECT *, {_t_p('t', 'dof')} AS pv FROM k3)
  SELECT periods AS pre_periods, true AS testable, round(drift, 6) AS gap_drift, round(i, 6) AS interaction, round(s, 6) AS std_error, round(t, 6) AS t_statistic,
  round(pv, 6) AS p_value, NOT pv < 0.05 AS trends_parallel FROM k4""")
_add("tsls_late", _IV + f""", c1 AS (SELECT 'redeemed' AS term, late AS b, sqrt(f * meat) / sxx AS s, n - 2 AS dof FROM i4
   UNION ALL SELECT 'const', c, sqrt(f * (SELECT sum(power((y - i4.c - i4.late * d) * (1.0::DOUBLE / i4.n - i4.dm * ((CASE WHEN z = 1 THEN i4.d1 ELSE i4.d0 END) - i4.dm) / i4.sxx), 2)) FROM iv)), n - 2 FROM i4),
  c2 AS (SELECT *, b / s AS t FROM c1), c3 AS (SELECT *, {_t_p('t', 'dof')} AS pv FROM c2)
  SELECT term, round(b, 6) AS coefficient, round(s, 6) AS std_error, round(t, 6) AS t_statistic, round(pv, 6) AS p_value, pv < 0.05 AS significant FROM c3""")
_add("vif", _RAW + ", v1 AS (SELECT 1 / (1 - power(corr(tenure, TotalCharges), 2)) AS v FROM clean) SELECT 'tenure' AS feature, round(v, 6) AS vif FROM v1 UNION ALL SELECT 'TotalCharges', round(v, 6) FROM v1")
# One binary covariate: the log odds ratio, with p(1 - p) at the class-balanced fit.
_add("wald_odds", _RAW + f""", c AS (SELECT count(*) FILTER (x = 1 AND y = 1)::DOUBLE AS a, count(*) FILTER (x = 1 AND y = 0)::DOUBLE AS b,
   count(*) FILTER (x = 0 AND y = 1)::DOUBLE AS c, count(*) FILTER (x = 0 AND y = 0)::DOUBLE AS d FROM (SELECT CASE WHEN Partner = 'Yes' THEN 1 ELSE 0 END AS x, Churn AS y FROM typed)),
  w AS (SELECT *, (a + b + c + d) / (2 * (a + c)) AS wp, (a + b + c + d) / (2 * (b + d)) AS wn FROM c),
  p AS (SELECT *, ln(a * d / (b * c)) AS beta, wp * a / (wp * a + wn * b) AS p1, wp * c / (wp * c + wn * d) AS p0 FROM w),
  s AS (SELECT *, sqrt(1 / ((a + b) * p1 * (1 - p1)) + 1 / ((c + d) * p0 * (1 - p0))) AS se FROM p)
  SELECT 'partner' AS feature, round(beta, 4) AS coefficient, round(se, 4) AS std_error, round(exp(beta), 4) AS odds_ratio, {_norm_p('beta / se')} < 0.05 AS significant, 1.0::DOUBLE AS vif FROM s""")

# --- causal estimates --------------------------------------------------------
_add("prepare_observational", _OBS + " SELECT customerID, num_other_addons, treated, outcome FROM obs")
_add("naive_difference", _NAIVE + " SELECT n, round(t, 6) AS treated_rate, round(c, 6) AS control_rate, round(t - c, 6) AS naive_difference FROM nv")
_add("propensity_cells", _CELLS + " SELECT InternetService, tenure_bucket, n_t, n_c, y_t, y_c, round(e, 6) AS propensity FROM cells")
_add("overlap", _CELLS + """, o AS (SELECT low, high, sum(n_t + n_c)::BIGINT AS n_total, coalesce(sum(n_t + n_c) FILTER (e BETWEEN low AND high), 0)::BIGINT AS n_in_support FROM cells, ends GROUP BY 1, 2)
  SELECT round(low, 6) AS low, round(high, 6) AS high, n_total, n_in_support, n_total - n_in_support AS n_dropped, round((n_total - n_in_support) / n_total, 6) AS share_dropped FROM o""")
_add("ipw_ate", _CELLS + "," + _IPW + """ SELECT n, round(ate, 6) AS ipw_ate,
  round(power(m * w1 + (1 - m) * w0, 2) / (m * m * ww1 + (1 - m) * (1 - m) * ww0), 3) AS effective_sample_size FROM ip""")
_add("aipw_ate", _CELLS + "," + _AIPW + " SELECT round(ate, 6) AS aipw_ate FROM ai")
_smd = lambda n, e: (f"SELECT '{n}' AS covariate, round((avg({e}) FILTER (treated = 1) - avg({e}) FILTER (treated = 0)) / "
                     f"sqrt((var_pop({e}) FILTER (treated = 1) + var_pop({e}) FILTER (treated = 0)) / 2), 6) AS smd FROM obs")
_add("smd", _OBS + " " + " UNION ALL ".join(_smd(n, e) for n, e in {
    "tenure": "tenure", "num_other_addons": "num_other_addons", "fiber": "(InternetService = 'Fiber optic')::INT", "two_year": "(Contract = 'Two year')::INT"}.items()))
_add("smd_weighted", _CELLS + """, a AS (SELECT 1 AS treated, n_t / q AS w, (InternetService = 'Fiber optic')::INT AS fiber, (tenure_bucket IN ('0-6m', '6-12m'))::INT AS fy FROM sup
   UNION ALL SELECT 0, n_c / (1 - q), (InternetService = 'Fiber optic')::INT, (tenure_bucket IN ('0-6m', '6-12m'))::INT FROM sup),
  m AS (SELECT treated, sum(w * fiber) / sum(w) AS f, sum(w * fy) / sum(w) AS y FROM a GROUP BY 1),
  x AS (SELECT max(f) FILTER (treated = 1) AS f1, max(f) FILTER (treated = 0) AS f0, max(y) FILTER (treated = 1) AS y1, max(y) FILTER (treated = 0) AS y0 FROM m)
  SELECT 'fiber' AS covariate, round((f1 - f0) / sqrt((f1 * (1 - f1) + f0 * (1 - f0)) / 2), 6) AS smd FROM x
  UNION ALL SELECT 'first_year', round((y1 - y0) / sqrt((y1 * (1 - y1) + y0 * (1 - y0)) / 2), 6) FROM x""")
_add("e_value", _NAIVE + """, r AS (SELECT t / c AS rr FROM nv), q AS (SELECT rr, CASE WHEN rr >= 1 THEN rr ELSE 1 / rr END AS k FROM r)
  SELECT round(rr, 6) AS risk_ratio, round(k + sqrt(k * (k - 1)), 6) AS e_value FROM q""")
_add("att_lookup", _OBS + f""", k AS (SELECT *, row_number() OVER (PARTITION BY tenure, treated ORDER BY {_seeded('customerID', SEED)}, customerID) AS rk FROM obs),
  p AS (SELECT a.outcome AS t, b.outcome AS c FROM k a JOIN k b ON a.tenure = b.tenure AND a.rk = b.rk AND a.treated = 1 AND b.treated = 0)
  SELECT count(*) AS n_pairs, round(avg(t - c), 6) AS att, round(avg(t), 6) AS treated_rate, round(avg(c), 6) AS control_rate FROM p""")

# --- gates, runs and facts ---------------------------------------------------
_add("model_gate", _SCORED + f""", a AS (SELECT 'linear_score' AS model, {_auc('p')} AS auc UNION ALL SELECT 'rival_score', {_auc('rival')}),
  b AS (SELECT * FROM a ORDER BY auc DESC LIMIT 1)
  SELECT model, round(auc, 6) AS roc_auc, 0.78::DOUBLE AS threshold, auc >= 0.78 AS passed,
  printf('ROC-AUC %.4f ', auc) || CASE WHEN auc >= 0.78 THEN 'meets' ELSE 'is below' END || ' the 0.78 threshold' AS reason FROM b""")


def _ledger(name, score):
    return f"""SELECT '20260101-000000' AS run_ts, '{name}' AS model, round({_auc(score)}, 6) AS roc_auc, round(pr, 6) AS precision, round(rc, 6) AS recall,
  round(coalesce(2 * pr * rc / nullif(pr + rc, 0), 0), 6) AS f1_score FROM (SELECT tp / nullif(tp + fp, 0) AS pr, tp / nullif(tp + fn, 0) AS rc FROM (
  SELECT count(*) FILTER (Churn = 1 AND {score} >= 0.5) AS tp, count(*) FILTER (Churn = 0 AND {score} >= 0.5) AS fp, count(*) FILTER (Churn = 1 AND {score} < 0.5) AS fn FROM scored))"""


_add("run_ledger", _SCORED + " " + _ledger("linear_score", "p") + " UNION ALL " + _ledger("rival_score", "rival"))
ORACLES["newest_run"] = """SELECT strftime(o_orderdate, '%Y%m%d') AS run_ts, o_orderkey, o_custkey FROM orders
  WHERE strftime(o_orderdate, '%Y%m%d') = (SELECT max(strftime(o_orderdate, '%Y%m%d')) FROM orders)"""


def _fact(tag, source):
    z = (_ARM_RET.format(by="", src=source, group="") + "," + _Z).replace("arms", f"arms{tag}")
    for n in ("zz", "z2", "z3", "z4"):
        z = z.replace(f"{n} AS (", f"{n}{tag} AS (").replace(f"FROM {n})", f"FROM {n}{tag})")
    w = _welch(source, "revenue_net")
    for n in ("w1", "w2", "w3", "w4"):
        w = w.replace(f"{n} AS (", f"{n}{tag} AS (").replace(f"FROM {n})", f"FROM {n}{tag})")
    return z + "," + w


def _fact_rows(tag, run):
    return f"""SELECT '{run}' AS run, 'retention rate' AS metric, round(pt, 4) AS treatment, round(pc, 4) AS control, round(diff, 4) AS difference, round(pv, 4) AS p_value,
  round(2 * asin(sqrt(pt)) - 2 * asin(sqrt(pc)), 4) AS effect_size, pv < 0.05 AS significant, 'Cohen''s h' AS effect_size_name FROM z4{tag}
  UNION ALL SELECT '{run}', 'net revenue per customer', round(mt, 4), round(mc, 4), round(diff, 4), round(pv, 4), round(diff / psd, 4), pv < 0.05, 'Cohen''s d' FROM w4{tag}"""


_add("fact_experiment", _AA + "," + _fact("a", "outcomes") + "," + _fact("b", "aa") + " " + _fact_rows("a", "A/B test") + " UNION ALL " + _fact_rows("b", "A/A control"))
_add("fact_causal", _CELLS + "," + _IPW + "," + _AIPW + ", nv AS (SELECT avg(outcome) FILTER (treated = 1) - avg(outcome) FILTER (treated = 0) AS d FROM obs)"
     + _IV[len(_OBS):] + "," + _PANEL + """
  SELECT 'Propensity scoring' AS analysis, 'Naive difference' AS estimator, round(d, 6) AS estimate, false AS adjusted, 'confounded by who takes the treatment' AS note FROM nv
  UNION ALL SELECT 'Propensity scoring', 'ipw ate', round(ate, 6), true, 'stabilised weights' FROM ip
  UNION ALL SELECT 'Propensity scoring', 'aipw ate', round(ate, 6), true, 'doubly robust' FROM ai
  UNION ALL SELECT 'Instrumental variables', 'Naive OLS', round(naive, 6), false, '' FROM i4
  UNION ALL SELECT 'Instrumental variables', 'Intention to treat', round(itt, 6), true, '' FROM i4
  UNION ALL SELECT 'Instrumental variables', '2SLS / LATE', round(late, 6), true, '' FROM i4
  UNION ALL SELECT 'Difference-in-differences', 'Naive post-period', round(tq - cq, 6), false, '' FROM dc
  UNION ALL SELECT 'Difference-in-differences', 'Naive before/after', round(tq - tp, 6), false, '' FROM dc
  UNION ALL SELECT 'Difference-in-differences', 'Difference-in-differences', round(tq - tp - (cq - cp), 6), true, '' FROM dc""")
# one treated customer a step, from the highest score down; used controls are a list of places on the line
ORACLES["match_caliper"] = "WITH RECURSIVE " + _OBS + """, line AS MATERIALIZED (SELECT tenure + floor(MonthlyCharges * 4) / 64 AS score, treated FROM obs),
t AS MATERIALIZED (SELECT score, row_number() OVER (ORDER BY score DESC) AS i FROM line WHERE treated = 1),
c AS MATERIALIZED (SELECT score, row_number() OVER (ORDER BY score DESC) AS j FROM line WHERE treated = 0),
walk AS (SELECT 0::BIGINT AS i, NULL::DOUBLE AS t_score, NULL::DOUBLE AS c_score, []::BIGINT[] AS used
  UNION ALL
  SELECT t.i, t.score, near.score, CASE WHEN near.j IS NULL THEN used ELSE list_append(used, near.j) END FROM walk JOIN t ON t.i = walk.i + 1
  LEFT JOIN LATERAL (SELECT c.score, c.j FROM c WHERE abs(c.score - t.score) <= 0.125 AND NOT list_contains(walk.used, c.j)
    ORDER BY abs(c.score - t.score), c.score DESC, c.j LIMIT 1) near ON true)
SELECT t_score, c_score, count(*) AS pairs FROM walk WHERE c_score IS NOT NULL GROUP BY ALL"""
# a model at rest: every row is at its nearest centre and every centre is the mean of its rows
ORACLES["kmeans_stationary"] = "SELECT CAST(k AS INTEGER) AS k, CAST(0 AS BIGINT) AS nearer_elsewhere, 0.0::DOUBLE AS centre_gap FROM range(2, 11) t(k)"
# every draw's score equations are 0 at the fit
ORACLES["bootstrap_score_equations"] = "SELECT CAST(r AS INTEGER) AS replicate, 0.0::DOUBLE AS largest_residual FROM range(0, 200) t(r)"
# published columns by datatype, in no order
_DICTIONARY = {
    "dim_customer": {
        "string": ["customerID", "gender", "Partner", "Dependents", "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
                   "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod", "tenure_bucket",
                   "spend_bucket", "risk_category", "model_version", "model_name", "prediction_outcome"],
        "integer": ["SeniorCitizen", "tenure", "Churn", "num_addon_services", "prediction", "risk_decile", "actual_churn"],
        "real": ["MonthlyCharges", "TotalCharges", "avg_monthly_spend", "charges_ratio", "churn_probability", "annual_revenue", "revenue_at_risk"]},
    "dim_segment": {
        "integer": ["segment", "customers"],
        "real": ["share", "churn_rate", "avg_tenure", "avg_monthly_charges", "avg_total_charges", "avg_addons", "pct_month_to_month", "pct_fiber",
                 "monthly_revenue", "monthly_revenue_share", "monthly_revenue_at_risk"]},
}
_entries = ", ".join(f"('{t}', '{c}', '{kind}')" for t, kinds in _DICTIONARY.items() for kind, columns in kinds.items() for c in columns)
_add("data_dictionary", _PROFILE + f""", e(t, c, k) AS (VALUES {_entries}),
n AS (SELECT 'dim_customer' AS t, count(*) AS n FROM typed UNION ALL SELECT 'dim_segment', count(*) FROM prof),
m AS (SELECT *, k <> 'string' AND c NOT IN ('customerID', 'model_version', 'segment', 'rank', 'rank_within_customer', 'risk_decile') AS measure FROM e)
SELECT t AS table_name, CAST(NULL AS VARCHAR) AS note, n AS row_count, CAST(count(*) OVER (PARTITION BY t) AS INTEGER) AS column_count, c AS column_name, k AS datatype,
  CASE WHEN measure THEN 'measure' ELSE 'dimension' END AS role, CASE WHEN measure THEN 'quantitative' ELSE 'nominal' END AS kind,
  array_to_string(list_transform(string_split(c, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS caption FROM m JOIN n USING (t)""")
_add("aipw_coarse", _CELLS + """, m AS (SELECT InternetService, sum(y_t) / sum(n_t) AS m1, sum(y_c) / sum(n_c) AS m0 FROM sup GROUP BY 1),
j AS (SELECT n_t + n_c AS n, m1 - m0 AS gap, (y_t - n_t * m1) / q - (y_c - n_c * m0) / (1 - q) AS res FROM sup JOIN m USING (InternetService))
SELECT round(sum(n * gap + res) / sum(n), 6) AS aipw_ate, round(sum(res) / sum(n), 6) AS correction FROM j""")
_add("median_filled", _FEAT + """, g AS (SELECT customerID, CASE WHEN tenure % 9 <> 0 THEN TotalCharges END AS t, CASE WHEN tenure % 7 <> 0 THEN MonthlyCharges END AS m FROM feat)
SELECT customerID, round(coalesce(t, (SELECT median(t) FROM g)), 4) AS TotalCharges, round(coalesce(m, (SELECT median(m) FROM g)), 4) AS MonthlyCharges FROM g""")
_add("deployed_explanations",ORACLES["stratified_split"].removeprefix("WITH ").rpartition("SELECT customerID, Churn, CASE")[0]
     + "SELECT customerID, 0.0::DOUBLE AS gap FROM q WHERE rk <= t")


def _run_digits(name, wanted):
    """A digit per run: 1 if the customer is among the first in the run's seeded order."""
    return _OBS + f""", o AS (SELECT customerID, treated, r FROM obs, range(0, 12) t(r)),
k AS (SELECT customerID, r, row_number() OVER (PARTITION BY r ORDER BY md5(customerID || '#' || r || ':{SEED}')) AS rk, {wanted} AS m FROM o)
SELECT customerID, string_agg(CASE WHEN rk <= m THEN '1' ELSE '0' END, '' ORDER BY r) AS {name} FROM k GROUP BY 1"""


_add("placebo_assignment", _run_digits("arms", "sum(treated) OVER (PARTITION BY r)"))
_add("subset_assignment", _run_digits("members", "floor(0.7::DOUBLE * count(*) OVER (PARTITION BY r))"))
ORACLES["registered_designs"] = """WITH o AS (SELECT o_orderpriority AS experiment, o_orderdate::DATE AS day, (o_orderstatus = 'F')::INT AS done FROM orders),
m AS (SELECT experiment, (date_trunc('month', day) + INTERVAL 1 MONTH)::DATE AS registered_at, count(*) AS available_n, sum(done)::BIGINT AS finished FROM o GROUP BY ALL),
f AS (SELECT experiment, min(day) AS first_outcome FROM o WHERE day >= DATE '1997-01-01' GROUP BY 1)
SELECT f.experiment, strftime(f.first_outcome, '%Y-%m-%d') AS first_outcome, strftime(arg_max(m.registered_at, m.registered_at) FILTER (m.registered_at < f.first_outcome), '%Y-%m-%d') AS registered_at,
  arg_max(available_n, m.registered_at) FILTER (m.registered_at < f.first_outcome) AS available_n, arg_max(finished, m.registered_at) FILTER (m.registered_at < f.first_outcome) AS finished,
  count(*) FILTER (m.registered_at >= f.first_outcome) AS refused FROM f LEFT JOIN m USING (experiment) GROUP BY f.experiment, f.first_outcome"""
ORACLES["table_chain"] = ORACLES["churn_by_segment"]
_add("table_loads", _SCORED + """, n AS (SELECT count(*) AS n, count(*) FILTER (p >= 0.5) AS part FROM scored)
SELECT 'replace' AS step, n AS rows FROM n UNION ALL SELECT 'append', part FROM n UNION ALL SELECT 'replace again', part FROM n UNION ALL SELECT 'held', part FROM n""")
ORACLES["published_predictions"] = ORACLES["score_linear"]
_add("report_flatten", _PROFILE + " SELECT segment, customers, share, churn_rate, monthly_revenue FROM prof")
_add("stream_quarantine", _FEAT + """, broken AS (SELECT customerID, TotalCharges IS NULL AS missing, tenure % 11 = 3 AS negative, tenure % 13 = 5 AS senior FROM typed)
SELECT customerID, concat_ws('; ', CASE WHEN missing THEN 'missing TotalCharges' END, CASE WHEN negative THEN 'negative tenure' END,
  CASE WHEN senior THEN 'SeniorCitizen out of range' END) AS problems FROM broken WHERE missing OR negative OR senior""")
_add("stream_score", _SCORED + f""" SELECT customerID, churn_probability, prediction, {_BAND} AS risk_category, 'v1' AS model_version, 'linear_score' AS model_name
  FROM scored WHERE customerID IN (SELECT customerID FROM typed WHERE TotalCharges IS NOT NULL)""")


# reports: every number of the queries they hold, under section, key and column
_REPORTS = {
    "drift": ("numeric", "drift_numeric", ["feature"], ["train_mean", "scoring_mean", "mean_drift_percent", "train_std", "scoring_std", "std_drift_percent", "drifted"]),
    "experiment": ("readout", "fact_experiment", ["run", "metric"], ["treatment", "control", "difference", "p_value", "effect_size", "significant"]),
    "power": ("designs", "verdicts", ["Contract"], ["p_value", "required_n_per_arm", "available_n_per_arm", "adequately_powered", "inflation_caveat", "achieved_power"]),
    "segmentation": ("segments", "segment_profile", ["segment"], None),
    "causal": ("estimates", "fact_causal", ["analysis", "estimator"], ["estimate", "adjusted"]),
    "coefficients": ("terms", "wald_odds", ["feature"], ["coefficient", "std_error", "odds_ratio", "significant", "vif"]),
}


def _report(kind, section, source, key, columns):
    values = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns) if columns else f"CAST(COLUMNS(* EXCLUDE ({', '.join(key)})) AS DOUBLE)"
    path = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in key)
    return f"""SELECT '{kind}' AS report, '{section}.' || k || '.' || name AS path, number FROM (
  UNPIVOT (SELECT {path} AS k, {values} FROM ({ORACLES[source]})) ON COLUMNS(* EXCLUDE (k)) INTO NAME name VALUE number)"""


ORACLES["reports_flat"] = " UNION ALL ".join(_report(kind, *r) for kind, r in _REPORTS.items())
