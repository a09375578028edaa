"""One-to-one nearest-neighbour matching on a score line, without replacement.

Treated units are served from the highest score down; each takes the nearest
unused control within the caliper. No pair candidates are generated: units
with equal scores are interchangeable for the choice, so the line is first
collapsed to (score, treated count, control count), and one descending scan
with a stack of unused controls decides how many units of one score go to
another. Scores are cut into slabs that are scanned in parallel; what one slab
leaves over (unserved treated, unused controls within reach) is handed to the
next, and the scan repeats until nothing handed over changes. The result does
not depend on the number of slabs. A hand-over holds counts per distinct score
within one caliper, never rows.
"""

from __future__ import annotations

import pickle
from collections import deque
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from keepwell.operators.ranking import hash_rank
from keepwell.session import checkpoint_ready

# --- fixed values ------------------------------------------------------------
CALIPER_SD = 0.2
# --- end of fixed values ----------------------------------------------------

SLAB_SCORES = 200_000
FLOW_PIECE = 100_000
_FLOW = "t_score double, t_from long, c_score double, c_from long, n long"


def sweep(scores, n_treated, n_control, caliper: float, handed=None, last: bool = True):
    """Serve one slab of descending distinct scores.

    ``handed`` is what the slab above left over. Returns the flows
    ``(t_score, t_from, c_score, c_from, n)`` and what is left for the slab
    below (``last`` serves everyone who still waits).
    """
    waiting, unused = handed if handed else ((), ())
    waiting, unused = deque(map(list, waiting)), deque(map(list, unused))
    flows = []

    def give(t, c, n):
        flows.append((t[0], t[1], c[0], c[1], n))
        t[1] += n
        t[2] -= n
        c[1] += n
        c[2] -= n

    def serve_first(below):
        """Serve the head of the queue from above or from ``below``."""
        t = waiting[0]
        up = unused[-1] if unused else None
        up_gap = up[0] - t[0] if up else None
        down_gap = t[0] - below[0] if below else None
        if up and up_gap <= caliper and (down_gap is None or up_gap <= down_gap):
            give(t, up, min(t[2], up[2]))
            if not up[2]:
                unused.pop()
        elif down_gap is not None and down_gap <= caliper:
            give(t, below, min(t[2], below[2]))
        else:
            t[2] = 0
        if not t[2]:
            waiting.popleft()

    for score, nt, nc in zip(scores, n_treated, n_control):
        while waiting and waiting[0][0] - score > caliper:
            serve_first(None)
        here = [score, 1, int(nc)]
        while waiting and here[2]:
            serve_first(here)
        mine = [score, 1, int(nt)]
        if mine[2] and here[2]:
            give(mine, here, min(mine[2], here[2]))
        if mine[2]:
            waiting.append(mine)
        if here[2]:
            unused.append(here)
        lowest_need = waiting[0][0] if waiting else score
        while unused and unused[0][0] - lowest_need > caliper:
            unused.popleft()
    if last:
        while waiting:
            serve_first(None)
    return flows, (tuple(map(tuple, waiting)), tuple(map(tuple, unused)))


def match_flows(units: DataFrame, score: str, treated: str, caliper: float,
                slab_scores: int = SLAB_SCORES) -> DataFrame:
    """How many units of each treated score go to which control score."""
    line = units.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(treated) == 1).alias("n_t"), F.count_if(F.col(treated) == 0).alias("n_c"))
    return flows_on_line(line, caliper, slab_scores)


def _slabbed(rows: DataFrame, most_scores: int, slab_scores: int) -> tuple[DataFrame, int]:
    """Adds ``slab``, 0 for the highest scores; all lines share the limits."""
    slabs = max(1, -(-most_scores // slab_scores))
    if slabs == 1:
        return rows.withColumn("slab", F.lit(0)), 1
    cuts = sorted(set(rows.agg(F.percentile_approx("score", [i / slabs for i in range(1, slabs)], 20 * slabs)).first()[0]), reverse=True)
    edges = F.array(*[F.lit(float(c)) for c in cuts])
    return rows.withColumn("slab", F.size(F.filter(edges, lambda e: e > F.col("score")))), len(cuts) + 1


def _handed_on(rows: DataFrame, where: list[str], kinds: str, slabs: int, message) -> DataFrame:
    """What every slab gets from the slab above, when nothing changes any more.

    A message is one row keyed by its slab. A slab is swept again only if its message
    is new, another or gone; as leftovers fade within a caliper or two, later
    rounds touch few slabs. There are at most ``slabs`` rounds.
    """
    kind = f"{kinds}, handed binary"
    handed = rows.sparkSession.createDataFrame([], kind)
    changed = rows.select(*where).distinct()
    for _ in range(slabs - 1):
        again = rows.join(changed, where, "left_semi").groupBy(*where).cogroup(handed.join(changed, where, "left_semi").groupBy(*where))
        fresh = again.applyInPandas(message, kind).checkpoint()
        below = changed.withColumn("slab", F.col("slab") + 1)
        old = handed.join(below, where, "left_semi")
        differs = fresh.join(old, [*where, "handed"], "left_anti").select(*where).unionByName(old.join(fresh, where, "left_anti").select(*where)).checkpoint()
        handed = handed.join(below, where, "left_anti").unionByName(fresh).checkpoint()
        changed = differs
        if differs.isEmpty():
            break
    return handed


def flows_on_line(line: DataFrame, caliper: float, slab_scores: int = SLAB_SCORES) -> DataFrame:
    """Flows for a collapsed line ``(score, n_t, n_c)``."""
    checkpoint_ready(line.sparkSession)
    line = line.checkpoint()
    line, slabs = _slabbed(line, line.count(), slab_scores)

    def swept(key, rows, handed):
        rows = rows.sort_values("score", ascending=False)
        got = pickle.loads(handed["handed"].iloc[0]) if len(handed) else None
        return sweep(rows["score"].tolist(), rows["n_t"].tolist(), rows["n_c"].tolist(), caliper, got, int(key[0]) == slabs - 1)

    def message(key, rows, handed):
        _, left = swept(key, rows, handed)
        some = (left[0] or left[1]) and int(key[0]) < slabs - 1
        return pd.DataFrame([[int(key[0]) + 1, pickle.dumps(left)]] if some else [], columns=["slab", "handed"])

    def flows(key, rows, handed):
        return pd.DataFrame(swept(key, rows, handed)[0], columns=["t_score", "t_from", "c_score", "c_from", "n"])

    handed = _handed_on(line, ["slab"], "slab int", slabs, message)
    return line.groupBy("slab").cogroup(handed.groupBy("slab")).applyInPandas(flows, _FLOW).checkpoint()


def lines_att(lines: DataFrame, by: Sequence[str], caliper_sd: float = CALIPER_SD,
              slab_scores: int = SLAB_SCORES) -> DataFrame:
    """Matched effect of many collapsed lines at once: (by..., n_pairs, matching_att).

    ``lines`` has (by..., score, n_t, n_c, y_t, y_c); ``by`` numbers the line and has few
    values. Units of one score count with their mean outcome. Each line is cut
    into slabs. What a slab leaves over travels as one row to the slab below,
    with the mean outcomes of the scores in it, and only slabs whose message
    changed are swept again. A line without pairs has a NULL effect.
    """
    spark, by = lines.sparkSession, list(by)
    checkpoint_ready(spark)
    merged = lines.groupBy(*by, "score").agg(*[F.sum(c).cast("double").alias(c) for c in ("n_t", "n_c", "y_t", "y_c")]).checkpoint()
    size = F.col("n_t") + F.col("n_c")
    stats = merged.groupBy(*by).agg(F.sum(size).alias("n"), F.sum(size * F.col("score")).alias("s"), F.count(F.lit(1)).alias("scores")).collect()
    means = {tuple(r[b] for b in by): r["s"] / r["n"] for r in stats}
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in merged.schema if f.name in by)
    if not stats:
        return spark.createDataFrame([], f"{kinds}, n_pairs double, matching_att double")
    centre = F.broadcast(spark.createDataFrame([(*k, float(m)) for k, m in means.items()], f"{kinds}, mean double"))   # a row per line
    gap = F.col("score") - F.col("mean")
    spread = merged.join(centre, by).groupBy(*by).agg((F.sum(size * gap * gap) / F.sum(size)).alias("v")).collect()
    caliper = {tuple(r[b] for b in by): caliper_sd * float(r["v"]) ** 0.5 for r in spread}

    merged, slabs = _slabbed(merged, max(r["scores"] for r in stats), slab_scores)
    where = [*by, "slab"]

    def swept(key, rows, handed):
        rows = rows.sort_values("score", ascending=False)
        left, rates = pickle.loads(handed["handed"].iloc[0]) if len(handed) else (None, {})
        rates = {**rates, **{("t", s): y / n for s, y, n in zip(rows["score"], rows["y_t"], rows["n_t"]) if n},
                 **{("c", s): y / n for s, y, n in zip(rows["score"], rows["y_c"], rows["n_c"]) if n}}
        flows, left = sweep(rows["score"].tolist(), rows["n_t"].tolist(), rows["n_c"].tolist(), caliper[tuple(key[:-1])], left, key[-1] == slabs - 1)
        known = {k: rates[k] for k in [*(("t", t[0]) for t in left[0]), *(("c", c[0]) for c in left[1])]}
        return flows, rates, (left, known) if left[0] or left[1] else None

    def message(key, rows, handed):
        _, _, left = swept(key, rows, handed)
        return pd.DataFrame([[*key[:-1], key[-1] + 1, pickle.dumps(left)]] if left and key[-1] < slabs - 1 else [], columns=[*where, "handed"])

    def effect(key, rows, handed):
        flows, rates, _ = swept(key, rows, handed)
        return pd.DataFrame([[*key[:-1], float(sum(f[4] for f in flows)), float(sum(f[4] * (rates["t", f[0]] - rates["c", f[2]]) for f in flows))]], columns=[*by, "n", "gap"])

    handed = _handed_on(merged, where, f"{kinds}, slab int", slabs, message)
    parts = merged.groupBy(*where).cogroup(handed.groupBy(*where)).applyInPandas(effect, f"{kinds}, n double, gap double")
    return parts.groupBy(*by).agg(F.sum("n").alias("n_pairs"), F.try_divide(F.sum("gap"), F.sum("n")).alias("matching_att"))


def att_on_line(line: DataFrame, caliper_sd: float = CALIPER_SD,
                slab_scores: int = SLAB_SCORES) -> DataFrame:
    """Matched effect from a collapsed line ``(score, n_t, n_c, y_t, y_c)``."""
    return lines_att(line.withColumn("line", F.lit(0)), ["line"], caliper_sd, slab_scores).select("n_pairs", "matching_att")


def caliper_width(units: DataFrame, score: str, caliper_sd: float = CALIPER_SD) -> float:
    row = units.agg(F.stddev_pop(score).alias("sd")).first()
    return caliper_sd * float(row["sd"] or 0.0)


def match_pairs(units: DataFrame, key: str, score: str, treated: str, caliper: float | None = None,
                carry=(), seed=0, slab_scores: int = SLAB_SCORES) -> DataFrame:
    """(treated_id, control_id, distance) plus ``t_``/``c_`` carried columns.

    Among units of equal score the seeded hash order decides who is taken.
    Flows expand to one row per pair and meet their units on unique
    (score, rank) keys, so no key is hot in the joins.
    """
    if caliper is None:
        caliper = caliper_width(units, score)
    flows = match_flows(units, score, treated, caliper, slab_scores)
    pieces = (
        flows.withColumn("_skip", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(FLOW_PIECE))))
        .withColumn("_take", F.least(F.col("n") - F.col("_skip"), F.lit(FLOW_PIECE)))
        .repartition(F.col("t_score"), F.col("t_from"), F.col("_skip"))
        .withColumn("_i", F.explode(F.sequence(F.col("_skip"), F.col("_skip") + F.col("_take") - 1)))
        .select("t_score", (F.col("t_from") + F.col("_i")).alias("t_rank"),
                "c_score", (F.col("c_from") + F.col("_i")).alias("c_rank")))
    slim = units.select(F.col(key).alias("_id"), F.col(score).alias("_score"),
                        F.col(treated).alias("_arm"), *carry)
    ranked = hash_rank(slim, "_id", seed, ["_score", "_arm"], digits=2)

    def side(arm, prefix, name):
        return ranked.filter(F.col("_arm") == arm).select(
            F.col("_id").alias(name), F.col("_score").alias(f"{prefix}_score"),
            F.col("hash_rank").alias(f"{prefix}_rank"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in carry])

    out = (pieces.join(side(1, "t", "treated_id"), ["t_score", "t_rank"])
           .join(side(0, "c", "control_id"), ["c_score", "c_rank"]))
    return out.select("treated_id", "control_id",
                      F.abs(F.col("t_score") - F.col("c_score")).alias("distance"),
                      *[f"t_{c}" for c in carry], *[f"c_{c}" for c in carry])


def att(pairs: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Mean outcome gap of the pairs with both matched rates."""
    t, c = F.col(f"t_{outcome}").cast("double"), F.col(f"c_{outcome}").cast("double")
    return pairs.agg(F.count("*").alias("n_pairs"), F.avg(t - c).alias("att"),
                     F.avg(t).alias("treated_rate"), F.avg(c).alias("control_rate"))


def outcome_from_pairs(pairs: DataFrame, units: DataFrame, key: str, outcome: str) -> DataFrame:
    """Look both members of each pair up in the unit table."""
    one = units.select(F.col(key).alias("treated_id"), F.col(outcome).alias(f"t_{outcome}"))
    two = units.select(F.col(key).alias("control_id"), F.col(outcome).alias(f"c_{outcome}"))
    return pairs.join(one, "treated_id").join(two, "control_id")


def match_info(units: DataFrame, pairs: DataFrame, treated: str, caliper: float) -> DataFrame:
    n_t = units.agg(F.count_if(F.col(treated) == 1).alias("n_treated"))
    return n_t.join(pairs.agg(F.count("*").alias("n_matched_pairs"))).select(
        F.lit(caliper).alias("caliper_logit"), "n_treated", "n_matched_pairs",
        (F.col("n_treated") - F.col("n_matched_pairs")).alias("n_unmatched_treated"),
        F.try_divide("n_matched_pairs", "n_treated").alias("match_rate"))
