"""Ranks without a single-task window.

Seeded orders use md5 of key and seed, so they do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

SLOT_DIGITS = 3
#: Distinct values of a slab, and slabs of a group.
SLAB_VALUES, GROUP = 200_000, 512


def seeded_hash(key: str | Column, seed) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def unit_interval(key: str | Column, seed) -> Column:
    """Uniform number in [0, 1) from the first eight hex digits of the hash."""
    head = F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10)
    return head.cast("double") / F.lit(float(2 ** 32))


def hash_rank(df: DataFrame, key: str, seed, strata: Sequence[str] = (),
              digits: int = SLOT_DIGITS) -> DataFrame:
    """1-based rank in seeded order within each stratum, plus stratum size.

    Adds ``hash_rank`` and ``stratum_size``. A stratum may hold any share of
    the rows: the hash prefix splits it into 16**digits even slots, ranks are
    taken inside a slot and shifted by the counts of the slots before it. The
    shifts join on the same (stratum, slot) key the window needs, so rows move
    once; no broadcast is forced, because strata may be many. A row whose key is
    NULL takes part with the hash of its seed.
    """
    strata = list(strata)
    slotted = (df.withColumn("_h", seeded_hash(key, seed))
               .withColumn("_slot", F.substring("_h", 1, digits)))
    per_slot = slotted.groupBy(*strata, "_slot").agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(*strata)
    before = whole.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_slot.select(
        *[F.col(s).alias(f"_stratum_{i}") for i, s in enumerate(strata)], F.col("_slot").alias("_at"),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_shift"),
        F.sum("_c").over(whole).alias("stratum_size"))
    inside = Window.partitionBy(*strata, "_slot").orderBy("_h", key)
    # a NULL stratum is a stratum like any other
    same = [F.col(s).eqNullSafe(F.col(f"_stratum_{i}")) for i, s in enumerate(strata)]
    return (
        slotted.join(shifts, reduce(and_, same, F.col("_slot").eqNullSafe(F.col("_at"))))
        .withColumn("hash_rank", F.col("_shift") + F.row_number().over(inside))
        .drop("_h", "_slot", "_shift", "_at", *[f"_stratum_{i}" for i in range(len(strata))])
    )


class SharedHash(Exception):
    """A cut falls between rows of one hash, which only a rank can tell apart."""


#: Hex digits that one round of the selection fixes.
SELECT_DIGITS = 3


def _stratum(strata: Sequence[str]) -> Column:
    return F.to_json(F.struct(*strata)) if strata else F.lit("")


class Cuts:
    """For each stratum and hash, the limits below which the wanted numbers of rows lie."""

    def __init__(self, strata: Sequence[str], limits: dict[tuple[str, int], list[str]]):
        self.strata, self.limits = list(strata), limits

    def below(self, hashed: Column, which: int = 0, slot: int = 0) -> Column:
        """Whether a row is among the wanted ones."""
        found = {s: limits[slot] for (s, i), limits in self.limits.items() if i == which}
        if not found:
            return F.lit(False)
        table = F.create_map(*[F.lit(v) for pair in found.items() for v in pair])
        return hashed < F.try_element_at(table, _stratum(self.strata))


def hash_cuts(df: DataFrame, hashes: Sequence[Column], wanted: Callable[[int], Sequence[int]], strata: Sequence[str] = ()) -> Cuts:
    """Radix selection of the m-th smallest hash, for all strata, hashes and m at once.

    ``wanted`` gives the numbers of rows to lie below the limits from the size
    of a stratum. Each round counts three more hex digits of the hashes that share a
    prefix with an open limit: counts are summed in the tasks, rows never move,
    and four rounds reach 10**12 rows. Strata are few. Raises SharedHash if a limit
    would split rows of equal hash.
    """
    slim = df.select(_stratum(strata).alias("s"), F.posexplode(F.array(*hashes)).alias("i", "h"))
    sizes = {r["s"]: r["count"] for r in df.select(_stratum(strata).alias("s")).groupBy("s").count().collect()}      # a row per stratum
    limits = {(s, i): [""] * len(wanted(n)) for s, n in sizes.items() for i in range(len(hashes))}
    open_cuts: dict[tuple, list] = {}
    for s, n in sizes.items():
        for slot, m in enumerate(wanted(n)):
            for i in range(len(hashes)):
                if m >= n:
                    limits[s, i][slot] = "g"              # above any digit
                elif m > 0:
                    open_cuts.setdefault((s, i, ""), []).append((slot, int(m)))
    depth = 0
    while open_cuts:
        rows = slim
        if depth:
            # a row per open limit at most
            held = df.sparkSession.createDataFrame(list(open_cuts), "s string, i int, prefix string")
            rows = slim.withColumn("prefix", F.substring("h", 1, depth)).join(F.broadcast(held), ["s", "i", "prefix"])
        depth += SELECT_DIGITS
        counts: dict[tuple, list] = {}
        for r in rows.groupBy("s", "i", F.substring("h", 1, depth).alias("p")).count().collect():
            counts.setdefault((r["s"], r["i"], r["p"][:depth - SELECT_DIGITS]), []).append((r["p"], r["count"]))
        following: dict[tuple, list] = {}
        for (s, i, prefix), cuts in open_cuts.items():
            buckets = sorted(counts[s, i, prefix])
            for slot, m in cuts:
                for p, n in buckets:
                    if m <= n:
                        break
                    m -= n
                if m == n:
                    limits[s, i][slot] = p + "g"
                elif len(p) < depth:
                    raise SharedHash
                else:
                    following.setdefault((s, i, p), []).append((slot, m))
        open_cuts = following
    return Cuts(strata, limits)


def flag_half(df: DataFrame, key: str, seed, name: str, strata: Sequence[str] = ()) -> DataFrame:
    """Adds ``name``: true for the first half (rounded down) of each stratum in seeded order.

    Rows are flagged where they lie; only if keys repeat at a cut are they ranked.
    """
    try:
        cuts = hash_cuts(df, [seeded_hash(key, seed)], lambda n: [n // 2], strata)
    except SharedHash:
        ranked = hash_rank(df, key, seed, strata)
        return ranked.withColumn(name, F.col("hash_rank") <= F.floor(F.col("stratum_size") / 2)).drop("hash_rank", "stratum_size")
    return df.withColumn(name, cuts.below(seeded_hash(key, seed)))


def cumulative_by_value(df: DataFrame, value: str, sums: Mapping[str, Column],
                        slab_values: int = SLAB_VALUES) -> DataFrame:
    """Per distinct value: each sum at that value and over all smaller values.

    ``<name>`` and ``<name>_below`` are exact running totals. Rows collapse to
    distinct values first, so a very common value costs one row. The values are
    then dealt by range into as many slabs as their number needs, slabs are
    scanned in parallel, and slab totals are scanned in two levels: inside groups of
    GROUP slabs, and over the groups.
    """
    distinct = df.filter(F.col(value).isNotNull()).groupBy(value).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()]).persist()
    slabs = max(1, -(-distinct.count() // slab_values))
    slabbed = distinct.repartitionByRange(slabs, value).withColumn("_slab", F.spark_partition_id()) if slabs > 1 else distinct.withColumn("_slab", F.lit(0))
    slabbed = slabbed.persist()
    totals = slabbed.groupBy("_slab").agg(*[F.sum(n).alias(n) for n in sums]).withColumn("_group", F.floor(F.col("_slab") / GROUP))
    groups = totals.groupBy("_group").agg(*[F.sum(n).alias(n) for n in sums])             # slabs / GROUP rows
    over, inside = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (Window.orderBy("_group"), Window.partitionBy("_group").orderBy("_slab")))
    earlier = groups.select("_group", *[F.coalesce(F.sum(n).over(over), F.lit(0)).alias(f"_g{n}") for n in sums])
    offsets = totals.join(earlier, "_group").select(
        "_slab", *[(F.col(f"_g{n}") + F.coalesce(F.sum(n).over(inside), F.lit(0))).alias(f"_{n}") for n in sums])
    within = Window.partitionBy("_slab").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        slabbed.join(F.broadcast(offsets), "_slab")             # a row per slab; never the values
        .select(value, *sums, *[
            (F.col(f"_{n}") + F.coalesce(F.sum(n).over(within), F.lit(0))).alias(f"{n}_below")
            for n in sums])
    )


def average_ranks(df: DataFrame, value: str, rank: str, weight: Column | None = None) -> DataFrame:
    """Tie-averaged 1-based rank per distinct value."""
    n = F.lit(1) if weight is None else weight
    table = cumulative_by_value(df, value, {"n": n})
    return table.select(value, (F.col("n_below") + (F.col("n") + 1) / 2).alias(rank))
