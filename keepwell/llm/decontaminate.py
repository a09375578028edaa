"""Benchmark decontamination as a prefix-filtered set join on word shingles.

An item's windows are its runs of ten words (a shorter item is one window). A
document contains a window only if it contains every shingle of it, so a join on
one necessary shingle finds all candidates: the rarest of the window in the
corpus. Positions bound the candidate (the window must lie inside the document)
and the words themselves confirm it.

Edge cases: a null text or item has no words and no window; empty tables give no
rows or no hits; repeated rows and null ids are judged row by row (a null item_id
takes no part in n_items); other columns are not read. Everything is DataFrame
expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.tables import sized, written

WINDOW = 10
SHINGLE = 3
BREAKS = "[\\x00-/:-`{-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is far cheaper and does the same wherever it leaves the other characters alone."""
    other = F.regexp_replace(text, "[\\x00-\\x7F]+", "")
    return F.when(other == F.lower(other), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def _shingles(words: str, n: int) -> Column:
    """Hashes of every n consecutive words."""
    h = F.transform(words, lambda x, i: F.xxhash64(x, *(F.get(words, i + k) for k in range(1, n))))
    return F.slice(h, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, win): the windows of every item, words joined by a space."""
    items = benchmark.select("item_id", item_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    k = F.least(F.lit(window), F.size("w"))
    items = items.select("item_id", "w", k.alias("k"), F.explode(F.sequence(F.lit(1), F.size("w") - k + 1)).alias("s"))
    return items.select("item_id", F.array_join(F.expr("slice(w, s, k)"), " ").alias("win")).distinct()


def window_shingles(wins: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(win, k, n, offset, h): every shingle of n words of each different window."""
    w = wins.select("win").distinct().withColumn("w", F.split("win", " ")).withColumn("k", F.size("w"))
    parts = [w.where(F.col("k") >= n if n == shingle else F.col("k") == n)
             .select("win", "k", F.lit(n).alias("n"), F.posexplode(_shingles("w", n)).alias("offset", "h"))
             for n in range(1, shingle + 1)]
    return reduce(DataFrame.unionAll, parts)


def postings(words: DataFrame, shingles: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words, pos, n, h): where documents hold a shingle of the benchmark."""
    wanted = written(shingles.select("n", "h").distinct(), "benchmark-shingles")
    parts = []
    for n in sorted(r["n"] for r in wanted.select("n").distinct().collect()):
        keys = sized(wanted.where(F.col("n") == n).select(F.col("h").alias("wanted")), 16)
        at = words.select("doc_id", "text_key", F.size("w").alias("n_words"), F.lit(n).alias("n"), F.posexplode(_shingles("w", n)).alias("pos", "h"))
        parts.append(at.join(keys, F.col("h") == F.col("wanted")).drop("wanted"))
    if not parts:
        return words.select("doc_id", "text_key", F.size("w").alias("n_words"), F.lit(0).alias("n"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("h")).where(F.lit(False))
    return reduce(DataFrame.unionAll, parts)


def necessary(shingles: DataFrame, found: DataFrame) -> DataFrame:
    """(win, k, n, offset, h): the rarest shingle of each window; windows with an absent one can't occur."""
    rarity = found.groupBy("n", "h").agg(F.count("*").alias("freq"))
    ranked = shingles.join(rarity, ["n", "h"], "left").groupBy("win", "k", "n").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "offset", "h")).alias("best"))
    return ranked.where(F.col("best.freq") > 0).select("win", "k", "n", F.col("best.offset").alias("offset"), F.col("best.h").alias("h"))


def contained(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and its text key."""
    words = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    words = words.select("doc_id", F.md5("t").alias("text_key"), item_words(F.col("t")).alias("w"))
    wins = written(windows(benchmark), "benchmark-windows")
    shingles = window_shingles(wins)
    found = written(postings(words, shingles), "benchmark-postings")
    prefix = sized(written(necessary(shingles, found), "benchmark-prefixes"), 96 + F.octet_length("win"))
    start = F.col("pos") - F.col("offset")
    candidates = (found.select("doc_id", "text_key", "n_words", "pos", "n", "h").join(prefix, ["n", "h"])
                  .where((start >= 0) & (start + F.col("k") <= F.col("n_words")))
                  .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
                  .agg(F.array_sort(F.collect_set(F.struct(start.alias("start"), "k", "win"))).alias("c")))
    c = written(candidates, "benchmark-candidates")
    c = sized(c, 96 + F.aggregate("c", F.lit(0), lambda n, x: n + 48 + F.octet_length(x["win"])))
    seen = words.join(c, words["doc_id"].eqNullSafe(c["_id"]) & (words["text_key"] == c["_key"]), "left").select(
        "doc_id", "text_key", F.size("w").cast("long").alias("n_words"),
        F.filter("c", lambda x: F.array_join(F.slice("w", x["start"] + 1, x["k"]), " ") == x["win"]).alias("c"))
    seen = written(seen, "benchmark-hits")
    union = F.aggregate(
        "c", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["start"] + x["k"]).alias("end"),
                              (a["n"] + F.greatest(F.lit(0), x["start"] + x["k"] - F.greatest(a["end"], x["start"]))).alias("n")),
        lambda a: a["n"])
    items = (seen.select("doc_id", "text_key", F.explode(F.array_distinct(F.transform("c", lambda x: x["win"]))).alias("win"))
             .join(wins, "win").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
             .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    out = seen.join(items, seen["doc_id"].eqNullSafe(items["_id"]) & (seen["text_key"] == items["_key"]), "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(union, F.lit(0)).cast("long")
    return out.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a benchmark window; the columns of the input."""
    bad = contained(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    key = F.md5(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (key == bad["_key"]), "left_anti").select(*(docs[c] for c in docs.columns))
