"""Quality rules: per-document counts, and line frequency across the documents of a host.

Lines are normalised (ASCII white space collapsed, lower case) and hashed. A
line is above the limits if at least ``min_docs`` distinct texts of its host
hold it and these are more than ``share_pct`` percent of the host's texts. Such
lines go from every document but the first of the host (smallest doc_id) that
holds them. A document is depleted if fewer than ``min_words`` words remain, or
at most half of its words. Exact copies count as one text, so that a copied
document isn't taken for boilerplate.

Edge cases: a null text is empty (no words, base_failed); a null source is a
host of its own; rows with a null or repeated doc_id are judged row by row, a
null id is never "first" but where no other document holds the line; other
columns are not read. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.tables import sized, text_key, written

MIN_DOCS = 20
SHARE_PCT = 5
MIN_WORDS = 50
SPACE = "[ \\t-\\r]+"
SOLID = "[^ \\t-\\r]"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, text key and the contract's counts, without any shuffle."""
    d = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("*", _words(F.col("t")).alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(SOLID)).alias("lines"))
    d = d.select(
        "doc_id", "source", F.md5("t").alias("text_key"), F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.slice(F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))),
                F.lit(1), F.greatest(F.size("w") - 2, F.lit(0))).alias("tri"))
    d = d.withColumn("pairs", F.when(
        F.size(F.array_distinct("tri")) < F.size("tri"),
        F.array_sort(F.transform("tri", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    at = lambda j: F.get("pairs", j)["h"]
    d = d.withColumn("hit", F.array_sort(F.transform(
        F.filter("pairs", lambda p, j: p["h"].eqNullSafe(at(j - 1)) | p["h"].eqNullSafe(at(j + 1))), lambda p: p["i"])))
    covered = F.aggregate(
        "hit", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.select("doc_id", "source", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"))


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, SPACE, " "))))


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, share_pct: int = SHARE_PCT) -> DataFrame:
    """(source, line, first): lines above the limits and the first document that holds each."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(SOLID))
    texts = docs.groupBy("source", text_key(F.col("text")).alias("text_key")).agg(
        F.min("doc_id").alias("doc_id"), F.first(F.array_distinct(F.transform(lines, _line_hash))).alias("lines"))
    texts = written(texts, "host-lines")
    hosts = texts.groupBy(F.col("source").alias("host")).agg(F.count("*").alias("texts"))
    counted = (texts.select("source", "doc_id", F.explode("lines").alias("line")).groupBy("source", "line")
               .agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where(F.col("n") >= min_docs))
    return written(counted.join(hosts, F.col("source").eqNullSafe(F.col("host")))
                   .where(F.col("n") * 100 > share_pct * F.col("texts")).select("source", "line", "first"), "frequent-lines")


def removed_lines(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """(doc_id, text_key, lines to remove, words in them) of documents that lose any."""
    d = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("doc_id", "source", F.md5("t").alias("text_key"), F.posexplode(F.split("t", "\n")).alias("at", "content"))
    d = d.where(F.col("content").rlike(SOLID)).select(
        "doc_id", "source", "text_key", "at", _line_hash(F.col("content")).alias("line"), F.size(_words(F.col("content"))).alias("n"))
    f = sized(frequent.select(F.col("source").alias("host"), F.col("line").alias("above"), "first"), 64)
    hit = d.join(f, F.col("source").eqNullSafe(F.col("host")) & (F.col("line") == F.col("above"))
                 & ~F.col("doc_id").eqNullSafe(F.col("first")))
    # a row that stands twice in the input gives each of its lines twice
    return hit.groupBy("doc_id", "source", "text_key", "at").agg(F.first("n").alias("n")).groupBy("doc_id", "source", "text_key").agg(
        F.collect_list("at").alias("lines"), F.sum("n").alias("lost"))


def quality(docs: DataFrame, min_docs: int = MIN_DOCS, share_pct: int = SHARE_PCT) -> DataFrame:
    """One row per document: counts, base_failed, lost words, lines to remove and the verdict."""
    lost = removed_lines(docs, frequent_lines(docs, min_docs, share_pct)).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_host"), F.col("text_key").alias("_key"), "lines", "lost")
    base = base_counts(docs)
    out = base.join(lost, base["doc_id"].eqNullSafe(lost["_id"]) & base["source"].eqNullSafe(lost["_host"])
                    & (base["text_key"] == lost["_key"]), "left").drop("_id", "_host", "_key")
    out = out.withColumn("n_lost_words", F.coalesce("lost", F.lit(0)).cast("long")).drop("lost")
    left = F.col("n_words") - F.col("n_lost_words")
    return out.withColumn("kept", ~F.col("base_failed") & (left >= MIN_WORDS) & (2 * left > F.col("n_words")))


def apply_quality(docs: DataFrame) -> DataFrame:
    """Kept documents without their removed lines; the columns of the input."""
    # written first: a filter pushed into the counts would evaluate them inside their own lambdas
    q = written(quality(docs), "quality").where("kept").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_host"), F.col("text_key").alias("_key"), F.col("lines").alias("_lines")).distinct()
    d = docs.join(q, docs["doc_id"].eqNullSafe(q["_id"]) & docs["source"].eqNullSafe(q["_host"])
                  & (text_key(docs["text"]) == q["_key"]))
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(q["_lines"], i)), "\n")
    text = F.when(q["_lines"].isNull(), F.col("text")).otherwise(rest)
    new = {"text": text} | ({"n_chars": F.length(text).cast("long")} if "n_chars" in docs.columns else {})
    return d.select(*(new[c].alias(c) if c in new else docs[c] for c in docs.columns))
