"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.llm import bpe, dac, oracle
from keepwell.llm.burst_trie import trie
from keepwell.llm.decontaminate import contained
from keepwell.llm.html_text import extract
from keepwell.llm.minhash import near_duplicates
from keepwell.llm.quality import quality
from keepwell.llm.resharding import resharded
from keepwell.llm.secrets import scan
from keepwell.llm.simplex import clustered
from keepwell.llm.substrings import without_repeats
from keepwell.llm.tables import read
from keepwell.llm.toxicity import toxicity
from keepwell.llm.warc import through_archives


def op1_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return quality(read(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lost_words", "kept")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contained(read(spark, folder, "documents"), read(spark, folder, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents"))


def op10_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(read(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_merge_replay(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_addressable_ids(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return dac.through_files(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_zstd_warc(spark: SparkSession, folder: str) -> DataFrame:
    return through_archives(read(spark, folder, "pages"))


def op7_tree_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return extract(read(spark, folder, "pages"))


def op8_nearest_examples(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op2_markov_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(read(spark, folder, "documents"))
    base = F.filter("found", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), count("random"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed("found").alias("spans"))


def op11_nsimplex_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    return clustered(read(spark, folder, "embeddings"))


def op12_flow_resharding(spark: SparkSession, folder: str) -> DataFrame:
    return resharded(read(spark, folder, "documents"))


def op13_burst_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie(read(spark, folder, "conversations"))


QUERIES = {"op2_markov_secrets": op2_markov_secrets, "op8_nearest_examples": op8_nearest_examples, "op4_zstd_warc": op4_zstd_warc, "op7_tree_scoring": op7_tree_scoring, "op3_merge_replay": op3_merge_replay, "op9_addressable_ids": op9_addressable_ids, "op10_repeated_passages": op10_repeated_passages, "op6_bbit_minhash": op6_bbit_minhash, "op1_line_frequency": op1_line_frequency, "op5_decontamination": op5_decontamination,
           "op11_nsimplex_kmeans": op11_nsimplex_kmeans, "op12_flow_resharding": op12_flow_resharding, "op13_burst_trie": op13_burst_trie}
ORACLES = {"op4_zstd_warc": oracle.WARC, "op10_repeated_passages": oracle.REPEATED_PASSAGES, "op6_bbit_minhash": oracle.NEAR_DUPLICATES, "op1_line_frequency": oracle.QUALITY, "op5_decontamination": oracle.DECONTAMINATION,
           "op11_nsimplex_kmeans": oracle.CENTROIDS, "op13_burst_trie": oracle.PREFIX_TRIE}
