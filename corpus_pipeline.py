"""Corpus preparation from documents to token ids, one operator a stage."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keepwell.llm import bpe
from keepwell.llm.decontaminate import drop_contaminated
from keepwell.llm.minhash import keep_one
from keepwell.llm.quality import apply_quality
from keepwell.llm.secrets import mask_secrets
from keepwell.llm.tables import read, written
from keepwell.session import ship_package

#: Words of a shingle in the near-duplicate stage; the similarity is the operator's 0.8.
SHINGLE = 5


def _stage(function):
    """A stage whose Python code is on all executors."""
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, docs, sf_dir)
    return run


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines of a host go from the others."""
    return apply_quality(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return keep_one(docs, SHINGLE)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


@_stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return mask_secrets(docs)


@_stage
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scan", secrets),
    ("byte-level BPE", encoding),
]

#: MinHash, masking and byte-pair encoding have no SQL; a test compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
