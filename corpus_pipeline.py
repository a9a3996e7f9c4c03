"""The corpus pipeline: quality, near duplicates, mixture, tokens, stage by stage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.llm import bpe, mixing, quality_rules, simhash, text
from beforeafter.llm.queries import GOOD_SCORE, VOCABULARY, scored, table, token_digests
from beforeafter.staging import delete, run_dir, scope

#: Four of the five stages rest on fitted models, hashes or merges: tests/llm works all five
#: out plainly on the smallest tables and compares the whole of ``run``.
ORACLE_SQL = None


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their nearest labelled neighbours call good; learns from the
    labelled documents of ``sf_dir``."""
    packed = docs.select(F.struct("*").alias("row"), "text")
    return scored(spark, packed, sf_dir).filter(F.col("score") >= GOOD_SCORE).select("row.*")


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the voted rules keep."""
    packed = docs.select(F.struct("*").alias("row"), "text")
    return quality_rules.judge_quality(packed, carry=["row"]).filter("kept").select("row.*")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    packed = docs.select(F.struct("*").alias("row"), "source", "text")
    mixed = mixing.mix(packed, text.word_count(F.col("text")), carry=["row"])
    return mixing.repeated(mixed, ["row"]).select("row.*")


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of their decoding."""
    coded = bpe.round_trip(docs.select("doc_id", "source", "text"), VOCABULARY, public_tokenizers.PATTERN)
    return coded.select("doc_id", "source", *token_digests(), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier_stage),
    ("quality_rules", quality_rules_stage),
    ("near_duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next.

    Once a stage is written, what it read and what it wrote on the way are deleted, so
    the shared folder holds no more than two stages' outputs. The last stage is lazy:
    what it reads stays until ``staging.release``.
    """
    docs = table(spark, sf_dir, "documents")
    root = f"{run_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        with scope(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        if before is not None:
            delete(spark, f"{root}/{before}")
        docs, before = spark.read.parquet(f"{root}/{name}"), name
    return STAGES[-1][1](spark, docs, sf_dir)
