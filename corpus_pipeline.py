"""A training corpus from raw documents, in four stages.

Each stage is a function (spark, docs, sf_dir) over all that the stage before
kept; ``run`` writes every stage's result to the shared folder and reads it
again for the next one, so a lost executor costs at most a stage's re-read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import prob_minhash, rule_ensemble, toxicity, vector_packing
from tripmart.llm.common import materialize
from tripmart.llm.queries import QUALITY_FROM, TOXIC_FROM, learned_labels
from tripmart.sources.adapter import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = toxicity.fit(docs, learned_labels(table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.keep_below(docs, model, TOXIC_FROM)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble takes for good ones."""
    model = rule_ensemble.fit_on(docs, learned_labels(table(spark, sf_dir, "labels"), "quality"))
    return rule_ensemble.keep_from(docs, model, QUALITY_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return prob_minhash.keep_one(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 1024."""
    pieces = vector_packing.tokenised_pieces(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return vector_packing.pack(spark, pieces).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", drop_toxic), ("quality", keep_good), ("near_copies", drop_near_copies), ("packing", pack)]

#: Models, sketches and tokenizers are beyond SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
