"""A corpus from documents to training sequences, in five stages.

Each stage reads what the one before has kept, and is written as Parquet before the next begins. It
belongs to the subpackage msgmart.llm.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from msgmart.llm import exact, jaccard, langid, packing, pii
from msgmart.llm.scratch import Scratch


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones have; others go."""
    model = langid.train(docs.where(~langid.held_out()).select("doc_id", "text", "lang"))
    return langid.keep_identified(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group that links of five-word similarity of 0.8 or more connect."""
    return jaccard.keep_first(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with placeholders for personal data and the terms that give it away."""
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", sanitise),
    ("best-fit packing", pack),
]

#: Language likelihoods, MinHash and packing are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
