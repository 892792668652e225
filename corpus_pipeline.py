"""The corpus pipeline: each stage takes what the one before it kept.

A stage is a function of (spark, docs, sf_dir). All but the last return the
columns of ``docs``; the last returns token counts and hashes. Missing texts are
empty throughout.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from odflux.llm import bpe, jaccard_join, mixing, pii, quality
from odflux.llm.place import stored
from odflux.llm.queries import TOKENIZER, table

# No source is used more than this often, and the one used least is used once and whole: no document is lost here.
MOST_USES = 1.25


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the line field is fitted on labelled documents."""
    return quality.keep_good(docs, quality.train_field(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return jaccard_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    return pii.mask_texts(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the weight of their source; one comes once for every epoch that uses it."""
    return mixing.mixed_documents(docs, mixing.Target(repetition=MOST_USES))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of ids and decoded text."""
    return bpe.digests(bpe.round_trip(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mix_sources),
    ("byte-pair encoding", encode),
]

# Trained fields, shingle joins and byte-pair merges are not expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
