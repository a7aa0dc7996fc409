"""The corpus pipeline: quality rules, near-dedup, decontamination, PII, BPE.

Each stage takes the documents its predecessor kept and returns documents, the last one digests
of their tokens. Stages are written and read again by whoever runs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gablework.llm import bpe, decontaminate, near_dup, pii, quality
from gablework.llm.queries import TRIAL_KEY, word_bpe
from gablework.llm.shipping import ship
from gablework.sources.scratch import materialize
from gablework.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failing lines of the others go."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that with the least id."""
    ship(spark)
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets get pseudonyms; no document goes."""
    ship(spark)
    return pii.replace_in(docs, TRIAL_KEY)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    ship(spark)
    return bpe.digest(docs, word_bpe())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("tokens", tokens),
]

# Sampling, permutations and merges have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
