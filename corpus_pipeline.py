"""Cleaning and packing a corpus of documents, stage by stage.

A stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the
columns of ``documents``. Every stage works on all rows its predecessor kept.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from usagelens.llm import exact_dedup, ngram_join, packing, pii, quality
from usagelens.llm.common import WORD_BPE, table
from usagelens.storage import materialize

# Real data need a key of their own, kept secret.
DEMO_KEY = b"corpus pipeline"


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below one half go."""
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, weights, threshold=0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the one with the smallest id stays."""
    return exact_dedup.drop_exact_duplicates(docs, keep="smallest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, one of a group stays."""
    return ngram_join.drop_near_duplicates(docs, words=5, percent=80)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become pseudonyms of the same format."""
    return pii.with_pseudonyms(docs, DEMO_KEY)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document cut and placed in sequences of 2048 tokens, with its ids."""
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), capacity=2048)


STAGES = [
    ("quality classifier", reject_poor),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("personal data", replace_personal_data),
    ("packing", pack_sequences),
]

# Learned scores, keyed pseudonyms and token ids have no SQL form; the tests hold
# ``run`` against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``: all stages in order, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    *earlier, (_, last) = STAGES
    for name, stage in earlier:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
