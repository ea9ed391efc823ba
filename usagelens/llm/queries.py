"""One query per operator of this package over the given tables: name -> (spark, folder) -> frame."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import (
    bpe,
    chat,
    decontaminate,
    exact_dedup,
    hard_negatives,
    ngram_join,
    packing,
    pii,
    quality,
    token_counts,
    topk,
    toxicity,
    vector_codes,
)
from usagelens.llm.common import WORD_BPE, table

# Real data need a key of their own, kept secret.
DEMO_KEY = b"registry queries"

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def vocab() -> str:
    return public_tokenizers.path(WORD_BPE)


@query
def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf, "documents"), vocab())


@query
def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), vocab(), with_ids=False)


@query
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf, "labels")))


@query
def op4_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.similarity_components(table(spark, sf, "documents"), words=3, percent=90)


@query
def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    vocab = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf, "documents"), vocab)


@query
def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"), keep="largest")


@query
def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf, "documents"), DEMO_KEY)


@query
def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality.score_quality(docs, quality.fit(docs, table(spark, sf, "labels")))


@query
def op9_chat(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return chat.conversation_digests(rows.unionByName(more))


@query
def op10_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op11_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.digests(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10, percent=100)


@query
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(
        table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, moved, 5, 3, least=50, most=95, scale=256
    )


@query
def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
