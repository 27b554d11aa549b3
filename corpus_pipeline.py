"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage works on all rows that the one before kept.  SentencePiece and the
trained stage are beyond SQL, so ORACLE_SQL is None; tests compare the stages
with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbline.llm import exact_dedup, mixing, ngram_join, sentencepiece_dropout, toxicity
from ebbline.llm.arrays import free_name
from ebbline.llm.carried import named
from ebbline.llm.storage import cut, drop

SEED = 7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject; it learns from the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score_texts(docs, toxicity.train(docs, labels))
    predicted = scored.columns[-2]  # the operator's own, whatever columns the documents have
    return scored.where(F.col(f"`{predicted}`") == 0).select(*[named(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicate texts, the document with the least doc_id."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources repeated up to twice; the budget draws every document at least once, so none is lost."""
    return mixing.mix_sources(docs, budget="cover", repetition=2.0, seed=SEED, columns=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, tokens and n_tokens; ids of SentencePiece pieces under merge-dropout.

    Mixing repeats documents; each copy is numbered and draws for itself.
    """
    copy = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang")
    docs = docs.withColumn(free_name("_copy", docs.columns), F.row_number().over(copy))
    key = F.xxhash64("doc_id", named(docs.columns[-1]))
    tokens = sentencepiece_dropout.encode_column(docs, keep=[F.col(c) for c in ("doc_id", "source", "lang")], dropout=0.1, seed=SEED, id_col=key)
    return tokens.withColumn("n_tokens", F.size("tokens"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard", drop_near_copies), ("mixing", mix), ("sentencepiece", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
            if k:  # no later stage reads it
                drop(spark, before._ebbline_path)
    return docs
