"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_caps, embedding_whitening, exact_dedup, language_id, lexical_search, media_jpeg, mixing, ngram_join, sentencepiece_dropout, sharding, toxicity, url_filter, warc_audit


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(column: str, folds: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = _fold("doc_id", 3) == 1
    model = toxicity.train(docs, labels.where(~held_out).select("doc_id", "toxic"))
    found = toxicity.score_texts(docs, model, keep=[F.col("doc_id")])
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted", "hits")


SHARDS = [f"shard-{k:03d}" for k in range(100)]


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return sharding.shard_rows(docs, "doc_id", SHARDS)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tokens = sentencepiece_dropout.encode_column(docs, keep=[F.col("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")], dropout=0.1, seed=7)
    ids = F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256)
    back = sentencepiece_dropout.decode_column(tokens.withColumn("tokens_sha256", ids))
    return back.select("doc_id", "n_tokens", "tokens_sha256", F.sha2("text", 256).alias("decoded_sha256"), (F.sha2("text", 256) == F.col("text_sha256")).alias("lossless"))


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    records = warc_audit.to_records(pages).withColumn("copy", warc_audit.damaged("record_id", "record"))
    return warc_audit.audit(warc_audit.manifest_of(records, replicas={"one": "record", "two": "copy"}, count=pages.count()))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _fold("doc_id", 4) == 2
    profiles = language_id.train(docs.where(~held_out | F.col("doc_id").isNull()))
    found = language_id.identify(docs, profiles, keep=[F.col("doc_id")])
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"), repetition=1.25, seed=7)


def op9_media_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media_jpeg.write_media(_table(spark, sf_dir, "documents"), keep=[F.col("doc_id")])
    found = media_jpeg.read_media(stored)
    feature = F.concat_ws(":", F.concat_ws("x", "width", "height"), "thumbnail_hash")
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), "width", "height", "thumbnail_hash")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).drop("keep_rows")


OP10_SQL = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM t"""


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_caps.near_embeddings(_table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    every = (
        op1_toxicity, op2_sharding, op3_url_filters, op4_ngram_jaccard, op5_sentencepiece, op6_warc_fixity, op7_language_id, op8_mixing, op9_media_jpeg, op10_exact_dedup,
        op11_lexical_search, op12_embedding_whitening, op13_embedding_near_dedup,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict:
    return {"op6_warc_fixity": warc_audit.oracle(), "op3_url_filters": url_filter.oracle(), "op8_mixing": mixing.oracle(repetition=1.25, seed=7), "op10_exact_dedup": OP10_SQL, "op11_lexical_search": lexical_search.oracle()}
