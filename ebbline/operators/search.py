"""Text search: document table, inverted index (also on disk, in blocks) and BM25 ranking."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import cut

K1, B = 1.2, 0.75
#: Documents of one block of the index on disk, blocks that are scored first, and what sums of doubles may differ by.
BLOCK_DOCS, FIRST_BLOCKS, SLACK = 4096, 4, 1e-6


def doc_texts(texts: DataFrame, links: DataFrame, *, key: list[str], text: str, columns: list[str]) -> DataFrame:
    """Documents with text: id of the joined keys, text, and the columns of their link."""
    rows = texts.where(F.col(text).isNotNull()).select(*key, F.col(text).alias("text"))
    return rows.join(links, key, "left").select(F.concat_ws("-", *[F.col(k).cast("string") for k in key]).alias("doc_key"), "text", *columns)


def terms(text) -> F.Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def index(docs: DataFrame, *, id: str, text: str) -> DataFrame:
    """(term, id, tf, length): one row per term and document."""
    t = docs.select(F.col(id), terms(F.col(text)).alias("_t")).withColumn("length", F.size("_t").cast("long"))
    return t.select(id, "length", F.explode("_t").alias("term")).groupBy("term", id, "length").agg(F.count("*").alias("tf"))


def counted(docs: DataFrame, *, id: str, text: str) -> DataFrame:
    """(id, length, term, tf) of each row for itself, without an exchange: its words are sorted, and a word's count is the distance from its first place to the next word's."""
    t = docs.select(F.col(id).alias("id"), F.sort_array(terms(F.col(text))).alias("_w")).withColumn("_n", F.size("_w")).where("_n > 0")
    first = F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1)))
    t = t.withColumn("_first", first).withColumn("_next", F.concat(F.slice("_first", 2, F.size("_first")), F.array("_n")))
    each = t.select("id", F.col("_n").cast("long").alias("length"), "_w", F.explode(F.arrays_zip("_first", "_next")).alias("_at"))
    return each.select("id", "length", F.get("_w", F.col("_at._first")).alias("term"), (F.col("_at._next") - F.col("_at._first")).cast("long").alias("tf"))


def bm25(docs: DataFrame, query: str, *, id: str, text: str, k: int = 10, where=None, snippet: int = 500) -> DataFrame:
    """The best ``k`` documents: id, score, snippet.

    Texts are cut into words once: each document's length and its counts of the
    query's terms are written as a narrow table, from which the corpus figures and
    the ranking come; only the best ids read their texts again.  Ties go by id;
    null texts count as empty; a query without words finds nothing.
    """
    wanted = _words(query)
    rows = docs.where(where) if where is not None else docs
    t = rows.select(id, terms(F.col(text)).alias("_t"))

    def count(word: str):
        return F.size(F.filter("_t", lambda x: x == F.lit(word)))

    t = cut(t.select(id, F.size("_t").alias("_len"), *[count(w).alias(f"_tf{i}") for i, w in enumerate(wanted)]), "counts")
    whole = t.agg(F.count("*").alias("_n"), F.avg("_len").alias("_avg"), *[F.count(F.when(F.col(f"_tf{i}") > 0, 1)).alias(f"_df{i}") for i in range(len(wanted))])
    score = F.lit(0.0)
    for i in range(len(wanted)):
        idf = F.ln((F.col("_n") - F.col(f"_df{i}") + 0.5) / (F.col(f"_df{i}") + 0.5) + 1)
        tf = F.col(f"_tf{i}")
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("_len") / F.col("_avg")))
    hit = " OR ".join(["false", *(f"_tf{i} > 0" for i in range(len(wanted)))])
    best = t.where(hit).crossJoin(F.broadcast(whole)).select(id, F.round(score, 6).alias("score")).orderBy(F.desc("score"), id).limit(k)
    shown = rows.select(id, F.substring(text, 1, snippet).alias("snippet"))
    return shown.join(F.broadcast(best), id).select(id, "score", "snippet").orderBy(F.desc("score"), id)  # k rows


def _words(query: str) -> list[str]:
    return sorted(set("".join(c.lower() if c.isalnum() else " " for c in query).split()))


def write_index(docs: DataFrame, path: str, *, id: str, text: str, block_docs: int = BLOCK_DOCS) -> None:
    """An index for many searches: ``path/figures`` (documents, mean length, blocks) and ``path/postings``.

    Documents are dealt into blocks by the hash of their id.  A posting row is a
    term in a block: its documents with frequency and length, and the best
    contribution that any of them has.  Rows are dealt by range of term and block
    once, grouped and sorted there, so that a search reads the row groups of its own
    terms only.  Null texts count as empty; rows of a null id take part as one
    document.
    """
    figures = docs.agg(F.count("*").alias("n"), F.coalesce(F.avg(F.size(terms(F.col(text)))), F.lit(0.0)).alias("mean"))
    figures = figures.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("n") / block_docs)).cast("long"))
    figures.coalesce(1).write.parquet(f"{path}/figures")
    whole = docs.sparkSession.read.parquet(f"{path}/figures").first()
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(whole["mean"] or 1.0)))
    block = F.pmod(F.xxhash64("id"), F.lit(whole["blocks"])).alias("block")
    dealt = counted(docs, id=id, text=text).select("term", block, "id", "length", "tf").repartitionByRange("term", "block")
    rows = dealt.groupBy("term", "block", "id", "length").agg(F.sum("tf").alias("tf")).select("term", "block", F.struct("id", part.alias("part")).alias("doc"))
    blocks = rows.groupBy("term", "block").agg(F.sort_array(F.collect_list("doc")).alias("docs"), F.max("doc.part").alias("best"), F.count("*").alias("n"))
    blocks.sortWithinPartitions("term", "block").write.option("parquet.block.size", 8 << 20).parquet(f"{path}/postings")


def postings_of(spark: SparkSession, path: str, words: list[str]) -> DataFrame:
    return spark.read.parquet(f"{path}/postings").where(F.col("term").isin(*words))


def blocks_to_score(spark: SparkSession, path: str, words: list[str], k: int) -> tuple[DataFrame, dict]:
    """Blocks (block, bound) that can hold one of the ``k`` best documents, and each word's weight.

    First the blocks of the highest bounds are scored; no document of a block
    whose bound is below the k-th score found there can come in.
    """
    n = spark.read.parquet(f"{path}/figures").first()["n"]
    p = postings_of(spark, path, words)
    df = {r["term"]: r["n"] for r in p.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # a row a word of the query
    weight = {t: math.log((n - x + 0.5) / (x + 0.5) + 1) for t, x in df.items()}
    bounds = p.select("block", (weight_of(weight) * F.col("best")).alias("b")).groupBy("block").agg(F.sum("b").alias("bound"))
    first = bounds.orderBy(F.desc("bound"), "block").limit(FIRST_BLOCKS)
    found = [r["score"] for r in scored(p, first, weight).orderBy(F.desc("score")).limit(k).collect()]
    least = found[-1] - SLACK if len(found) == k else -1.0
    return bounds.where(F.col("bound") >= least), weight


def weight_of(weight: dict):
    out = F.lit(0.0)
    for term, w in weight.items():
        out = F.when(F.col("term") == term, F.lit(w)).otherwise(out)
    return out


def scored(postings: DataFrame, blocks: DataFrame, weight: dict) -> DataFrame:
    """(id, score) of all documents of the blocks that hold a word."""
    rows = postings.join(blocks.select("block"), "block", "left_semi").select(weight_of(weight).alias("w"), F.explode("docs").alias("doc"))
    return rows.groupBy("doc.id").agg(F.sum(F.col("w") * F.col("doc.part")).alias("score"))


def search_index(spark: SparkSession, path: str, query: str, *, k: int = 10) -> DataFrame:
    """The best ``k`` documents of an index on disk: id, score; the same ones that ``bm25`` finds."""
    words = _words(query)
    blocks, weight = blocks_to_score(spark, path, words, k) if words else (None, {})
    if not weight:
        return spark.read.parquet(f"{path}/postings").select(F.explode("docs").alias("d")).select("d.id", F.lit(0.0).alias("score")).limit(0)
    return scored(postings_of(spark, path, words), blocks, weight).select("id", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "id").limit(k)
