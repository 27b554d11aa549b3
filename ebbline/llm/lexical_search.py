"""Ranked lexical search by the Best Position Algorithm over impact lists.

1. The items' terms are a stated query set; they are taken in blocks of bounded
   size, and each block passes over all documents once.
2. Documents become narrow rows: number of terms, and the block's terms in them
   with their frequencies.  Corpus figures (documents, length, document
   frequencies) are one aggregation, combined in each task.
3. Each task cuts its rows into shards of bounded size.  A shard holds for each
   term its impact list (by falling impact) and the positions of its documents
   in it (direct access).  For each item, positions are read in parallel from
   all its lists; a document met for the first time is looked up in all of them,
   which marks its positions as seen.  The best position of a list is the end of
   its unbroken run of seen positions, which direct accesses carry beyond the
   last position read.  No unseen document can score more than the sum of the
   impacts at the best positions; when that is strictly below the k-th score the
   shard is done, so that no tie at the k-th place is lost.
4. A task carries the k-th score on from shard to shard and hands on at most k
   rows an item; a window per item makes the ranks.

No list is ever gathered in one place: a term of every document is split over
all shards.  Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import span_hashes, text_chunks, word_spans
from .storage import cut, scratch

K = 50
#: Documents and postings of one shard; pairs of item and term of one block of items.
SHARD_DOCS, SHARD_POSTINGS, BLOCK_PAIRS = 16_384, 2_000_000, 1_000_000
#: Positions read from all lists together in the first round of an item; doubled each round.
FIRST_READS = 512
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[95] = 32  # `_` is no letter of a term


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all rows, and their number per row."""
    folded = _FOLD[data]
    starts, ends, counts = word_spans(folded, offsets)
    return span_hashes(folded, starts, ends), counts


def item_terms(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term): the distinct terms of each item, as hashes; all rows of one id are one item."""

    def run(batches):
        for part, data, offsets in text_chunks(batches):
            hashes, counts = term_hashes(data, offsets)
            rows = np.repeat(np.arange(len(counts)), counts)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(hashes.view(np.int64))], names=["item_id", "term"])

    return items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).mapInArrow(run, "item_id long, term long").distinct()


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) of documents (doc_id, text) with one term at least; ``terms`` are places in the sorted ``vocabulary``."""

    def run(batches):
        for part, data, offsets in text_chunks(batches):
            hashes, counts = term_hashes(data, offsets)
            rows = np.repeat(np.arange(len(counts)), counts)
            place = np.searchsorted(vocabulary, hashes) if len(vocabulary) else np.zeros(len(hashes), np.int64)
            hit = np.flatnonzero(vocabulary[np.minimum(place, len(vocabulary) - 1)] == hashes) if len(vocabulary) else np.zeros(0, np.int64)
            keys, tfs = np.unique(rows[hit] * (len(vocabulary) + 1) + place[hit], return_counts=True)
            borders = np.searchsorted(keys, np.arange(len(counts) + 1) * (len(vocabulary) + 1)).astype(np.int32)
            terms = pa.ListArray.from_arrays(borders, (keys % (len(vocabulary) + 1)).astype(np.int32))
            out = pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), terms, pa.ListArray.from_arrays(borders, tfs.astype(np.int64))], names=["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(counts > 0))

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def corpus_figures(rows: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents N, length L and document frequencies of the vocabulary's ``size`` terms."""

    def run(batches):
        df, many, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column(2).flatten().to_numpy(), minlength=size)[:size]
            many, length = many + batch.num_rows, length + int(batch.column(1).to_numpy().sum())
        place = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], place]).astype(np.int64)), pa.array(np.concatenate([[many, length], df[place]]).astype(np.int64))], names=["place", "value"])

    found = {r.place: r.value for r in rows.select("doc_id", "n", "terms").mapInArrow(run, "place long, value long").groupBy("place").agg(F.sum("value").alias("value")).collect()}
    df = np.zeros(size, np.int64)
    for place, value in found.items():
        if place >= 0:
            df[place] = value
    return found.get(-2, 0), found.get(-1, 0), df


def weights(df: np.ndarray, many: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * many + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)


class Shard:
    """Impact lists of some documents, with direct access from a document to its positions."""

    def __init__(self, n: np.ndarray, borders: np.ndarray, terms: np.ndarray, tfs: np.ndarray, many: int, length: int, size: int):
        self.docs = len(n)
        m = 50 + (50 * n * many) // max(length, 1)
        doc = np.repeat(np.arange(self.docs, dtype=np.int32), np.diff(borders))
        impact = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m[doc])
        by_doc = np.argsort(terms, kind="stable")  # rows come by document
        terms, doc, impact = terms[by_doc], doc[by_doc], impact[by_doc]
        self.start = np.searchsorted(terms, np.arange(size + 1))
        by_impact = np.lexsort((-impact, terms))
        self.doc, self.impact = doc[by_impact], impact[by_impact]
        #: documents of each list in order, and their positions in it
        self.sorted_doc, self.position = doc, np.empty(len(doc), np.int64)
        self.position[by_impact] = np.arange(len(doc)) - self.start[terms]
        self.dense: dict[int, np.ndarray] = {}

    def positions(self, term: int, docs: np.ndarray) -> np.ndarray:
        """Direct access: positions of ``docs`` in the list of ``term``, -1 where they are not in it."""
        a, b = self.start[term], self.start[term + 1]
        if (b - a) * 16 > self.docs:
            if term not in self.dense:
                self.dense[term] = np.full(self.docs, -1, np.int32)
                self.dense[term][self.sorted_doc[a:b]] = self.position[a:b]
            return self.dense[term][docs]
        at = np.searchsorted(self.sorted_doc[a:b], docs)
        inside = np.minimum(at, b - a - 1)
        return np.where(self.sorted_doc[a:b][inside] == docs, self.position[a:b][inside], -1)

    def best(self, terms: np.ndarray, w: np.ndarray, k: int, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that may be among the k best, their scores, and the positions read; ``held`` are scores found before."""
        many = self.start[terms + 1] - self.start[terms]
        used = (many > 0) & (w > 0)
        terms, w, many = terms[used], w[used], many[used]
        starts = self.start[terms]
        seen = [np.zeros(x, dtype=bool) for x in many]
        best, known = np.zeros(len(terms), np.int64), np.zeros(self.docs, dtype=bool)
        docs, scores, reads, at, step = [], [], 0, 0, max(1, FIRST_READS // max(1, len(terms)))
        top = np.sort(held)[::-1][:k]
        while len(terms) and at < many.max():
            to = np.minimum(at + step, many)
            spans = [self.doc[s + at : s + e] for s, e in zip(starts, to) if e > at]
            reads += sum(map(len, spans))
            new = np.unique(np.concatenate(spans))
            new = new[~known[new]]
            known[new] = True
            score = np.zeros(len(new), np.int64)
            for i, term in enumerate(terms):
                if best[i] == many[i]:
                    continue  # every document of the list is known
                found = self.positions(term, new)
                hit = np.flatnonzero(found >= 0)
                seen[i][found[hit]] = True
                score[hit] += w[i] * self.impact[starts[i] + found[hit]]
                run = seen[i][best[i] :]
                first = int(run.argmin())
                best[i] = many[i] if run[first] else best[i] + first
            docs.append(new)
            scores.append(score)
            top = np.concatenate([top, score])
            top = -np.partition(-top, k - 1)[:k] if len(top) > k else top
            bound = int((w * np.where(best < many, self.impact[starts + np.maximum(best - 1, 0)], 0)).sum())
            at, step = at + step, step * 2
            if len(top) == k and int(top.min()) > bound:
                break
        docs, scores = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (docs, scores))
        keep = scores > 0
        return docs[keep], scores[keep], reads


def _search(rows: DataFrame, queries: list[tuple], w: np.ndarray, many: int, length: int, k: int) -> DataFrame:
    """(item_id, doc_id, score): the k best of each task for each item."""
    w = w.copy()

    def merged(ids, nulls, scores):
        order = np.lexsort((ids, nulls, -scores))[:k]
        return ids[order], nulls[order], scores[order]

    def run(batches):
        none = np.zeros(0, np.int64)
        kept = [(none, none.astype(bool), none)] * len(queries)
        held: list[pa.RecordBatch] = []

        def done():
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column(0).combine_chunks()
            terms, tfs = (table.column(c).combine_chunks() for c in (2, 3))
            shard = Shard(table.column(1).to_numpy(), np.asarray(terms.offsets) - terms.offsets[0].as_py(), terms.flatten().to_numpy(), tfs.flatten().to_numpy(), many, length, len(w))
            null, ids = np.asarray(ids.is_null()), ids.fill_null(0).to_numpy()
            for q, (_, own) in enumerate(queries):
                docs, scores, _ = shard.best(own, w[own], k, kept[q][2])
                kept[q] = merged(*(np.concatenate(x) for x in zip(kept[q], (ids[docs], null[docs], scores))))
            held.clear()

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, SHARD_DOCS // 4)
                at += part.num_rows
                held.append(part)
                if sum(b.num_rows for b in held) >= SHARD_DOCS or sum(len(b.column(2).flatten()) for b in held) >= SHARD_POSTINGS:
                    done()
        if held:
            done()
        for (item, _), (ids, nulls, scores) in zip(queries, kept):
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(ids), pa.int64()), pa.array(ids, pa.int64(), mask=nulls), pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"])

    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, *, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0.

    Terms are runs of ASCII digits and letters and of characters beyond ASCII,
    with A-Z lower-cased.  Every row of ``docs`` is a document, whatever its id;
    equal scores go by ascending id, null ids last.  Null, empty and blank texts
    have no term: they count nowhere and rank nowhere.  Rows of one item id (the
    null one too) are one item with the terms of all; an item without terms, or
    whose terms no document holds, has no rows.  Extra columns are not looked at.
    Empty tables give no rows.  Ids are cast to long.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with scratch(spark) as keep:
        pairs = cut(item_terms(items, id_col=item_col, text_col=item_text), "item-terms")
        blocks = max(1, math.ceil(pairs.count() / BLOCK_PAIRS))
        found = None
        for block in range(blocks):
            own: dict = {}
            for r in pairs.where(F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(-1))), F.lit(blocks)) == block).collect():
                own.setdefault(r.item_id, []).append(r.term)
            if not own:
                continue
            vocabulary = np.unique(np.array([t for x in own.values() for t in x], dtype=np.int64).view(np.uint64))
            queries = [(i, np.searchsorted(vocabulary, np.sort(np.array(x, np.int64).view(np.uint64)))) for i, x in own.items()]
            rows = cut(postings(texts, vocabulary), "postings")
            many, length, df = corpus_figures(rows, len(vocabulary))
            part = keep(cut(_search(rows, queries, weights(df, many), many, length, k), "found"))
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def oracle(k: int = K) -> str:
    """The same ranks in DuckDB's SQL."""
    terms = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {terms} AS t FROM documents),
q AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
c AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY 1, 2),
s AS (SELECT CAST(count(*) AS BIGINT) AS many, CAST(sum(len(t)) AS BIGINT) AS length FROM d WHERE len(t) > 0),
f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(many) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM c, s GROUP BY term),
p AS (SELECT c.r, c.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * CAST(len(t) AS BIGINT) * many) // length))) AS part FROM c JOIN d USING (r) JOIN f USING (term), s),
h AS (SELECT item_id, r, CAST(sum(part) AS BIGINT) AS score FROM p JOIN q USING (term) GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM h JOIN d USING (r) WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) QUALIFY row_number() OVER w <= {k}"""
