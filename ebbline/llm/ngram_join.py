"""N-gram Jaccard join: pairs of texts whose sets of word n-grams are alike.

MinHash banding finds the candidates, with band and row counts chosen for a
target recall at the threshold; the full n-gram sets decide.

1. Texts with the same n-gram set form one class; it goes on as a node, the hash
   of its set, so that rows of null or repeated ids are told apart by their texts.
2. Band hashes are shuffled; a band shared by two or more classes links each of
   them to the least one, a star, so a bucket of n sends n rows, not n * n pairs.
3. The stars' connected components are the candidate groups.  A group of many
   blocks is banded again, by more hashes and rows a band at a recall so near 1
   (MORE_RECALL, at the threshold) that it parts no pair which the first bands
   found but one in 10^9, while texts chained by common passages only fall apart
   before any comparison.
4. A group beyond one block is cut by the sizes of its n-gram sets (classes
   of ratio 1 / threshold) and each class into blocks of bounded size; a task gets
   two blocks of one class or of neighbouring classes with their n-gram sets and
   compares all their pairs inside numpy.  Out come one row per text and block
   pair: its number of links and its local root.
5. The local roots are joined up to the final classes where blocks met others.

Sets whose sizes differ by more than the threshold's ratio cannot be linked, so
every possible link within a candidate group is looked at: the two bandings decide
only which groups exist, and no cap limits partners or candidates.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import free_name, mix64, shingle_hashes, span_hashes, text_chunks, word_spans
from .components import components
from .storage import cut, scratch

WORDS, THRESHOLD, RECALL, MOST_HASHES = 5, 0.8, 0.9999, 256
#: Texts and n-grams of one block; a task holds two blocks.
BLOCK_TEXTS, BLOCK_GRAMS = 1000, 200_000
#: Blocks of the largest group that is compared as it is; hashes of a text when a larger one is banded again, and the recall then.
GROUP_BLOCKS, MORE_HASHES, MORE_RECALL = 16, 1600, 1 - 1e-9
_COLUMNS = 4096
_KEY = ["set_a", "set_b", "n"]


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective banding that finds a pair at ``threshold`` with probability ``recall``.

    A pair of similarity s shares a band with probability 1 - (1 - s^rows)^bands.
    """
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log1p(-recall) / math.log1p(-(threshold**rows)))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def _normal(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))


def _gram_sets(data, offsets, size):
    """Sorted distinct n-gram hashes of each row."""
    starts, ends, counts = word_spans(data, offsets)
    grams, borders = shingle_hashes(span_hashes(data, starts, ends), counts, size)
    for i in range(len(counts)):
        yield np.unique(grams[borders[i] : borders[i + 1]])


class Bands:
    """Band hashes of n-gram sets, by a family of hash functions that follows from the seed."""

    def __init__(self, bands: int, rows: int, seed: int):
        rng = np.random.default_rng(seed)
        k = bands * rows
        self.shape = (bands, rows)
        self.turn = rng.integers(1 << 32, size=(k, 1), dtype=np.uint32)
        self.times = rng.integers(1 << 31, size=(k, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.weight = mix64(np.arange(1, rows + 1, dtype=np.uint64))
        self.salt = mix64(np.arange(1000, 1000 + bands, dtype=np.uint64))

    def of(self, grams: np.ndarray) -> np.ndarray:
        """One hash a band; none for the empty set."""
        if not len(grams):
            return np.zeros(0, np.int64)
        low = (grams >> np.uint64(32)).astype(np.uint32)[None, :]
        least = np.full((len(self.turn), 1), 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, low.shape[1], 512):  # keeps the product in the processor's cache
            np.minimum(least, ((low[:, at : at + 512] ^ self.turn) * self.times).min(axis=1, keepdims=True), out=least)
        return mix64((least.reshape(self.shape).astype(np.uint64) * self.weight).sum(axis=1, dtype=np.uint64) + self.salt).view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32), np.concatenate(rows))


def signatures(docs: DataFrame, *, words: int = WORDS, bands: int, rows: int) -> DataFrame:
    """(doc_id, n, set_a, set_b, bands): size and 128-bit hash of the n-gram set, and its band hashes."""

    def run(batches):
        family = Bands(bands, rows, 20_240_501)
        for part, data, offsets in text_chunks(batches):
            sets = list(_gram_sets(data, offsets, words))
            a, b = (pa.array(np.array(h, np.uint64).view(np.int64)) for h in zip(*map(_set_hash, sets)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(g) for g in sets], pa.int64()), a, b, _lists([family.of(g) for g in sets])], names=["doc_id", "n", "set_a", "set_b", "bands"])

    return docs.mapInArrow(run, "doc_id long, n long, set_a long, set_b long, bands array<long>")


def banded_again(sets: DataFrame, *, bands: int, rows: int) -> DataFrame:
    """(node, band) for every band hash of the n-gram sets (node, grams), by other hash functions than ``signatures``."""

    def run(batches):
        family = Bands(bands, rows, 20_240_502)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists([family.of(np.frombuffer(g, np.uint64)) for g in part.column(1).to_pylist()])], names=["node", "bands"])

    return sets.select("node", "grams").mapInArrow(run, "node long, bands array<long>").select("node", F.explode("bands").alias("band"))


def _set_hash(grams: np.ndarray) -> tuple:
    """The two halves of the 128-bit hash of an n-gram set."""
    return mix64(grams ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64), mix64(grams + np.uint64(0x5BD1E995)).sum(dtype=np.uint64)


def gram_sets(docs: DataFrame, *, words: int = WORDS, grams: bool = True) -> DataFrame:
    """The first column of ``docs`` (its last is the text), set_a, set_b, n and grams: the sorted distinct 64-bit n-gram hashes, as bytes."""
    first = docs.schema.fields[0]

    def run(batches):
        for part, data, offsets in text_chunks(batches):
            sets = list(_gram_sets(data, offsets, words))
            a, b = (pa.array(np.array(h, np.uint64).view(np.int64)) for h in zip(*map(_set_hash, sets)))
            held = [pa.array([g.tobytes() for g in sets], pa.binary())] if grams else []
            yield pa.RecordBatch.from_arrays([part.column(0), a, b, pa.array([len(g) for g in sets], pa.int64()), *held], names=[first.name, "set_a", "set_b", "n", "grams"][: 4 + grams])

    return docs.mapInArrow(run, f"`{first.name}` {first.dataType.simpleString()}, set_a long, set_b long, n long" + ", grams binary" * grams)


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left], dtype=np.int64)
    every = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    order = np.argsort(every, kind="stable")
    every, row = every[order], row[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    ids = np.cumsum(new) - 1
    often = np.bincount(ids) > 1  # n-grams of a single set meet nothing
    keep = often[ids]
    ids, row = (np.cumsum(often) - 1)[ids[keep]], row[keep]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for at in range(0, int(often.sum()), _COLUMNS):
        lo, hi = np.searchsorted(ids, [at, at + _COLUMNS])
        block = np.zeros((len(left) + len(right), _COLUMNS), dtype=np.float32)
        block[row[lo:hi], ids[lo:hi] - at] = 1
        out += block[: len(left)] @ block[len(left) :].T
    return out.astype(np.int64)


def links_of(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which sets on the left are linked with which on the right; exact (integers are compared)."""
    both = shared_counts(left, right)
    union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - both
    return both >= threshold * union - 1e-9


def _roots(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least member reached by the rows and by the columns of ``near``, as positions: rows first, then columns."""
    rows, columns = near.shape
    root = np.arange(rows + columns)
    while True:
        across = np.where(near, root[None, rows:], rows + columns).min(axis=1, initial=rows + columns)
        down = np.where(near, root[:rows, None], rows + columns).min(axis=0, initial=rows + columns)
        after = np.minimum(root, np.concatenate([across, down]))
        after = after[after]
        if (after == root).all():
            return root[:rows], root[rows:]
        root = after


def _compare(threshold: float):
    kind = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64()), ("text_links", pa.int64()), ("whole", pa.bool_())])

    def result(rows: list) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[0])  # by node, so that the least position is the least node
        ids, sizes, blocks = (np.array([r[k] for r in rows], dtype=np.int64) for k in (0, 1, 2))
        sets, whole = [np.frombuffer(r[3], dtype=np.uint64) for r in rows], [r[4] for r in rows]
        low, high = rows[0][5:]
        root, links, others = np.arange(len(rows)), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        if low == high:
            near = links_of(sets, sets, threshold)
            root, _ = _roots(near)  # with the diagonal, that makes a row and its column one
            np.fill_diagonal(near, False)
            links, others = near @ sizes, near.sum(axis=1)
        else:
            one, two = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
            if len(one) and len(two):
                near = links_of([sets[i] for i in one], [sets[i] for i in two], threshold)
                links[one], links[two], others[one], others[two] = near @ sizes[two], near.T @ sizes[one], near.sum(axis=1), near.sum(axis=0)
                place = np.concatenate([one, two])
                root[one], root[two] = (place[r] for r in _roots(near))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root]), pa.array(links.astype(np.int64)), pa.array(others.astype(np.int64)), pa.array(whole)], schema=kind)

    def run(batches):
        held, now = [], None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for key, *row in zip(zip(*columns[:3]), *columns[3:]):
                if key != now and held:
                    yield result(held)
                    held = []
                now = key
                held.append((*row, key[1], key[2]))
        if held:
            yield result(held)

    return run


def _place(members: DataFrame, threshold: float) -> DataFrame:
    """members (node, root, size, n) with ``block``, the text's own, and ``others``, the blocks it meets (its own too).

    A group of one block stays whole.  Otherwise a block is a size class (the
    upper 32 bits) and a part of it; classes are wider than 1 / threshold by a
    hair, so that rounding never puts linkable sizes two classes apart.
    """
    width = math.log(1 / threshold) + 1e-6
    members = members.withColumn("_kind", F.floor(F.log("n") / width).cast("long"))
    texts, grams = F.lit(float(BLOCK_TEXTS)), F.lit(float(BLOCK_GRAMS))
    kinds = members.groupBy("root", "_kind").agg(F.count("*").alias("_texts"), F.sum("n").alias("_grams"))
    parts = F.greatest(F.ceil(F.col("_texts") / texts), F.ceil(F.col("_grams") / grams)).cast("long")
    cuts = kinds.groupBy("root").agg(F.map_from_entries(F.collect_list(F.struct("_kind", parts))).alias("_parts"), ((F.sum("_texts") <= texts) & (F.sum("_grams") <= grams)).alias("_one"))
    # written first, so that AQE may split the root of a giant group in the join
    cuts = cut(cuts, "parts").withColumn("_parts", F.when(F.col("_one"), F.create_map(F.lit(0).cast("long"), F.lit(1).cast("long"))).otherwise(F.col("_parts")))
    placed = members.join(cuts, "root").withColumn("_kind", F.when(F.col("_one"), F.lit(0).cast("long")).otherwise(F.col("_kind")))
    own = F.shiftleft("_kind", 32) + F.pmod(F.xxhash64("node"), F.col("_parts")[F.col("_kind")])
    near = "flatten(transform(filter(sequence(_kind - 1, _kind + 1), k -> map_contains_key(_parts, k)), k -> transform(sequence(0L, _parts[k] - 1), b -> shiftleft(k, 32) + b)))"
    return placed.select("node", "root", "size", "n", own.alias("block"), F.expr(near).alias("others"))


def _classes(docs: DataFrame, *, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows' signatures, and one row per n-gram set: its key, node, text_id, top (least node of its class), class_id, n_links, n_text_links."""
    bands, rows = choose_bands(threshold, recall)
    texts = _normal(docs, id_col, text_col)
    with scratch(docs.sparkSession) as keep:
        sigs = keep(cut(signatures(texts, words=words, bands=bands, rows=rows), "signatures"))
        # equal sets have equal bands, so any of a class's rows can speak for it
        classes = sigs.groupBy(*_KEY).agg(F.min("doc_id").alias("text_id"), F.count("*").alias("size"), F.first("bands").alias("bands"))
        classes = cut(classes.withColumn("node", F.xxhash64(*_KEY)), "classes")
        groups = components(_stars(classes.select("node", F.explode("bands").alias("band"))))
        members = cut(groups.join(classes, "node").select("node", "root", "text_id", "size", "n"), "members")

        # any row of a set can bring it, whatever its id
        wanted = texts.join(members.where("text_id is not null").select(F.col("text_id").alias("doc_id")).distinct(), "doc_id", "left_semi").unionByName(texts.where("doc_id is null"))
        sets = gram_sets(wanted.select("doc_id", "text"), words=words).select(F.xxhash64(*_KEY).alias("node"), "grams").dropDuplicates(["node"])
        sets = cut(sets, "sets")
        large = members.groupBy("root").agg(F.count("*").alias("_texts"), F.sum("n").alias("_grams")).where((F.col("_texts") > GROUP_BLOCKS * BLOCK_TEXTS) | (F.col("_grams") > GROUP_BLOCKS * BLOCK_GRAMS))
        large = cut(large.select("root"), "large")
        if large.limit(1).count():
            far = cut(members.join(large, "root", "left_semi"), "far")
            bands, rows = choose_bands(threshold, MORE_RECALL, MORE_HASHES)
            groups = components(_stars(cut(banded_again(sets.join(far.select("node"), "node", "left_semi"), bands=bands, rows=rows), "bands")))
            members = cut(members.join(large, "root", "left_anti").unionByName(far.drop("root").join(groups, "node").select(members.columns)), "members")

        placed = _place(members.select("node", "root", "size", "n"), threshold)
        spread = sets.join(placed, "node").select("*", F.explode("others").alias("_with"))
        pairs = spread.select("root", F.least("block", "_with").alias("low"), F.greatest("block", "_with").alias("high"), "node", "size", "block", "grams", (F.size("others") == 1).alias("whole"))
        pairs = pairs.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
        found = cut(pairs.mapInArrow(_compare(threshold), "node long, root long, links long, text_links long, whole boolean"), "links")
        apart = components(found.where("not whole and node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst")))
        final = found.where("whole").select("node", F.col("root").alias("top")).unionByName(apart.withColumnRenamed("root", "top"))
        least = cut(final.join(members.select("node", "text_id"), "node").groupBy("top").agg(F.min("text_id").alias("class_id")), "least")
        counts = found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
        ends = counts.join(final.join(least, "top"), "node", "left")
        links, text_links = (F.coalesce(c, F.lit(0).cast("long")) for c in ("links", "text_links"))
        named = classes.join(ends, "node", "left").select(*_KEY, "node", "text_id", F.coalesce("top", "node").alias("top"), F.coalesce("class_id", "text_id").alias("class_id"), (F.col("size") - 1 + links).alias("n_links"), text_links.alias("n_text_links"))
        return sigs, keep(cut(named, "named"))


def _stars(hashed: DataFrame) -> DataFrame:
    """Edges (src, dst) from every node of a band hash (node, band) to the least one."""
    stars = hashed.groupBy("band").agg(F.min("node").alias("root"), F.max("node").alias("other")).where("root <> other").select("band", "root")
    # written first, so that AQE may split a band of very many nodes in the join
    return hashed.join(cut(stars, "stars"), "band").where("node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst"))


def ngram_join(docs: DataFrame, *, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_id, class_id, n_links, n_text_links.

    ``text_id`` is the least id among rows of the same n-gram set, ``class_id``
    the least id among all that chains of links reach, ``n_links`` the number of
    other rows at Jaccard similarity ``threshold`` or more and ``n_text_links``
    the number of other n-gram sets among them.  Words are runs of digits,
    letters, ``_`` and characters beyond ASCII, lower-cased; a text of fewer
    than ``words`` words has one n-gram, all its words.  Texts without words
    (null and empty too) have the empty set and equal one another only.  Rows
    of a null id take part, but a null id names a class only if all its ids
    are null.  A pair at the very threshold is found with probability ``recall``
    (times MORE_RECALL where its group has more than GROUP_BLOCKS blocks and is
    banded again), a closer one more surely.  Repeated rows count as rows.  Extra columns are not looked at; an
    empty table gives no rows.
    """
    sigs, named = _classes(docs, words=words, threshold=threshold, recall=recall, id_col=id_col, text_col=text_col)
    return sigs.select("doc_id", *_KEY).join(named, _KEY).select("doc_id", "text_id", "class_id", "n_links", "n_text_links")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one document of each class, the one of least id, with all columns.

    Each class keeps one row.  A row of null id stays only in classes that have
    no other id; where the least id stands on several texts of a class, one of
    them stays.  Kept ids that are null or stand on several rows are told apart
    by their texts.
    """
    own, words = F.col(options.get("id_col", "doc_id")), options.get("words", WORDS)
    sigs, named = _classes(docs, **options)
    heads = named.where(F.col("text_id").eqNullSafe(F.col("class_id"))).groupBy("top").agg(F.min("node").alias("node"), F.min("text_id").alias("_kept"))
    times = sigs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"))
    kept = cut(heads.join(times, F.col("_kept") == F.col("doc_id"), "left").select("node", "_kept", F.coalesce("rows", F.lit(0)).alias("rows")), "kept")
    kept_id, kept_key, key = (free_name(c, docs.columns) for c in ("_kept_id", "_kept_key", "_key"))
    out = docs.join(kept.where("rows = 1").select(F.col("_kept").alias(kept_id)), own.cast("long") == F.col(kept_id), "left_semi")
    many = kept.where("rows <> 1")
    if many.limit(1).count():
        text = F.lower(F.coalesce(F.col(options.get("text_col", "text")), F.lit("")))
        doubtful = docs.select(own.cast("long").alias("id"), text.alias("text"))
        doubtful = doubtful.join(many.where("_kept is not null").select(F.col("_kept").alias("id")).distinct(), "id", "left_semi").unionByName(doubtful.where("id is null"))
        keys = gram_sets(doubtful.select(F.struct("id", F.sha2("text", 256).alias("sha")).alias("at"), "text").dropDuplicates(["at"]), words=words, grams=False)
        keys = keys.select("at.*", F.xxhash64(*_KEY).alias("node"))
        chosen = keys.alias("k").join(many.alias("m"), (F.col("k.node") == F.col("m.node")) & F.col("k.id").eqNullSafe(F.col("m._kept"))).groupBy("m.node", "k.id").agg(F.min("k.sha").alias("sha"))
        chosen = cut(chosen.select(F.col("id").alias(kept_id), F.col("sha").alias(kept_key)), "chosen")
        again = docs.withColumn(key, F.sha2(text, 256)).join(chosen, own.cast("long").eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_key)), "left_semi")
        out = out.unionByName(again.dropDuplicates([options.get("id_col", "doc_id"), key]).drop(key))
    return out
