"""Near-duplicate embeddings by spherical-cap filters of structured random product codes.

1. Equal vectors are one node, the hash of their entries.  A fast rotation (signs
   and Hadamard steps) spreads each vector over two blocks; a code has random
   directions in each block, and its filters are all pairs of one direction from
   either block.  A vector passes a filter where its inner product with the pair
   is at least the cap's height.  List decoding finds all of them from the sorted
   products of the blocks, without going through the code; a vector that passes
   fewer than ``least`` takes its best ones, so that none is left out.
2. Vectors that pass the same filter meet there with a sketch (signs of random
   projections).  Sketches that agree as those of linked vectors do join their
   nodes; filters of very many vectors are split into pairs of blocks.
3. The connected components of these joins are the candidate groups.  Each is cut
   into blocks of bounded size and all pairs of blocks are compared by exact
   cosine in double precision; out come one row per vector and pair of blocks.
4. Components over the exact links give the classes.

Heights and code sizes follow from the number of rows, so that a filter holds
about as many vectors at every size.  No cap limits partners or candidates.
Four codes of a few filters each miss fewer than 1 in 1,000 pairs at the very
threshold, and hardly any beyond (measured in the tests and the README).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mix64
from .components import components
from .ngram_join import _roots
from .storage import cut, scratch

THRESHOLD = 0.95
#: Independent codes, filters of each that a vector passes on average (and at least), vectors a filter holds on average.
CODES, LEAST, OCCUPANCY = 4, 3, 32
SKETCH_BITS = 128
#: Vectors of one block of a crowded filter and of a group.
FILTER_BLOCK, GROUP_BLOCK = 2000, 1000
_SAMPLE = 16
_STEP = 2000
_SMALL = 96


def cap_height(d: int, share: float) -> float:
    """Height over which a sphere in ``d`` dimensions has this share of its surface."""
    x = np.linspace(-1, 1, 200_001)
    left = np.cumsum(((1 - x * x) ** ((d - 3) / 2))[::-1])[::-1]
    return float(x[np.searchsorted(-left / left[0], -share)])


def sketch_limit(threshold: float, bits: int = SKETCH_BITS) -> int:
    """Differing bits that vectors at ``threshold`` exceed about once in 10^8 times."""
    p = math.acos(threshold) / math.pi
    return math.ceil(bits * p + 6.2 * math.sqrt(bits * p * (1 - p)))


class Caps:
    """Filters and sketches of vectors of one length."""

    def __init__(self, d: int, rows: int, *, codes: int = CODES, least: int = LEAST, seed: int = 20_240_601):
        rng = np.random.default_rng([seed, d])
        self.d, self.least, self.size = d, least, max(16, least, math.ceil(math.sqrt(rows * least / OCCUPANCY)))
        self.wide = max(4, 1 << (d - 1).bit_length())
        self.height = cap_height(self.wide, least / self.size**2)
        self.signs = rng.choice([-1.0, 1.0], (codes, 3, self.wide))
        blocks = rng.standard_normal((codes, 2, self.wide // 2, self.size))
        self.blocks = blocks / np.linalg.norm(blocks, axis=2, keepdims=True) / math.sqrt(2)
        self.planes = rng.standard_normal((d, SKETCH_BITS))

    def rotated(self, x: np.ndarray, code: int) -> np.ndarray:
        out = np.zeros((len(x), self.wide))
        out[:, : self.d] = x
        for signs in self.signs[code]:
            out *= signs
            step = 1
            while step < self.wide:
                parts = out.reshape(len(x), -1, 2, step)
                out = np.stack([parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]], axis=2).reshape(len(x), self.wide)
                step *= 2
            out /= math.sqrt(self.wide)
        return out

    def decode(self, x: np.ndarray, code: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, filters): every filter of the code that each unit vector passes, and its ``least`` best ones."""
        half, turned, t = self.wide // 2, self.rotated(x, code), self.least
        one, two = turned[:, :half] @ self.blocks[code, 0], turned[:, half:] @ self.blocks[code, 1]
        tops = [-np.partition(-s, t - 1, axis=1)[:, :t] for s in (one, two)]
        sums = (tops[0][:, :, None] + tops[1][:, None, :]).reshape(len(x), -1)
        height = np.minimum(self.height, -np.partition(-sums, t - 1, axis=1)[:, t - 1])
        row1, at1 = np.nonzero(one >= (height - two.max(axis=1) - 1e-12)[:, None])
        row2, at2 = np.nonzero(two >= (height - one.max(axis=1) - 1e-12)[:, None])
        many2 = np.bincount(row2, minlength=len(x))
        first2 = np.cumsum(many2) - many2
        times = many2[row1]
        left = np.repeat(np.arange(len(row1)), times)
        right = first2[row1[left]] + np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        rows = row1[left]
        hit = one[rows, at1[left]] + two[rows, at2[right]] >= height[rows]
        rows, left, right = rows[hit], left[hit], right[hit]
        number = ((np.uint64(code) * np.uint64(self.size) + at1[left].astype(np.uint64)) * np.uint64(self.size)) + at2[right].astype(np.uint64)
        return rows, mix64(number + np.uint64(self.d << 48)).view(np.int64)

    def filters(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(borders, filters) of the unit vectors in ``x`` over all codes."""
        found = [self.decode(x, code) for code in range(len(self.signs))]
        rows, numbers = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(rows, kind="stable")
        return np.searchsorted(rows[order], np.arange(len(x) + 1)), numbers[order]

    def sketches(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self.planes > 0, axis=1).view(np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(column: pa.Array):
    """(places, matrix of doubles) for each length of vectors in a list column."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values, lengths = np.asarray(column.values.to_numpy(zero_copy_only=False), dtype=np.float64), np.diff(offsets)
    for d in np.unique(lengths):
        places = np.flatnonzero(lengths == d)
        yield places, values[(offsets[places][:, None] + np.arange(d)[None, :])]


def cap_codes(nodes: DataFrame, rows: int, *, codes: int = CODES, least: int = LEAST) -> DataFrame:
    """(node, one, two, filters) of (node, v): both halves of the sketch, and the filters passed."""

    def run(batches):
        known: dict[int, Caps] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, _STEP):
                part = batch.slice(at, _STEP)
                part = part.take(pa.array(np.unique(part.column(0).to_numpy(), return_index=True)[1]))  # copies meet here already
                for places, x in _vectors(part.column(1)):
                    if x.shape[1] not in known:
                        known[x.shape[1]] = Caps(x.shape[1], rows, codes=codes, least=least)
                    caps, x = known[x.shape[1]], unit(x)
                    borders, filters = caps.filters(x)
                    sketch = caps.sketches(x)
                    columns = [part.column(0).take(pa.array(places)), pa.array(np.ascontiguousarray(sketch[:, 0])), pa.array(np.ascontiguousarray(sketch[:, 1])), pa.ListArray.from_arrays(borders.astype(np.int32), filters)]
                    yield pa.RecordBatch.from_arrays(columns, names=["node", "one", "two", "filters"])

    return nodes.select("node", "v").mapInArrow(run, "node long, one long, two long, filters array<long>")


def _least(many: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least position that each of ``many`` positions reaches over the links (left, right)."""
    root = np.arange(many)
    while len(left):
        low = np.minimum(root[left], root[right])
        after = root.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    return root


def sketch_links(key: np.ndarray, node: np.ndarray, sketch: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) wherever sketches of one key (rows sorted by key) differ in ``limit`` bits at most, one root for all that are joined."""
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    length = np.repeat(np.diff(edge), np.diff(edge))
    lefts, rights = [], []

    def near(left, right):
        differ = np.bitwise_count(sketch[left, 0] ^ sketch[right, 0]).astype(np.int16) + np.bitwise_count(sketch[left, 1] ^ sketch[right, 1])
        hit = differ <= limit
        lefts.append(left[hit])
        rights.append(right[hit])

    small = np.flatnonzero((length > 1) & (length <= _SMALL))
    for step in range(1, _SMALL):
        small = small[small + step < len(key)]
        small = small[key[small] == key[small + step]]
        if not len(small):
            break
        near(small, small + step)
    for at, to in zip(edge[:-1], edge[1:]):
        if to - at > _SMALL:
            for i in range(at, to - 1):
                near(np.full(to - i - 1, i), np.arange(i + 1, to))
    root = _least(len(key), *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lefts, rights)))
    moved = np.flatnonzero((root != np.arange(len(key))) & (node != node[root]))
    return node[moved], node[root[moved]]


def _meet(limit: int):
    def result(parts):
        key, node, one, two = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((node, key))
        new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (node[order][1:] != node[order][:-1])])
        order = order[new]
        src, dst = sketch_links(key[order], node[order], np.stack([one[order], two[order]], axis=1).view(np.uint64), limit)
        return pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])

    def run(batches):
        held = []  # rows whose key may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            last = int(np.searchsorted(columns[0], columns[0][-1]))
            if last or (held and held[-1][0][-1] != columns[0][0]):
                if last:
                    held.append([c[:last] for c in columns])
                yield result(held)
                held = []
            held.append([c[last:] for c in columns])
        if held:
            yield result(held)

    return run


def _candidates(coded: DataFrame, threshold: float) -> DataFrame:
    """(src, dst): nodes joined by a filter and their sketches."""
    entries = coded.select(F.explode("filters").alias("filter"), "node", "one", "two")
    sample = coded.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(_SAMPLE)) == 0).select(F.explode("filters").alias("filter"))
    # which filters are crowded decides only how their work is split, so that a sample does
    crowded = sample.groupBy("filter").count().where(F.col("count") > FILTER_BLOCK // _SAMPLE)
    crowded = cut(crowded.select("filter", F.ceil(F.col("count") * _SAMPLE / FILTER_BLOCK).cast("int").alias("parts")), "crowded")
    if crowded.limit(1).count():
        split = entries.join(crowded, "filter", "left")
        own = F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts").cast("long"))
        other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
        split = split.select("filter", "node", "one", "two", own.alias("own"), other.alias("other"))
        entries = split.select(F.when(F.col("other").isNull(), F.col("filter")).otherwise(F.xxhash64("filter", F.least("own", "other"), F.greatest("own", "other"))).alias("filter"), "node", "one", "two")
    return entries.repartition("filter").sortWithinPartitions("filter").mapInArrow(_meet(sketch_limit(threshold)), "src long, dst long")


def _compare(threshold: float):
    kind = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64()), ("whole", pa.bool_())])

    def result(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        part = pa.Table.from_batches(parts).combine_chunks()
        node = part.column(3).to_numpy()
        part = part.take(pa.array(np.argsort(node)))  # by node, so that the least position is the least node
        low, high, node, size, block, whole = (part.column(c).to_numpy() for c in ("low", "high", "node", "size", "block", "whole"))
        x = unit(next(_vectors(part.column("v").combine_chunks()))[1])
        root, links = np.arange(len(node)), np.zeros(len(node), np.int64)
        if low[0] == high[0]:
            near = x @ x.T >= threshold
            np.fill_diagonal(near, True)
            root, _ = _roots(near)  # with the diagonal, that makes a row and its column one
            np.fill_diagonal(near, False)
            links = near @ size
        else:
            one, two = np.flatnonzero(block == low[0]), np.flatnonzero(block == high[0])
            if len(one) and len(two):
                near = x[one] @ x[two].T >= threshold
                links[one], links[two] = near @ size[two], near.T @ size[one]
                place = np.concatenate([one, two])
                root[one], root[two] = (place[r] for r in _roots(near))
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[root]), pa.array(links.astype(np.int64)), pa.array(whole)], schema=kind)

    def run(batches):
        held, now = [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            edge = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1), [True]])) if len(keys) else [0]
            for at, to in zip(edge[:-1], edge[1:]):
                if now != (key := tuple(keys[at])) and held:
                    yield result(held)
                    held = []
                now = key
                held.append(batch.slice(at, to - at))
        if held:
            yield result(held)

    return run


def near_embeddings(vectors: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", codes: int = CODES, least: int = LEAST) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``n_links`` is the number of other rows at cosine ``threshold`` (above 0) or
    more, ``component_id`` the least id that chains of links reach, and ``kept``
    whether the row has that id.  Vectors that are null, empty or zero, or hold
    null or non-finite entries, link with nothing, and so do vectors of
    different lengths with each other.  Equal vectors are linked, so rows that
    repeat count as rows.  Rows of a null id take part; a null id names a
    component only if all its ids are null, and keeps its rows then.  Extra
    columns are not looked at; an empty table gives no rows.
    """
    v = F.col(vector_col)
    good = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(v, lambda c: c != 0)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(good, v).alias("v")).withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    with scratch(vectors.sparkSession) as keep:
        ids = keep(cut(rows.select("vec_id", "node"), "ids"))
        usable = rows.where("node is not null").select("node", "v")
        classes = cut(ids.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("size")), "classes")
        coded = cut(cap_codes(usable, max(1, classes.count()), codes=codes, least=least), "codes")
        groups = components(_candidates(coded, threshold))
        members = cut(groups.join(classes.select("node", "size"), "node"), "members")

        parts = members.groupBy("root").agg(F.ceil(F.count("*") / GROUP_BLOCK).cast("int").alias("parts"))
        # written first, so that AQE may split the root of a giant group in the join
        placed = members.join(cut(parts, "parts"), "root").withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts").cast("long")).cast("int"))
        one_each = usable.groupBy("node").agg(F.first("v").alias("v"))
        spread = one_each.join(placed, "node").select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        pairs = spread.select("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "size", "block", (F.col("parts") == 1).alias("whole"), "v")
        pairs = pairs.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
        found = cut(pairs.mapInArrow(_compare(threshold), "node long, root long, links long, whole boolean"), "links")
        apart = components(found.where("not whole and node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst")))
        tops = found.where("whole").select("node", F.col("root").alias("top")).unionByName(apart.withColumnRenamed("root", "top"))
        least_ids = cut(tops.join(classes, "node").groupBy("top").agg(F.min("first_id").alias("component_id")), "least")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        ends = links.join(tops.join(least_ids, "top"), "node", "left")
        total = (F.col("size") - 1 + F.coalesce("links", F.lit(0).cast("long"))).alias("n_links")
        named = keep(cut(classes.join(ends, "node", "left").select("node", total, F.coalesce("component_id", "first_id").alias("component_id")), "named"))
    out = ids.where("node is not null").join(named, "node").select("vec_id", "n_links", "component_id")
    alone = ids.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
