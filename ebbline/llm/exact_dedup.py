"""Exact dedup with a cuckoo-filter index of live digests.

Texts are equal when identical after lower-casing A-Z; their SHA-256 is the
key.  Every map task first combines its own rows of one key, so a text held by
a third of all rows sends one row per batch on.  The keys are dealt by hash to
partitions of bounded size; each feeds its rows to a cuckoo filter: a miss
inserts a new live digest, a hit is verified against the stored key that the
slot points at, an overflow doubles the filter and refills it from the stored
keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import free_name
from .storage import cut, scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows dealt to one partition on average, so that its index stays below some 50 MB however large the table.
PARTITION_KEYS = 500_000


class CuckooIndex:
    """Live 32-byte digests with values: 16-bit fingerprints in buckets of four slots, two buckets for each key.

    A slot holds a fingerprint and the number of the stored key that made it.  A
    look-up reads stored keys only where a fingerprint agrees, and compares all
    32 bytes, so a false positive never merges two texts.  Keys are arrays of four
    unsigned 64-bit numbers, values of four signed ones: id, whether there is one,
    rows, rows that bear the id.
    """

    SLOTS, KICKS, LOAD = 4, 200, 0.85

    def __init__(self, buckets: int = 64):
        self.keys, self.values = np.zeros((64, 4), np.uint64), np.zeros((64, 4), np.int64)
        self.live, self.size = np.zeros(64, bool), 0
        self.false_hits = self.resizes = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks, self.rows = np.zeros((buckets, self.SLOTS), np.uint16), np.full((buckets, self.SLOTS), -1, np.int32)

    def _other(self, bucket, mark):
        return (bucket ^ (mark.astype(np.int64) * 0x5BD1E995)) & self.mask

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = np.maximum(keys[:, 1] & np.uint64(0xFFFF), np.uint64(1)).astype(np.uint16)
        first = (keys[:, 2] & np.uint64(self.mask)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot (bucket * 4 + place) of each live digest, -1 for one that is not live."""
        mark, first, second = self._places(keys)
        out = np.full(len(keys), -1, np.int64)
        for bucket in (first, second):
            for place in range(self.SLOTS):
                at = np.flatnonzero((self.marks[bucket, place] == mark) & (out < 0))
                same = (self.keys[self.rows[bucket[at], place]] == keys[at]).all(axis=1)
                self.false_hits += int((~same).sum())
                out[at[same]] = bucket[at[same]] * self.SLOTS + place
        return out

    def _place(self, rows: np.ndarray) -> bool:
        """Put stored keys into free slots, or kick others on; False if a key finds none."""
        mark, first, second = self._places(self.keys[rows])
        left = np.arange(len(rows))
        for bucket in (first, second):
            placed = np.zeros(len(rows), bool)
            turn = left
            while len(turn):
                turn = turn[(self.marks[bucket[turn]] == 0).any(axis=1)]
                now = turn[np.unique(bucket[turn], return_index=True)[1]]  # one key a bucket and turn
                slot = (self.marks[bucket[now]] == 0).argmax(axis=1)
                self.marks[bucket[now], slot], self.rows[bucket[now], slot] = mark[now], rows[now]
                placed[now] = True
                turn = turn[~placed[turn]]
            left = left[~placed[left]]
        return all(self._kick(int(first[k]), mark[k], int(rows[k])) for k in left)

    def _kick(self, bucket: int, mark: np.uint16, row: int) -> bool:
        for k in range(self.KICKS):
            free = np.flatnonzero(self.marks[bucket] == 0)
            slot = int(free[0]) if len(free) else (k * 7 + row) % self.SLOTS
            mark, self.marks[bucket, slot] = self.marks[bucket, slot].copy(), mark
            row, self.rows[bucket, slot] = int(self.rows[bucket, slot]), row
            if len(free):
                return True
            bucket = int(self._other(np.int64(bucket), mark))
        return False

    def _grow(self) -> None:
        """Double the filter and refill it from the stored keys, until all fit."""
        stored = np.flatnonzero(self.live[: self.size])
        while True:
            self.resizes += 1
            self._clear(2 * (self.mask + 1))
            if len(stored) <= self.LOAD * self.marks.size and self._place(stored):
                return

    def insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New live digests, distinct and not live before."""
        rows = np.arange(self.size, self.size + len(keys))
        if self.size + len(keys) > len(self.keys):
            room = max(2 * len(self.keys), self.size + len(keys))
            self.keys, self.values = (np.concatenate([x[: self.size], np.zeros((room - self.size, 4), x.dtype)]) for x in (self.keys, self.values))
            self.live = np.concatenate([self.live[: self.size], np.zeros(room - self.size, bool)])
        self.keys[rows], self.values[rows], self.live[rows] = keys, values, True
        self.size += len(keys)
        if self.live[: self.size].sum() > self.LOAD * self.marks.size or not self._place(rows):
            self._grow()

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct digests with values: new ones are inserted, values of live ones joined."""
        slot = self.find(keys)
        old = slot >= 0
        rows = self.rows.reshape(-1)[slot[old]]
        self.values[rows] = joined(self.values[rows], values[old])
        self.insert(keys[~old], values[~old])

    def delete(self, keys: np.ndarray) -> np.ndarray:
        """Take distinct live digests out; which of them were live."""
        slot = self.find(keys)
        there = slot[slot >= 0]
        self.live[self.rows.reshape(-1)[there]] = False
        self.marks.reshape(-1)[there], self.rows.reshape(-1)[there] = 0, -1
        return slot >= 0


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Values of two sets of rows of the same texts: the larger id stays, an id wins over none."""
    out = a.copy()
    same = (a[:, 0] == b[:, 0]) & (a[:, 1] == b[:, 1])
    over = ~same & ((b[:, 1] > a[:, 1]) | ((b[:, 1] == a[:, 1]) & (b[:, 0] > a[:, 0])))
    out[over] = b[over]
    out[same, 3] += b[same, 3]
    out[:, 2] = a[:, 2] + b[:, 2]
    return out


def combined(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the joined values of all rows of each."""
    order = np.lexsort((values[:, 0], values[:, 1], *keys.T))
    keys, values = keys[order], values[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    opens = np.flatnonzero(new)
    last = np.append(opens[1:], len(keys)) - 1
    group = np.cumsum(new) - 1
    out = values[last]
    best = ((values[:, :2] == out[group, :2]).all(axis=1)) * values[:, 3]
    out[:, 2], out[:, 3] = np.add.reduceat(values[:, 2], opens), np.add.reduceat(best, opens)
    return keys[opens], out


_PARTIAL = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("rows", pa.int64()), ("keep_rows", pa.int64())])


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    digest, doc, rows, keep_rows = batch.columns
    keys = np.frombuffer(b"".join(digest.to_pylist()), np.uint64).reshape(-1, 4)
    there = doc.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
    return keys, np.stack([doc.fill_null(0).to_numpy(), there, rows.to_numpy(), keep_rows.to_numpy()], axis=1)


def _batch(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    raw = np.ascontiguousarray(keys).tobytes()
    digest = pa.array([raw[a : a + 32] for a in range(0, len(raw), 32)], pa.binary())
    return pa.RecordBatch.from_arrays([digest, pa.array(values[:, 0], pa.int64(), mask=values[:, 1] == 0), pa.array(values[:, 2]), pa.array(values[:, 3])], schema=_PARTIAL)


def _combine(batches):
    """One row for each digest of a batch: largest id, rows, rows with that id."""
    for batch in batches:
        if batch.num_rows:
            yield _batch(*combined(*_arrays(batch)))


def _index(batches):
    """Feed one partition's rows to its cuckoo index; one row per live digest comes out.

    Rows without rows of their own are withdrawn digests, deleted after all insertions.
    """
    index, gone = CuckooIndex(), []
    for batch in batches:
        if batch.num_rows:
            keys, values = combined(*_arrays(batch))
            index.add(keys[values[:, 2] > 0], values[values[:, 2] > 0])
            # a digest may come withdrawn and with rows in one batch
            gone.append(_arrays(batch.filter(pa.compute.equal(batch.column(2), 0)))[0])
    for keys in gone:
        if len(keys):
            index.delete(np.unique(keys, axis=0))
    alive = np.flatnonzero(index.live[: index.size])
    for a in range(0, len(alive), 20_000):
        yield _batch(index.keys[alive[a : a + 20_000]], index.values[alive[a : a + 20_000]])


def digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the SHA-256 of the text with A-Z lower-cased (null as empty), as 32 bytes."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))


def live_digests(keys: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """One row per live digest of ``keys`` (doc_id, digest): keep_id, rows, keep_rows (rows that bear keep_id).

    Digests in ``withdrawn`` are deleted from the index after all insertions.
    """
    kind = "digest binary, keep_id long, rows long, keep_rows long"
    one = F.lit(1).cast("long")
    partial = keys.select("digest", "doc_id", one.alias("rows"), one.alias("keep_rows")).mapInArrow(_combine, kind)
    if withdrawn is not None:
        none = F.lit(None).cast("long")
        partial = partial.unionByName(withdrawn.select("digest").distinct().select("digest", none.alias("keep_id"), F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("keep_rows")))
    parts = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-keys.count() // PARTITION_KEYS))
    return partial.repartition(parts, "digest").mapInArrow(_index, kind)


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", withdrawn: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, keep_rows.

    Of equal texts the row with the largest id stays.  A null text counts as
    empty; a null id never wins against another id (a group of null ids only
    keeps them, with keep_id null); repeated rows that share the winning id are
    all marked kept, and keep_rows says how many they are.  An empty table
    gives no rows; further columns of ``docs`` are not looked at.  Texts of the
    table ``withdrawn`` (same columns) are no longer live: their rows come out
    with keep_id and group_size null and kept false.
    """
    keys = cut(digests(docs, id_col=id_col, text_col=text_col), "digests")
    live = live_digests(keys, None if withdrawn is None else digests(withdrawn, id_col=id_col, text_col=text_col))
    kept = F.col("rows").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return keys.join(live, "digest", "inner" if withdrawn is None else "left").select(
        "doc_id", "keep_id", F.col("rows").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "keep_rows"
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact dedup keeps, one for each text, with their columns.

    The kept (doc_id, digest) pairs are joined back; only if some winning id
    stands on several equal rows are these thinned to one.
    """
    with scratch(docs.sparkSession) as keep:
        found = keep(cut(exact_dedup(docs).where("kept").select("doc_id", "text_sha256", "keep_rows").distinct(), "kept"))
    key, kept_id, kept_key = (free_name(c, docs.columns) for c in ("_key", "_kept_id", "_kept_key"))
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    ids = found.select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_key))
    out = docs.withColumn(key, F.sha2(text, 256)).join(ids, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_key)), "left_semi")
    if found.where("keep_rows > 1").limit(1).count():
        out = out.dropDuplicates(["doc_id", key])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
