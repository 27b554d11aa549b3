"""Sharding by a permutation-filled lookup table.

Each shard has its own preference order over the slots of a prime-sized table
and the shards take turns claiming their next free slot.  The table has a fixed
number of slots, so it is broadcast, and a row finds its shard by one lookup.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .carried import Carried, named

SLOTS = 65537


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """Index of the owning shard for every slot; independent of the order in which the shards are listed."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots must be a prime, and not below the number of shards")
    turn = sorted(range(len(shards)), key=lambda k: shards[k])
    offset = [_hash(s, "offset") % slots for s in shards]
    skip = [_hash(s, "skip") % (slots - 1) + 1 for s in shards]
    seen, table, left = [0] * len(shards), np.full(slots, -1, dtype=np.int32), slots
    while left:
        for k in turn:
            slot = (offset[k] + seen[k] * skip[k]) % slots
            while table[slot] >= 0:
                seen[k] += 1
                slot = (offset[k] + seen[k] * skip[k]) % slots
            table[slot] = k
            seen[k] += 1
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of the MD5 of its text, modulo the slots; a null key has the slot of the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots).cast("int")


def shard_rows(df: DataFrame, key: str, shards: list[str], *, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; these get underscores before them where ``df`` has such columns.

    Placement depends on the key's text alone, so equal keys meet in one shard
    whatever the table's size.  The broadcast has ``slots`` rows.  Null keys go
    to one shard; an empty table gives no rows.
    """
    spark: SparkSession = df.sparkSession
    owners = lookup_table(shards, slots)
    table = spark.createDataFrame(pa.table({"slot": pa.array(np.arange(slots, dtype=np.int32)), "shard": pa.array(np.array(shards, dtype=object)[owners], pa.string())}))
    carried = Carried(df, None)
    placed = carried.narrow(slot_of(named(key), slots).alias("slot")).join(F.broadcast(table), "slot")
    return carried.restored(placed.select("kept", "slot", "shard"))
