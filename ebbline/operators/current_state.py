"""Current state of a table from its base copy and its changes, and compaction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.registry import year_partition


def current_state(base: DataFrame, delta: DataFrame | None, *, key: list[str], seq: str = "_seq", op: str = "_op") -> DataFrame | None:
    """Newest version of each key from base (sequence '') and delta; deleted keys and the meta columns go.

    Key columns that neither side has are left out of the key; without any the
    result is None.  Among equal sequences deletes win, then the row of
    the larger hash, so the result does not depend on the files' order.
    One aggregation with map-side combine; no sort and no window.
    """
    marked = base.withColumns({seq: F.lit(""), op: F.lit(None).cast("string")})
    every = marked if delta is None else marked.unionByName(delta, allowMissingColumns=True)
    key = [k for k in key if k in every.columns]
    if not key:
        return None
    payload = [c for c in every.columns if c not in (*key, seq, op)]
    newest = F.max_by(F.struct(op, *payload), F.struct(F.coalesce(seq, F.lit("")), (F.col(op) == "D").cast("int"), F.xxhash64(*payload) if payload else F.lit(0)))
    out = every.groupBy(*key).agg(newest.alias("_r")).where(F.coalesce(F.col(f"_r.{op}"), F.lit("")) != "D")
    return out.select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in every.columns if c not in (seq, op)])


def affected_partitions(delta: DataFrame, base: DataFrame, *, date: str | None, partition: str = "jahr") -> DataFrame:
    """Year partitions to rewrite: those of the changes, and all existing ones if a change has no date."""
    if date is None:
        return delta.select(F.lit("unknown").alias(partition)).limit(1)
    years = delta.select(year_partition(F.col(date)).alias(partition)).distinct()
    lost = years.where(F.col(partition) == "unknown").select(F.lit(1).alias("_lost"))
    existing = base.select(partition).distinct().join(F.broadcast(lost), F.lit(True), "left_semi")  # at most one row
    return years.unionByName(existing).distinct()


def touched_partitions(delta: DataFrame, base: DataFrame, *, key: list[str], date: str | None, partition: str = "jahr") -> DataFrame:
    """Partitions that folding the changes in alters: those that changed rows go to, and those that hold an older copy of their key, whatever the change's own date."""
    year = year_partition(F.col(date)) if date else F.lit("unknown")
    key = [k for k in key if k in base.columns and k in delta.columns]
    held = base.join(delta.select(*key).distinct(), key, "left_semi").select(partition)
    return delta.where(F.coalesce("_op", F.lit("")) != "D").select(year.alias(partition)).unionByName(held).distinct()


def compacted(base: DataFrame, delta: DataFrame, *, key: list[str], date: str | None, partition: str = "jahr") -> DataFrame:
    """Contents of the touched partitions after folding the changes in; writing them replaces those partitions."""
    now = current_state(base.drop(partition), delta, key=key).withColumn(partition, year_partition(F.col(date)) if date else F.lit("unknown"))
    return now.join(touched_partitions(delta, base, key=key, date=date, partition=partition), partition, "left_semi")


def within_horizon(files: DataFrame, *, ingested: str, today, days: int = 90) -> DataFrame:
    """Archived changes that stay."""
    return files.where(F.col(ingested) >= F.date_sub(F.lit(today).cast("date"), days))


def changed_keys(rows: DataFrame, changes: list[DataFrame], *, key: list[str], since: str, seq: str = "_seq") -> DataFrame:
    """Rows whose key has a change behind ``since``."""
    keys = reduce(DataFrame.unionByName, [c.where(F.col(seq) > F.lit(since)).select(*key) for c in changes]).distinct()
    return rows.join(keys, key, "left_semi")


def max_seq(changes: DataFrame, *, table: str | None = None, seq: str = "_seq") -> DataFrame:
    """High-water mark, per table if given."""
    return (changes.groupBy(table) if table else changes).agg(F.max(seq).alias("max_seq"))
