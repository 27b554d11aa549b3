"""Data quality, run logs, lineage and the audit chain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut, scratch
from .hierarchy import reached


def pk_uniqueness(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows, distinct keys and whether they agree, in two aggregations with map-side combine."""
    per_key = df.groupBy(*key).agg(F.count("*").alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def fill_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """Filled values per column, in one pass: a row (column_name, filled, n_rows)."""
    one = df.agg(F.count("*").alias("n_rows"), *[F.count(F.when(F.trim(F.col(c).cast("string")) != "", 1)).alias(c) for c in columns])
    return one.select("n_rows", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns])).alias("_x")).select("_x.column_name", "_x.filled", "n_rows")


def join_coverage(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct keys on the left, and how many find a partner."""
    keys = left.select(F.col(left_key).alias("_k")).where("_k is not null").distinct()
    hits = keys.join(right.select(F.col(right_key).alias("_k")).distinct().withColumn("_hit", F.lit(1)), "_k", "left")
    return hits.agg(F.count("*").alias("n_keys"), F.count("_hit").alias("n_matched"))


def pair_distribution(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.groupBy(a.alias("a"), b.alias("b")).agg(F.count("*").alias("n"))


def reconcile(local: DataFrame, source: DataFrame, *, key: str = "table_name", threshold: float = 0.001, cohort: Column | None = None) -> DataFrame:
    """Local against source row counts: OK up to the threshold, ALARM beyond, UNKNOWN without a source count, COHORT for meant subsets."""
    both = local.join(source, key, "left")
    share = F.abs(F.col("source_rows") - F.col("local_rows")) / F.greatest(F.col("source_rows"), F.lit(1))
    status = F.when(F.col("source_rows").isNull(), "UNKNOWN").when(cohort if cohort is not None else F.lit(False), "COHORT").when(share <= threshold, "OK").otherwise("ALARM")
    return both.select(key, "local_rows", "source_rows", F.when(F.col("source_rows").isNotNull(), F.round(share, 6)).alias("deviation"), status.alias("status"))


def field_profile(df: DataFrame, columns: list[str], *, top: int = 8) -> DataFrame:
    """Per column the share of nulls in percent and its most frequent values as 'value (n), ...'.

    Values are counted with map-side combine; ties go by value.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("_x")
    counted = df.select(pairs).groupBy("_x.column_name", "_x.v").agg(F.count("*").alias("n"))
    totals = counted.groupBy("column_name").agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), "v"))
    best = counted.where("v is not null").withColumn("r", rank).where(F.col("r") <= top)
    best = best.groupBy("column_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", F.concat("v", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("s")))), lambda x: x["s"]), ", ").alias("top_values"))
    return totals.join(best, "column_name", "left").select("column_name", "n_rows", F.round(F.col("n_null") * 100.0 / F.col("n_rows"), 2).alias("null_percent"), F.coalesce("top_values", F.lit("")).alias("top_values"))


def coverage_diff(used: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Used keys that the registry lacks."""
    return used.select(key).distinct().join(registry.select(key).distinct(), key, "left_anti")


def log_step_stats(log: DataFrame, *, run: str, step: str, seconds: Column) -> DataFrame:
    """Per step its mean duration and its share of the summed means."""
    mean = log.groupBy(step).agg(F.avg(seconds).alias("avg_s"), F.count("*").alias("n_runs"))
    total = mean.agg(F.sum("avg_s").alias("_t"))
    return mean.crossJoin(F.broadcast(total)).select(step, "n_runs", F.round("avg_s", 4).alias("avg_s"), F.round(F.col("avg_s") / F.col("_t"), 4).alias("ratio"))


def log_latest(log: DataFrame, *, run: str, order: list[Column], value: str) -> DataFrame:
    """The value of each run's last step."""
    return log.groupBy(run).agg(F.max_by(value, F.struct(*order)).alias(value))


def lineage_impact(edges: DataFrame, changed: DataFrame, *, child: str, parent: str) -> DataFrame:
    """Everything that depends on the changed nodes, with its least distance; it ends when nothing new is reached, on cycles too."""
    start = changed.select(F.col(changed.columns[0]).alias("root"), F.col(changed.columns[0]).alias("member"))
    every = reached(edges.select(F.col(child).alias("src"), F.col(parent).alias("dst")), start)
    return every.groupBy(F.col("member").alias("node")).agg(F.min("steps").alias("depth"))


def audit_chain(log: DataFrame, *, order: str, payload: str, prev: str, entry: str, chain: str, parts: int | None = None) -> DataFrame:
    """Per chain its number of entries and the first that does not follow from the one before; null if all do.

    Chains may be of any length: entries are dealt by ranges of (chain, order),
    so that one chain is many tasks; each range compares its own entries, and only
    the last entry of each chain in a range goes on to the next range.  Entries
    of one chain and order stand in one range.  A null entry, payload or
    reference breaks the chain there, and a first entry has an empty reference.
    """
    with scratch(log.sparkSession) as keep:
        good = F.col(entry) == F.sha2(F.concat(F.coalesce(F.col(prev), F.lit("")), F.col(payload)), 256)
        own = log.select(F.col(chain).alias("_chain"), F.col(order).alias("_at"), F.col(prev).alias("_prev"), F.col(entry).alias("_entry"), F.coalesce(good, F.lit(False)).alias("_good"))
        ranges = own.repartitionByRange("_chain", "_at") if parts is None else own.repartitionByRange(parts, "_chain", "_at")
        rows = keep(cut(ranges.withColumn("_part", F.spark_partition_id()), "ranges"))
    last = rows.groupBy("_chain", "_part").agg(F.max_by("_entry", "_at").alias("_last"), F.count("*").alias("_n"))
    # one row a chain and range
    handed = last.select("_chain", "_part", F.lag("_last").over(Window.partitionBy("_chain").orderBy("_part")).alias("_before"))
    within = Window.partitionBy("_chain", "_part").orderBy("_at")
    linked = rows.select("*", F.lag("_entry").over(within).alias("_lag"), (F.row_number().over(within) == 1).alias("_first")).join(handed, ["_chain", "_part"])
    before = F.coalesce(F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_lag")), F.lit(""))
    ok = F.col("_good") & F.coalesce(F.col("_prev") == before, F.lit(False))
    return linked.groupBy(F.col("_chain").alias(chain)).agg(F.count("*").alias("n"), F.min(F.when(~ok, F.col("_at"))).alias("first_break"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
