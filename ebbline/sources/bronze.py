"""Tables by year on disk: backfill in logged slices, and compaction of changes.

Folders of a table ``name`` under ``root``:

* ``name/jahr=Y``: the table; ``_delta/name``: files of changes; ``_delta_archive/name``: files already folded in
* ``_compact/name/stage`` and ``.../plan``: a compaction under way
* ``_backfill/name/plan``, ``.../log/slice=k`` and ``.../rows/slice=k/jahr=Y``: a backfill

Each step is one Spark write, complete when its ``_SUCCESS`` mark is there, so a
run that stops anywhere is taken up again by the next one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .changes import latest_state
from .registry import TableSpec, _after, year_partition

YEAR = "jahr"


class Files:
    """The few calls on files that Spark's readers and writers lack."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def children(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name))) if self.exists(name) else []

    def parquet(self, name: str) -> list[str]:
        return [f for f in self.children(name) if f.endswith(".parquet")]

    def move(self, one: str, folder: str) -> None:
        self.fs.mkdirs(self.path(folder))
        if self.exists(one) and not self.fs.rename(self.path(one), self.path(folder)):
            raise OSError(f"{one} could not be moved to {folder}")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def age_days(self, name: str, now_ms: int) -> float:
        return (now_ms - self.fs.getFileStatus(self.path(name)).getModificationTime()) / 86_400_000


def read_years(spark: SparkSession, path: str) -> DataFrame:
    """A table by year with the year as text."""
    found = spark.read.parquet(path).schema
    kept = [f for f in found.fields if f.name != YEAR]
    return spark.read.schema(StructType([*kept, StructField(YEAR, StringType())])).parquet(path)


def write_years(df: DataFrame, path: str, date: str | None, *, key: list[str], parts: int = 8) -> None:
    """A new table by year, ``parts`` files a year at most."""
    year = year_partition(F.col(date)) if date else F.lit("unknown")
    df.withColumn(YEAR, year).repartition(YEAR, F.pmod(F.xxhash64(*key), F.lit(parts))).write.partitionBy(YEAR).parquet(path)


# compaction ---------------------------------------------------------------------------------------------


def stage_compaction(spark: SparkSession, root: str, name: str, *, key: list[str], date: str | None) -> bool:
    """Write the new contents of the years that changes touch beside the table, and after them the plan; false without changes.

    The plan names the years and the files of changes; changes that arrive later
    are not in it and wait for the next compaction.
    """
    from ..operators.current_state import compacted, touched_partitions

    files, work = Files(spark, root), f"{root}/_compact/{name}"
    deltas = files.parquet(f"{root}/_delta/{name}")
    if not deltas:
        return False
    files.remove(work)
    base = read_years(spark, f"{root}/{name}")
    delta = spark.read.option("mergeSchema", "true").parquet(*[f"{root}/_delta/{name}/{f}" for f in deltas])
    fresh = compacted(base, delta, key=key, date=date, partition=YEAR)
    fresh.repartition(YEAR, F.pmod(F.xxhash64(*key), F.lit(8))).write.partitionBy(YEAR).parquet(f"{work}/stage")
    years = touched_partitions(delta, base, key=key, date=date, partition=YEAR)
    names = spark.createDataFrame([("file", f) for f in deltas], "kind string, name string")
    years.select(F.lit("year").alias("kind"), F.col(YEAR).alias("name")).unionByName(names).coalesce(1).write.parquet(f"{work}/plan")
    return True


def swap_compaction(spark: SparkSession, root: str, name: str) -> None:
    """Replace the planned years of the table by the staged ones; other years keep their files. Doing it twice does no harm."""
    files, work = Files(spark, root), f"{root}/_compact/{name}"
    years = {r.name for r in spark.read.parquet(f"{work}/plan").where("kind = 'year'").collect()}  # one row a year
    full = {f.partition("=")[2] for f in files.children(f"{work}/stage") if f.startswith(f"{YEAR}=")}
    if full:
        staged = read_years(spark, f"{work}/stage")
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(f"{root}/{name}")
    for year in years - full:  # every row of it was deleted
        files.remove(f"{root}/{name}/{YEAR}={year}")


def archive_deltas(spark: SparkSession, root: str, name: str) -> int:
    """Move the planned files of changes to the archive, then end the compaction; how many files it folded in."""
    files, work = Files(spark, root), f"{root}/_compact/{name}"
    planned = [r.name for r in spark.read.parquet(f"{work}/plan").where("kind = 'file'").collect()]
    for f in planned:
        files.move(f"{root}/_delta/{name}/{f}", f"{root}/_delta_archive/{name}")
    files.remove(work)
    return len(planned)


def compact_table(spark: SparkSession, root: str, name: str, *, key: list[str], date: str | None) -> int:
    """Fold the changes of a table into its years; how many files of changes went to the archive.

    A compaction that stopped before its plan was written begins anew, as the
    table is still as it was; one that stopped later goes on from the swap.  The
    table is the same either way, and another run without new changes does nothing.
    """
    if not Files(spark, root).exists(f"{root}/_compact/{name}/plan/_SUCCESS"):
        if not stage_compaction(spark, root, name, key=key, date=date):
            return 0
    swap_compaction(spark, root, name)
    return archive_deltas(spark, root, name)


def prune_archive(spark: SparkSession, root: str, name: str, *, now_ms: int, days: float = 90) -> int:
    """Remove archived files older than the horizon; how many went."""
    files, folder = Files(spark, root), f"{root}/_delta_archive/{name}"
    old = [f for f in files.parquet(folder) if files.age_days(f"{folder}/{f}", now_ms) > days]
    for f in old:
        files.remove(f"{folder}/{f}")
    return len(old)


# backfill -----------------------------------------------------------------------------------------------


def plan_slices(df: DataFrame, path: str, key: list[str], slices: int) -> None:
    """Write the upper key of each of ``slices`` ranges of about equal size; the last one is open."""
    part = F.spark_partition_id()
    tops = df.select(*key).repartitionByRange(slices, *key).groupBy(part.alias("part")).agg(F.max(F.struct(*key)).alias("top"))
    order = F.row_number().over(Window.orderBy("part")) - 1  # one row a slice
    tops.select(order.cast("int").alias("slice"), "top.*").coalesce(1).write.parquet(path)


def slice_of(key: list[str], tops: list[list]):
    """Number of the range that a row's key falls into; every row has one, those of null keys too."""
    out = F.lit(0)
    for top in tops:
        out = out + F.coalesce(_after(key, top), F.lit(False)).cast("int")
    return out


def backfill_table(df: DataFrame, root: str, spec: TableSpec, *, rows_per_slice: int = 5_000_000, most_slices: int | None = None) -> int:
    """Copy a source table into ``root`` slice by slice in key order, each logged when it is complete; how many slices were written.

    The ranges of keys are planned once and kept.  A slice without an entry in
    the log is written again from the start, into its own folder, so a run that
    stopped in the middle (or after ``most_slices``) is taken up where it was and
    leaves no row out and none twice.  Once all is logged a run does nothing.
    """
    spark, key = df.sparkSession, list(spec.pk)
    files, work = Files(spark, root), f"{root}/_backfill/{spec.name}"
    if not files.exists(f"{work}/plan/_SUCCESS"):
        files.remove(f"{work}/plan")
        plan_slices(df, f"{work}/plan", key, max(1, math.ceil(df.count() / rows_per_slice)))
    tops = [[r[k] for k in key] for r in spark.read.parquet(f"{work}/plan").orderBy("slice").collect()]
    logged = {f.partition("=")[2] for f in files.children(f"{work}/log") if files.exists(f"{work}/log/{f}/_SUCCESS")}
    year = year_partition(F.col(spec.partition_date)) if spec.partition_date else F.lit("unknown")
    written = 0
    for k in range(max(1, len(tops))):
        if str(k) in logged:
            continue
        if most_slices is not None and written == most_slices:
            break
        own = df.where(slice_of(key, tops[:-1]) == k)
        if k:  # besides the exact test, bounds of the first key that reach the scan
            own = own.where(F.col(key[0]) >= F.lit(tops[k - 1][0]))
        if k < len(tops) - 1 and k:
            own = own.where(F.col(key[0]) <= F.lit(tops[k][0]))
        to = f"{work}/rows/slice={k}"
        own.withColumn(YEAR, year).repartition(YEAR).write.mode("overwrite").partitionBy(YEAR).parquet(to)
        done = read_slice(spark, to, df.columns)
        entry = done.agg(
            F.lit(spec.name).alias("table_name"), F.lit("backfill").alias("phase"), F.to_json(F.min(F.struct(*key))).alias("first_key"), F.to_json(F.max(F.struct(*key))).alias("cursor"),
            F.count("*").alias("rows"), F.count_distinct("_file").alias("files"), F.current_timestamp().alias("finished_at"),
        )
        entry.coalesce(1).write.mode("overwrite").parquet(f"{work}/log/slice={k}")
        written += 1
    return written


def read_slice(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    if not any(f.startswith(f"{YEAR}=") for f in Files(spark, path).children(path)):  # a range that holds no row any more
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*columns, "_file"]))
    return read_years(spark, path).withColumn("_file", F.input_file_name())


def read_backfill(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of all logged slices, with their year; a slice under way is not seen."""
    work = f"{root}/_backfill/{name}"
    files = Files(spark, root)
    logged = [f for f in files.children(f"{work}/log") if files.exists(f"{work}/log/{f}/_SUCCESS")]
    full = [f"{work}/rows/{s}" for s in logged if any(f.startswith(f"{YEAR}=") for f in files.children(f"{work}/rows/{s}"))]
    found = spark.read.parquet(full[0]).schema
    kind = StructType([*[f for f in found.fields if f.name != YEAR], StructField("slice", StringType()), StructField(YEAR, StringType())])
    return spark.read.schema(kind).option("basePath", f"{work}/rows").parquet(*full)


def backfill_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Where a backfill is: the last cursor, rows so far, time of the last slice."""
    log = spark.read.parquet(f"{root}/_backfill/{name}/log")
    return latest_state(log, ["table_name", "phase"], ts="finished_at", values=["cursor"], rows="rows")
