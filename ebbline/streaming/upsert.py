"""Continuous form of change feed to current state, with Structured Streaming.

Each micro-batch writes the newest change of each of its keys into a folder of
its own number, then a manifest of that number with the names of the live
folders.  Once there are more than ``folders`` live ones the batch folds them into
a single one first.  Readers go by the newest complete manifest, so they never
meet half a batch or half a fold; folders that the last two manifests do not
name are removed.  A batch that runs again after a failure starts from the
manifest before its own and writes the same folders again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.bronze import Files

FOLDERS = 16


def newest(df: DataFrame, key: list[str], seq: str = "_seq", op: str = "_op") -> DataFrame:
    """One row per key, the one of the largest sequence; of equal ones a delete, then the larger hash of the row. A null sequence is the least."""
    rest = [c for c in df.columns if c not in key]
    order = F.struct(F.coalesce(seq, F.lit("")), F.coalesce(F.col(op) == "D", F.lit(False)), F.xxhash64(*rest))
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*key, *[F.col(f"_r.{c}") for c in rest])


def _manifests(files: Files, state: str) -> list[int]:
    """Numbers of the complete manifests, in order."""
    found = [f.partition("=")[2] for f in files.children(f"{state}/manifest")]
    return sorted(int(n) for n in found if files.exists(f"{state}/manifest/batch={n}/_SUCCESS"))


def live_folders(spark: SparkSession, state: str, *, before: int | None = None) -> list[str]:
    """Folders that the newest manifest names (of those before a batch, if given); none for a new state."""
    files = Files(spark, state)
    numbers = [n for n in _manifests(files, state) if before is None or n < before]
    return [r.name for r in spark.read.parquet(f"{state}/manifest/batch={numbers[-1]}").orderBy("name").collect()] if numbers else []


def take_batch(batch: DataFrame, number: int, state: str, *, key: list[str], folders: int = FOLDERS) -> None:
    """Write one micro-batch, fold if too many folders are live, then the manifest that makes both visible."""
    spark = batch.sparkSession
    files, live = Files(spark, state), live_folders(spark, state, before=number)
    newest(batch, key).write.mode("overwrite").parquet(f"{state}/rows/batch={number}")
    now = [*live, f"batch={number}"]
    if len(now) > folders:
        every = spark.read.parquet(*[f"{state}/rows/{f}" for f in now])
        newest(every, key).write.mode("overwrite").parquet(f"{state}/rows/fold={number}")
        now = [f"fold={number}"]
    spark.createDataFrame([(f,) for f in now], "name string").coalesce(1).write.mode("overwrite").parquet(f"{state}/manifest/batch={number}")
    numbers = _manifests(files, state)
    for old in numbers[:-2]:
        files.remove(f"{state}/manifest/batch={old}")
    for gone in set(files.children(f"{state}/rows")) - {*live, *now}:
        files.remove(f"{state}/rows/{gone}")


def start_upsert(spark: SparkSession, feed: str, state: str, checkpoint: str, schema, *, key: list[str], files_per_batch: int = 8, folders: int = FOLDERS):
    """Take a file feed of changes into a state table, batch by batch; the sequence decides, so late changes do no harm.

    Deleted keys stay as rows with _op D, so that an older change coming later
    does not revive them.  At most ``folders`` folders are live.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(feed)
    take = lambda batch, number: take_batch(batch, number, state, key=key, folders=folders)
    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, state: str, *, key: list[str]) -> DataFrame:
    """The live rows of a state table."""
    return newest(spark.read.parquet(*[f"{state}/rows/{f}" for f in live_folders(spark, state)]), key).where("_op <> 'D'").drop("_op")


def run_once(spark: SparkSession, changes: DataFrame, folder: str, *, key: list[str]) -> DataFrame:
    """Write the changes as a feed of files, let the stream take all of it, and read the state."""
    changes.repartition(6, "_seq").write.parquet(f"{folder}/feed")
    start_upsert(spark, f"{folder}/feed", f"{folder}/state", f"{folder}/checkpoint", changes.schema, key=key, files_per_batch=1, folders=3).awaitTermination()
    return current(spark, f"{folder}/state", key=key)
