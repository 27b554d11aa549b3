"""The folder that driver and executors share, and tables that cut lineage there."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Scratches open in this context; another thread has its own.
_OPEN: ContextVar[tuple[set, ...]] = ContextVar("open scratches", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only where it is unset and Spark runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="ebbline-shared-")
        spark.conf.set("spark.checkpoint.dir", found) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._ebbline_path = path
    if _OPEN.get():
        _OPEN.get()[-1].add(path)
    return out


def drop(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession):
    """Tables cut inside, by the same thread, are removed at the end, but for those given to the function it yields.

    A kept table belongs to the scratch around this one, if there is one; else it
    stays, as the result still reads it.
    """
    own: set = set()
    outer = _OPEN.get()

    def keep(df: DataFrame) -> DataFrame:
        own.discard(df._ebbline_path)
        if outer:
            outer[-1].add(df._ebbline_path)
        return df

    token = _OPEN.set((*outer, own))
    try:
        yield keep
    finally:
        _OPEN.reset(token)
        for path in own:
            drop(spark, path)
