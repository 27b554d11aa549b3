"""Sinks: resource lines, and resources laid out for reads by type and id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.marts import newest_resources


def write_ndjson(resources: DataFrame, path: str) -> None:
    """gzip JSON lines in one folder per resource type and run; ``body`` is a struct or JSON text."""
    body = F.col("body") if dict(resources.dtypes)["body"] == "string" else F.to_json("body")
    resources.select("resource_type", "run_id", body.alias("value")).write.mode("overwrite").partitionBy("resource_type", "run_id").option("compression", "gzip").text(path)


def resource_index(resources: DataFrame) -> DataFrame:
    """(resource_type, id, patient, run_id) of every resource."""
    return resources.select("resource_type", "id", "patient", "run_id")


def write_resources(resources: DataFrame, path: str) -> None:
    """The newest run of every resource, by range of (resource_type, id) and sorted, in small row groups.

    The ranges and their statistics are the index: a read by type and id opens
    the one file, row group and pages that can hold it.
    """
    newest = newest_resources(resources)
    newest.repartitionByRange("resource_type", "id").sortWithinPartitions("resource_type", "id").write.option("parquet.block.size", 4 << 20).option("parquet.page.size", 64 << 10).parquet(path)


def read_resources(spark: SparkSession, path: str, *, resource_type: str | None = None, id: str | None = None, patient: str | None = None, most: int | None = None) -> DataFrame:
    """Resources of a table from ``write_resources``, by type, id or patient if given (all reach the scan); by type and id, ``most`` at most."""
    out = spark.read.parquet(path)
    for column, value in (("resource_type", resource_type), ("id", id), ("patient", patient)):
        if value is not None:
            out = out.where(F.col(column) == value)
    return out.orderBy("resource_type", "id").limit(most) if most is not None else out
