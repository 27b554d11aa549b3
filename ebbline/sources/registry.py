"""Table registry and generic scans."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """What is known of a source table: key, columns to read, how changes are found and where it is cut into years."""

    name: str
    pk: tuple[str, ...]
    columns: tuple[str, ...] = ()
    cdc: str = "ct"  # ct: change table, watermark: date column, full: copied whole
    partition_date: str | None = None
    watermark_col: str | None = None
    tenant_col: str | None = None
    tenant: object = None
    facility_col: str | None = None


def scan(spark: SparkSession, d: str, spec: TableSpec, *, tenant=None, facility=None) -> DataFrame:
    """Projection and tenant or facility filter of a table; both reach the Parquet scan.

    The spec's own tenant overrides the given one; the facility counts only if
    its column belongs to the key.
    """
    df = spark.read.parquet(f"{d}/{spec.name}.parquet")
    who = spec.tenant if spec.tenant is not None else tenant
    if spec.tenant_col and who is not None:
        df = df.where(F.col(spec.tenant_col) == F.lit(who))
    if spec.facility_col and facility is not None and spec.facility_col in spec.pk:
        df = df.where(F.col(spec.facility_col) == F.lit(facility))
    return df.select(*spec.columns) if spec.columns else df


def merge_schema(*frames: DataFrame) -> DataFrame:
    """Union of frames by column name; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def year_partition(c: Column) -> Column:
    """The first four characters if they are digits, else 'unknown'."""
    y = F.substring(c.cast("string"), 1, 4)
    return F.when(y.rlike("^[0-9]{4}$"), y).otherwise(F.lit("unknown"))


def _after(key, last) -> Column:
    """Whether a key comes after ``last`` in lexicographic order, as an OR cascade that can be pushed down."""
    later = F.lit(False)
    for k in range(len(key) - 1, -1, -1):
        later = (F.col(key[k]) > F.lit(last[k])) | ((F.col(key[k]) == F.lit(last[k])) & later)
    return later


def after_key(df: DataFrame, key: list[str], last: list, limit: int | None = None) -> DataFrame:
    """Rows whose key comes after ``last``; with a limit the first ones in key order."""
    out = df.where(_after(key, last))
    return out if limit is None else out.orderBy(*key).limit(limit)


def copy_whole(df: DataFrame, path: str) -> None:
    """A small reference table, copied as it is: no tenant, no years, one file; an earlier copy is replaced."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def key_predicates(key: str, bounds: list[tuple]) -> list[str]:
    """SQL conditions of key ranges [(low, high), ...]; high is exclusive, None is open, rows of a null key come with the first range that has no low end."""

    def literal(v) -> str:
        return str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else "'" + str(v).replace("'", "''") + "'"

    out, name, nulls = [], '"' + key.replace('"', '""') + '"', True
    for a, b in bounds:
        parts = [f"{name} >= {literal(a)}"] * (a is not None) + [f"{name} < {literal(b)}"] * (b is not None)
        text = " AND ".join(parts) or f"{name} IS NOT NULL"
        if a is None and nulls:
            text, nulls = f"({text} OR {name} IS NULL)", False
        out.append(text)
    return out


def read_jdbc(spark: SparkSession, url: str, spec: TableSpec, bounds: list[tuple], **options) -> DataFrame:
    """A database table, read in parallel by key ranges [(low, high), ...]; high is exclusive, None is open."""
    return spark.read.jdbc(url, spec.name, predicates=key_predicates(spec.pk[0], bounds), properties={k: str(v) for k, v in options.items()})
