"""Catalogs, lookups and context joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def catalog(df: DataFrame, keys: list[str], text_candidates: list[str]) -> DataFrame:
    """Trimmed keys and the first candidate text column that exists."""
    text = next(c for c in text_candidates if c in df.columns)
    return df.select(*[F.trim(F.col(k).cast("string")).alias(k) for k in keys], F.trim(text).alias("text"))


def resolve_code(catalogs: DataFrame, name: str, code: str, version: str = "56") -> DataFrame:
    """Text of a code in a catalog's version; an unknown catalog is an error."""
    one = catalogs.where(F.col("catalog") == name)
    if not one.take(1):
        raise ValueError(f"unknown catalog {name}")
    return one.where((F.col("code") == code) & (F.col("version") == version)).select("catalog", "version", "code", "text")


def code_text(rows: DataFrame, texts: DataFrame, on: list[str], *, language: str = "language", wanted: str = "D") -> DataFrame:
    """Rows with the text of their code, of the wanted language where the catalog has a language column; of several the least text.

    Small catalogs are broadcast by AQE.
    """
    own = texts.where(F.trim(language) == wanted) if language in texts.columns else texts
    return rows.join(own.groupBy(*on).agg(F.min("text").alias("text")), on, "left")


def billing_group(cases: DataFrame, groups: DataFrame, *, case: str, group: str) -> DataFrame:
    """Cases with their billing group, the largest if several."""
    return cases.join(groups.groupBy(case).agg(F.max(group).alias(group)), case, "left")


def case_to_patient(rows: DataFrame, cases: DataFrame, *, case: str = "case_id", patient: str = "patient_id") -> DataFrame:
    return rows.join(cases.select(case, patient).distinct(), case, "left")


def children_list(parents: DataFrame, children: DataFrame | None, *, key: str, fields: list[str], name: str = "children", where: Column | None = None) -> DataFrame:
    """Parents with an ordered list of their children as structs; null if they have none or the table is absent."""
    if children is None:
        return parents.withColumn(name, F.lit(None))
    rows = children if where is None else children.where(where)
    return parents.join(rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name)), key, "left")


def best_match(rows: DataFrame, partners: DataFrame, on: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Rows with the first partner of equal keys."""
    first = partners.withColumn("_r", F.row_number().over(Window.partitionBy(*on).orderBy(*order))).where("_r = 1").select(*on, *values)
    return rows.join(first, on, "left")


def orphans(parts: dict[str, DataFrame], cases: DataFrame, *, case: str = "case_id") -> DataFrame:
    """Per table how many rows have no case."""
    out = None
    for name, df in parts.items():
        n = df.join(cases.select(case).distinct(), case, "left_anti").agg(F.count("*").alias("n_orphans")).select(F.lit(name).alias("table_name"), "n_orphans")
        out = n if out is None else out.unionByName(n)
    return out


def full_outer(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """All keys of both sides, with the columns of both."""
    return left.join(right, key, "full")
