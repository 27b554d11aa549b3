"""Cohorts: current in-patients, their histories, and the restriction of any table to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_cancelled



def current_inpatients(movements: DataFrame, cases: DataFrame, *, case: str, patient: str, kind: str, end: str, cancelled: str, most: int | None = None) -> DataFrame:
    """Patients of cases with an admission (kind 1) that is not cancelled and not over (end null or in year 9999)."""
    is_open = F.col(end).isNull() | (F.year(end) == 9999)
    admitted = movements.where((F.trim(kind) == "1") & ~is_cancelled(F.col(cancelled)) & is_open).select(case).distinct()
    out = cases.join(admitted, case, "left_semi").select(patient).where(F.col(patient).isNotNull()).distinct()
    return out if most is None else out.orderBy(patient).limit(most)


def semi(df: DataFrame, keys: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``; AQE broadcasts the keys if they turn out small."""
    return df.join(keys, key, "left_semi")


def expand_history(cases: DataFrame, patients: DataFrame, *, patient: str) -> DataFrame:
    """All cases of the patients."""
    return semi(cases, patients, patient)
