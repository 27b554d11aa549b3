"""Patient graph as vertex and edge tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import icd_group, is_cancelled, is_set
from .hierarchy import reached


def _pair(a, b) -> Column:
    return F.concat_ws("-", F.col(a).cast("string"), F.col(b).cast("string"))


def nodes(patients, cases, movements, diagnoses, procedures) -> DataFrame:
    """(kind, id) of six node sets; movements only of existing cases."""
    real = movements.join(cases.select("case_id"), "case_id", "left_semi")
    sets = {
        "patient": patients.select(F.col("patient_id").cast("string").alias("id")), "case": cases.select(F.col("case_id").cast("string").alias("id")), "movement": real.select(_pair("case_id", "number").alias("id")),
        "unit": movements.select(F.coalesce("ward", "dept").cast("string").alias("id")), "diagnosis": diagnoses.select(F.col("code").alias("id")), "procedure": procedures.select(F.col("code").alias("id")),
    }
    return reduce(DataFrame.unionByName, [df.where("id is not null").distinct().select(F.lit(k).alias("kind"), "id") for k, df in sets.items()])


def edges(cases, movements, diagnoses, procedures) -> DataFrame:
    """(kind, src, dst): has_case, has_movement, in_unit, has_diagnosis, has_procedure; details only of existing cases."""
    ids = cases.select("case_id")
    mv, dg, pr = (df.join(ids, "case_id", "left_semi") for df in (movements, diagnoses, procedures))
    text = lambda c: F.col(c).cast("string")
    parts = {
        "has_case": cases.select(text("patient_id").alias("src"), text("case_id").alias("dst")), "has_movement": mv.select(text("case_id").alias("src"), _pair("case_id", "number").alias("dst")),
        "in_unit": mv.select(_pair("case_id", "number").alias("src"), F.coalesce("ward", "dept").cast("string").alias("dst")), "has_diagnosis": dg.select(text("case_id").alias("src"), F.col("code").alias("dst")), "has_procedure": pr.select(text("case_id").alias("src"), F.col("code").alias("dst")),
    }
    return reduce(DataFrame.unionByName, [df.where("src is not null and dst is not null").distinct().select(F.lit(k).alias("kind"), "src", "dst") for k, df in parts.items()])


def follows(movements: DataFrame, cases: DataFrame) -> DataFrame:
    """Each movement and the next one of its case, by number."""
    real = movements.join(cases.select("case_id"), "case_id", "left_semi").select("case_id", "number").distinct()
    nxt = F.lead("number").over(Window.partitionBy("case_id").orderBy("number"))
    return real.withColumn("_n", nxt).where("_n is not null").select(_pair("case_id", "number").alias("src"), _pair("case_id", "_n").alias("dst"))


#: Reasons for merging cases.
REASONS = {"RV": "Rueckverlegung", "WA": "Wiederaufnahme", "KO": "Komplikation", "OG": "Wiederaufnahme nach §2(1) FPV", "MD": "Wiederaufnahme nach §2(2) FPV", "WP": "Wiederaufnahme Psychiatrie/Psychosomatik", "RP": "Rueckverlegung Psychiatrie/Psychosomatik", "FW": "Fehlbelegung/Fallwechsel"}


def reason_text(c: Column) -> Column:
    out = F.lit("Sonstiges")
    for k, v in REASONS.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def merged(members: DataFrame, cases: DataFrame, *, group: str, case: str, lead: str, reason: str, cancelled: str) -> DataFrame:
    """Leading case to each other member of its billing group, with the reason; both must exist."""
    ok = members.where(~is_cancelled(F.col(cancelled)))
    head = ok.where(is_set(F.col(lead))).select(group, F.col(case).alias("src"))
    rest = ok.where(~is_set(F.col(lead))).select(group, F.col(case).alias("dst"), reason)
    ids = cases.select(F.col("case_id"))
    both = head.join(rest, group).join(ids.withColumnRenamed("case_id", "src"), "src", "left_semi").join(ids.withColumnRenamed("case_id", "dst"), "dst", "left_semi")
    return both.select("src", "dst", reason, reason_text(F.col(reason)).alias("reason_text"))


def readmissions(cases: DataFrame, diagnoses: DataFrame, *, days: int = 30) -> DataFrame:
    """Case to a later case of the same patient within ``days`` whose principal diagnosis is of the same group.

    The principal diagnosis that is not cancelled decides (least code if a case
    has several); cancelled cases take no part.  An equi-join on patient and group.
    """
    main = diagnoses.where(is_set(F.col("principal")) & ~is_cancelled(F.col("cancelled"))).groupBy("case_id").agg(F.min("code").alias("code"))
    f = cases.where(~is_cancelled(F.col("cancelled"))).join(main, "case_id").select("patient_id", "case_id", "begin_date", "end_date", icd_group(F.col("code")).alias("icd3"))
    a = f.where("end_date is not null").select("patient_id", "icd3", F.col("case_id").alias("src"), "end_date")
    b = f.select("patient_id", "icd3", F.col("case_id").alias("dst"), "begin_date")
    gap = F.datediff("begin_date", "end_date")
    return a.join(b, ["patient_id", "icd3"]).where((F.col("src") != F.col("dst")) & (gap > 0) & (gap <= days)).select("src", "dst", gap.alias("days"))


def paths(edge_table: DataFrame, *kinds: str) -> DataFrame:
    """Chains of edges of the given kinds: (n0, n1, ...)."""
    out = None
    for i, kind in enumerate(kinds):
        e = edge_table.where(F.col("kind") == kind).select(F.col("src").alias(f"n{i}"), F.col("dst").alias(f"n{i + 1}"))
        out = e if out is None else out.join(e, f"n{i}")
    return out.select(*[f"n{i}" for i in range(len(kinds) + 1)])


def shortest_chain(follow: DataFrame, start: DataFrame, *, most: int | None = None) -> DataFrame:
    """Nodes reached along the edges from the start nodes, with the least number of steps; with ``most`` only those within so many."""
    first = start.select(F.col(start.columns[0]).alias("root"), F.col(start.columns[0]).alias("member"))
    every = reached(follow.select("src", "dst"), first).groupBy(F.col("member").alias("node")).agg(F.min("steps").alias("steps"))
    return every if most is None else every.where(F.col("steps") <= most)
