"""Case merging, diagnoses, patients, activity filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MARITAL, SEXES, is_cancelled, is_set, lookup
from .graph import reason_text


#: Columns of the roles that a diagnosis can have, several at once.
ROLES = ("principal", "department", "admission", "discharge", "referral", "treatment", "surgery", "preoperative", "death", "working")


def merge_cases(groups: DataFrame, members: DataFrame) -> DataFrame:
    """Members of billing groups with the leading case, a leading mark and the reason; groups cancelled on the day they were made go."""
    ok = groups.where(~is_cancelled(F.col("group_cancelled")) | (F.col("cancelled_on") != F.col("made_on")))
    lead = members.where(is_set(F.col("lead"))).groupBy("grp").agg(F.min("case_id").alias("lead_case"))
    rows = members.join(ok.select("grp"), "grp", "left_semi").join(lead, "grp", "left")
    return rows.select("grp", "case_id", "lead_case", (F.col("case_id") == F.col("lead_case")).cast("int").alias("is_lead"), reason_text(F.col("reason")).alias("reason_text"))


def merge_movements(mapping: DataFrame) -> DataFrame:
    """Old to new movement, with a mark where one old movement became several."""
    n = mapping.select("old_id", "new_id").distinct().groupBy("old_id").agg(F.count("*").alias("_n"))
    return mapping.join(n, "old_id").select("old_id", "new_id", (F.col("_n") > 1).cast("int").alias("is_split"))


def merge_details(mapping: DataFrame, details: DataFrame, *, values: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Old to new ids of details with the values of the new one, else of the old one, and the mapping's own columns ``keep``."""
    new = details.select(F.col("id").alias("new_id"), *[F.col(v).alias(f"_n_{v}") for v in values])
    old = details.select(F.col("id").alias("old_id"), *[F.col(v).alias(f"_o_{v}") for v in values])
    return mapping.join(new, "new_id", "left").join(old, "old_id", "left").select("old_id", "new_id", *[F.coalesce(f"_n_{v}", f"_o_{v}").alias(v) for v in values], *keep)


#: Categories of a merged diagnosis.
DRG_CATEGORIES = {"S": "Nebendiagnose (S)", "P": "Hauptdiagnose (P)"}


def drg_marks(rows: DataFrame, *, diagnoses: bool = True) -> DataFrame:
    """What the grouper said: place and category, of diagnoses also the category's text, relevance and complexity level.

    Reads drg_place, drg_category and, of diagnoses, drg_relevant and drg_level; a
    place or level that is no number is null, a category that is not in the list
    (null or blank too) is no DRG diagnosis.
    """
    out = rows.withColumn("drg_place", F.trim("drg_place").try_cast("int"))
    if not diagnoses:
        return out
    text = lookup(F.col("drg_category"), DRG_CATEGORIES, "keine DRG-Diagnose")
    return out.withColumns({"drg_category_text": text, "is_drg_relevant": is_set(F.col("drg_relevant")).cast("int"), "drg_level": F.trim("drg_level").try_cast("int")}).drop("drg_relevant")


def case_derive(cases: DataFrame) -> DataFrame:
    """Days not billable in two ways, state text, lock mark, open mark.

    From ``days_off`` and ``days_off_audit`` (null without an audit): care counts
    the first only after an audit, the audit's way counts its own, else the first.
    """
    state = F.when(F.col("status") == "F", "billed").when(F.col("status") == "O", "open").otherwise("partly billed")
    care = F.when(F.col("days_off_audit").isNull(), 0).otherwise(F.col("days_off"))
    return cases.select("*", F.coalesce("days_off_audit", "days_off").alias("nb_audit"), care.alias("nb_care"), state.alias("state_text"), is_set(F.col("locked")).cast("int").alias("is_locked"), F.col("end_date").isNull().cast("int").alias("is_open"))


def case_cube(cases: DataFrame, merged: DataFrame, patients: DataFrame) -> DataFrame:
    """Cases with merge data and patient; the leading case carries the group's days not billable, following cases go.

    Groups are summed where there is one and joined back, so that the cases
    without a group, most of them, never meet in one task.
    """
    rows = cases.join(merged.select("grp", "case_id", "lead_case", "is_lead"), "case_id", "left").join(patients.select("patient_id", "sex"), "patient_id", "left")
    total = cases.join(merged.where("grp is not null").select("grp", "case_id"), "case_id").groupBy("grp").agg(F.sum("nb_audit").alias("_total"))
    lead = rows.where("grp is not null").join(total, "grp").withColumn("nb_group", F.col("_total").cast("long")).drop("_total")
    rows = lead.unionByName(rows.where("grp is null").withColumn("nb_group", F.col("nb_audit").cast("long")))
    return rows.where(F.coalesce("is_lead", F.lit(1)) == 1)


def case_cube_history(versions: DataFrame, merged: DataFrame, *, value: str = "nb_audit") -> DataFrame:
    """Versions of cases (valid_from to valid_to, both included) with the group's sum of ``value`` in every slice of time; following cases go.

    Each version adds its value on its first day and takes it away after its last,
    so a running sum by group gives the sum of every slice without a join of the
    members with each other.  A null counts as 0; a member without a version on a
    day adds nothing; cases without a group keep their own value and slices.
    """
    rows = versions.select("case_id", "valid_from", "valid_to", F.coalesce(value, F.lit(0)).cast("long").alias(value)).join(merged.select("grp", "case_id", "lead_case", "is_lead"), "case_id", "left")
    member = rows.where("grp is not null")
    steps = F.array(F.struct(F.col("valid_from").alias("day"), F.col(value).alias("n")), F.struct(F.date_add("valid_to", 1).alias("day"), (-F.col(value)).alias("n")))
    change = member.select("grp", F.explode(steps).alias("x")).groupBy("grp", "x.day").agg(F.sum("x.n").alias("_n"))
    w = Window.partitionBy("grp").orderBy("day")
    slices = change.select("grp", F.col("day").alias("_from"), F.date_sub(F.lead("day").over(w), 1).alias("_to"), F.sum("_n").over(w).alias("group_value")).where("_to is not null")
    lead = member.where(F.coalesce("is_lead", F.lit(1)) == 1).join(slices, "grp").where("_from <= valid_to and _to >= valid_from")
    lead = lead.withColumns({"valid_from": F.greatest("valid_from", "_from"), "valid_to": F.least("valid_to", "_to")}).drop("_from", "_to")
    return lead.unionByName(rows.where("grp is null").withColumn("group_value", F.col(value))).drop("is_lead")


def diagnosis_derive(d: DataFrame) -> DataFrame:
    """Main or side diagnosis, cancellation mark, number of its roles (ROLES, ten of them), and ``drg_marks``."""
    roles = [is_set(F.col(c)).cast("int") for c in ROLES]
    return drg_marks(d).select("*", F.when(is_set(F.col("principal")), "HD").otherwise("ND").alias("rank_text"), reduce(lambda a, b: a + b, roles).alias("n_roles"), is_cancelled(F.col("cancelled")).cast("int").alias("is_cancelled"))


def diagnosis_cube(d: DataFrame, merged: DataFrame, units: DataFrame, texts: DataFrame, movements: DataFrame) -> DataFrame:
    """Diagnoses with the leading case, the movement's unit and the code's text."""
    rows = d.join(merged.select("case_id", "lead_case"), "case_id", "left").join(movements.groupBy("case_id", "number").agg(F.max("ward").alias("unit_id")), ["case_id", "number"], "left")
    return rows.join(units.select("unit_id", "unit_name"), "unit_id", "left").join(texts, "code", "left").withColumn("billing_case", F.coalesce("lead_case", "case_id"))


def patient_derive(p: DataFrame) -> DataFrame:
    """Salutation, sex, marital status, death mark and time of death."""
    sex = lookup(F.col("sex"), SEXES, "unknown")
    title = F.when(sex == "male", "Herr").when(sex == "female", "Frau").otherwise("")
    return p.select("*", sex.alias("sex_text"), title.alias("salutation"), lookup(F.col("marital"), MARITAL, "unbekannt").alias("marital_text"), is_set(F.col("dead")).cast("int").alias("is_dead"), F.try_to_timestamp("dead_on").alias("dead_at"))


def patient_cube(cases: DataFrame, versions: DataFrame) -> DataFrame:
    """Cases with the patient's version valid when they began."""
    v = versions.withColumnRenamed("key", "patient_id")
    return cases.join(v, "patient_id").where(F.col("begin_date").between(F.col("valid_from"), F.col("valid_to"))).drop("valid_from", "valid_to")


def activity_full(sources: dict[str, tuple[DataFrame, str]], groups: DataFrame, *, since) -> DataFrame:
    """Cases with activity since a day in any source, and all members of their billing groups."""
    keys = reduce(DataFrame.unionByName, [df.where(F.to_date(day) >= F.lit(since).cast("date")).select("case_id") for df, day in sources.values()]).distinct()
    wide = groups.join(groups.join(keys, "case_id", "left_semi").select("grp").distinct(), "grp", "left_semi").select("case_id")
    return keys.unionByName(wide).distinct()


def activity_delta(sources: dict[str, tuple[DataFrame, str]], *, since) -> DataFrame:
    """Cases touched since a day, with a column per source: one pass over the tagged union."""
    names = list(sources)
    tagged = reduce(DataFrame.unionByName, [df.where(F.to_date(day) >= F.lit(since).cast("date")).select("case_id", *[F.lit(int(n == m)).alias(m) for m in names]) for n, (df, day) in sources.items()])
    return tagged.groupBy("case_id").agg(*[F.max(n).alias(n) for n in names])


def year_filter(sources: list[tuple[DataFrame, Column, Column]], year: int) -> DataFrame:
    """Cases of which some row spans the year."""
    return reduce(DataFrame.unionByName, [df.where(F.lit(year).between(F.year(a), F.year(F.coalesce(b, a)))).select("case_id") for df, a, b in sources]).distinct()
