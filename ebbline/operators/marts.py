"""Marts and serving queries.  Rows that are cancelled never count; ties are broken, so results are stable."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_cancelled, is_set, real_date

LOS_BUCKETS = ((1, "0-1"), (3, "2-3"), (6, "4-6"), (10, "7-10"), (15, "11-15"), (21, "16-21"))


def live(df: DataFrame, cancelled: str = "cancelled") -> DataFrame:
    return df.where(~is_cancelled(F.col(cancelled)))


def month(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM")


def cases_per_month(cases: DataFrame, *, begin: str, kind: str, cancelled: str = "cancelled", locked: str = "locked") -> DataFrame:
    """month, kind, n of cases that are neither cancelled nor locked for statistics."""
    return live(cases, cancelled).where(F.coalesce(locked, F.lit("")) != "X").groupBy(month(begin).alias("month"), F.col(kind).alias("case_type")).agg(F.count("*").alias("n"))


def length_of_stay(cases: DataFrame, *, case: str, kind: str, begin: str, end: str, cancelled: str = "cancelled") -> DataFrame:
    """In-patient cases (kind 1) with two real dates, and the days between."""
    real = real_date(F.col(begin).cast("string")).isNotNull() & real_date(F.col(end).cast("string")).isNotNull()
    rows = live(cases, cancelled).where((F.col(kind) == "1") & real)
    return rows.select(case, F.to_date(begin).alias("admitted"), F.to_date(end).alias("discharged"), F.datediff(F.to_date(end), F.to_date(begin)).alias("los_days"))


def los_stats(los: DataFrame, days: str = "los_days") -> DataFrame:
    return los.agg(F.avg(days).alias("mean"), F.median(days).alias("median"), F.count("*").alias("n"))


def los_histogram(los: DataFrame, days: str = "los_days") -> DataFrame:
    bucket = F.lit(">21")
    for most, name in reversed(LOS_BUCKETS):
        bucket = F.when(F.col(days) <= most, name).otherwise(bucket)
    return los.where(F.col(days) >= 0).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def occupancy(movements: DataFrame, *, ward: str, dept: str, end: str, cancelled: str = "cancelled", units: DataFrame | None = None, unit_id: str = "unit_id", unit_name: str = "unit_name") -> DataFrame:
    """Open movements per unit (ward, else department), with the unit's name if a catalog is given."""
    is_open = F.col(end).isNull() | (F.year(end) == 9999)
    n = live(movements, cancelled).where(is_open).groupBy(F.coalesce(ward, dept).alias("unit")).agg(F.count("*").alias("open_movements"))
    if units is None:
        return n
    return n.join(units.select(F.col(unit_id).alias("unit"), F.col(unit_name).alias("unit_name")), "unit", "left")


def top_codes(rows: DataFrame, code: str, *, where: Column | None = None, most: int = 50, cancelled: str | None = "cancelled", texts: DataFrame | None = None) -> DataFrame:
    """The most frequent codes; ties by code.  ``texts`` (code, text) adds one text per code."""
    df = live(rows, cancelled) if cancelled else rows
    n = (df if where is None else df.where(where)).groupBy(F.col(code).alias("code")).agg(F.count("*").alias("n"))
    top = n.orderBy(F.desc("n"), "code").limit(most)
    return top if texts is None else top.join(texts.groupBy("code").agg(F.min("text").alias("text")), "code", "left")


def usage_by_month(rows: DataFrame, *, day: str, flags: dict[str, str], cancelled: str = "cancelled") -> DataFrame:
    """Per month how many rows bear each flag, and all rows."""
    return live(rows, cancelled).groupBy(month(day).alias("month")).agg(*[F.sum(is_set(F.col(c)).cast("long")).alias(n) for n, c in flags.items()], F.count("*").alias("total"))


def kpis(cases: DataFrame, patients: DataFrame, labs: DataFrame, los: DataFrame, *, end: str, cancelled: str = "cancelled") -> DataFrame:
    """One row of figures; each is one aggregation."""
    a = live(cases, cancelled).agg(F.count("*").alias("n_cases"), F.count(F.when(F.col(end).isNull() | real_date(F.col(end).cast("string")).isNull(), 1)).alias("n_open"))
    parts = [patients.agg(F.count("*").alias("n_patients")), labs.agg(F.count("*").alias("n_labs")), los.agg(F.round(F.avg("los_days"), 6).alias("los_mean"), F.median("los_days").alias("los_median"))]
    return reduce(lambda x, y: x.crossJoin(F.broadcast(y)), parts, a)  # one row each


def age_sex(patients: DataFrame, *, birth: str, sex: str, year: int) -> DataFrame:
    """Bands of ten years, 90 and over together; births from 1900 to ``year``."""
    born = F.substring(F.col(birth).cast("string"), 1, 4).try_cast("int")
    band = F.least(F.floor((F.lit(year) - born) / 10) * 10, F.lit(90)).cast("int")
    return patients.where(born.between(1900, year)).groupBy(band.alias("band"), F.col(sex).alias("sex")).agg(F.count("*").alias("n"))


def top_specialties(cases: DataFrame, specialty: str, *, most: int = 12, cancelled: str = "cancelled") -> DataFrame:
    name = F.coalesce(F.nullif(F.trim(specialty), F.lit("")), F.lit("ohne")).alias("specialty")
    return live(cases, cancelled).groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "specialty").limit(most)


def masked(df: DataFrame, columns: list[str], *, year: tuple[str, ...] = (), hidden: tuple[str, ...] = (), locked: str | None = None) -> DataFrame:
    """The listed columns that exist; hidden ones as ***, dates in ``year`` as their year; locked rows go."""
    if locked and locked in df.columns:
        df = df.where(F.coalesce(locked, F.lit("")) != "X")
    pick = [F.substring(F.col(c).cast("string"), 1, 4).alias(c) if c in year else F.lit("***").alias(c) if c in hidden else F.col(c) for c in columns if c in df.columns]
    return df.select(*pick)


#: What the serving tables show of the views of these names; ~ hides a column (dates of birth become their year), ! holds the rows' lock.
SERVING = {
    "patients": "patient_id sex ~birth ~name dead".split(),
    "cases": "case_id patient_id case_type begin_date end_date specialty status cancelled !locked".split(),
    "movements": "case_id number kind art reason begin_ts end_ts dept ward cancelled".split(),
    "diagnoses": "case_id number code code2 certainty day principal department admission discharge treatment surgery cancelled".split(),
    "procedures": "case_id procedure_id code day unit cancelled".split(),
    "documents": "doc_id patient_id case_id doc_type day cancelled".split(),
    "drg": "case_id sequence code weight cancelled created".split(),
    "drg_catalog": "code text weight valid_from valid_to".split(),
}


def serving(name: str, df: DataFrame, *, clear: bool = False) -> DataFrame:
    """The serving table of this name from ``df``: the columns of SERVING that it has, masked unless ``clear``; locked rows go in any case."""
    spec = SERVING[name]
    names = [c.lstrip("~") for c in spec if not c.startswith("!")]
    secret = [] if clear else [c[1:] for c in spec if c.startswith("~")]
    return masked(df, names, year=tuple(c for c in secret if c == "birth"), hidden=tuple(c for c in secret if c != "birth"), locked=next((c[1:] for c in spec if c.startswith("!")), None))


def newest_resources(resources: DataFrame, *, resource_type: str | None = None, id: str | None = None, patient: str | None = None, most: int | None = None) -> DataFrame:
    """(resource_type, id, patient, run_id, body) of the newest run of every resource, of one type, id or patient if given; by type and id, ``most`` at most.

    Among equal runs the larger body stands.
    """
    for column, value in (("resource_type", resource_type), ("id", id), ("patient", patient)):
        if value is not None:
            resources = resources.where(F.col(column) == value)
    out = latest_by(resources, ["resource_type", "id"], ["patient", "run_id", "body"], ["run_id", "body"])
    return out.orderBy("resource_type", "id").limit(most) if most is not None else out


def masked_lab(values: DataFrame, heads: DataFrame, *, key: list[str], value_day: str, head_day: str, columns: list[str]) -> DataFrame:
    """Values with their head; the value's day, else the head's."""
    return values.join(heads, key, "left").select(*columns, F.coalesce(value_day, head_day).alias("day"))


def patient_search(patients: DataFrame, cases: DataFrame, *, patient=None, case=None, name: str | None = None, birth: str | None = None, most: int = 20) -> DataFrame:
    """Patients by id, case, name (case-insensitive, anywhere) or birth prefix; one criterion at least."""
    if patient is None and case is None and name is None and birth is None:
        raise ValueError("a criterion is needed")
    out = patients
    if patient is not None:
        out = out.where(F.col("patient_id") == patient)
    if case is not None:
        out = out.join(cases.where(F.col("case_id") == case).select("patient_id"), "patient_id", "left_semi")
    if name is not None:
        out = out.where(F.col("name").ilike(f"%{name}%"))
    if birth is not None:
        out = out.where(F.col("birth").startswith(birth))
    return out.orderBy("patient_id").limit(most)


def patient_list(patients: DataFrame, cases: DataFrame, *, offset: int, most: int, end: str = "end_date", begin: str = "begin_date") -> DataFrame:
    """Per patient the number of cases, open ones and the last admission; newest first, a page of it."""
    per = live(cases).groupBy("patient_id").agg(F.count("*").alias("n"), F.count(F.when(F.col(end).isNull(), 1)).alias("open"), F.max(begin).alias("last_admission"))
    rows = patients.join(per, "patient_id", "left").select("patient_id", "sex", F.coalesce("n", F.lit(0)).alias("n_cases"), F.coalesce("open", F.lit(0)).alias("n_open"), "last_admission")
    return rows.orderBy(F.col("last_admission").desc_nulls_last(), "patient_id").offset(offset).limit(most)


def timeline(parts: dict[str, tuple[DataFrame | None, Column, Column, Column]], *, patient: str = "patient_id", since=None, until=None, most: int | None = None) -> DataFrame:
    """Events of several tables, (patient, day, kind, ref, detail), newest first; absent tables are left out."""
    frames = [df.select(F.col(patient), day.cast("date").alias("day"), F.lit(kind).alias("kind"), ref.cast("string").alias("ref"), detail.cast("string").alias("detail")) for kind, (df, day, ref, detail) in parts.items() if df is not None]
    out = reduce(DataFrame.unionByName, frames).where(F.col("day").isNotNull())
    if since is not None:
        out = out.where(F.col("day") >= F.lit(since).cast("date"))
    if until is not None:
        out = out.where(F.col("day") <= F.lit(until).cast("date"))
    return out if most is None else out.orderBy(F.desc("day"), "kind", "ref", "detail").limit(most)


def principal_diagnosis(diagnoses: DataFrame, *, case: str = "case_id", code: str = "code", day: str = "day", principal: str = "principal") -> DataFrame:
    """One row per case: principal first, then newest, then code."""
    main = is_set(F.col(principal))
    best = F.row_number().over(Window.partitionBy(case).orderBy(main.desc(), F.desc(day), F.col(code), "number"))
    return live(diagnoses).withColumn("_r", best).where("_r = 1").select(case, F.col(code).alias("hd_code"), main.alias("is_principal"))


def last_unit(movements: DataFrame, *, case: str = "case_id", start: str = "begin_ts") -> DataFrame:
    """Department and ward of each case's newest movement that has one."""
    def newest(c):
        v = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
        return F.max(F.when(v.isNotNull(), F.struct(F.col(start), F.col("number"), v.alias("v")))).getField("v").alias(c)

    return live(movements).groupBy(case).agg(newest("dept"), newest("ward"))


def latest_by(rows: DataFrame, key: list[str], values: list[str], order: list[str]) -> DataFrame:
    """The values of each key's last row, all of one row."""
    return rows.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_r")).select(*key, *[F.col(f"_r.{v}") for v in values])


def problem_list(diagnoses: DataFrame, cases: DataFrame, *, texts: DataFrame) -> DataFrame:
    """Per patient and code: text, number, first and last day, ever principal."""
    rows = live(diagnoses).where(F.trim("code") != "").join(cases.select("case_id", "patient_id"), "case_id").join(texts, "code", "left")
    return rows.groupBy("patient_id", "code").agg(F.max("text").alias("text"), F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.max(is_set(F.col("principal")).cast("int")).alias("ever_principal"))
