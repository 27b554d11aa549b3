"""Queries of charges and revenue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import revenue as rv
from ..operators.merging import case_derive
from ..operators.stays import case_flags
from .base import duck, view
from .care import _LOS, _MS, _OFF_DAYS, _RATE, los, months

QUERIES, SQL = {}, {}


def query(sql: str | None = None, *names: str):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = duck(sql, *names)
        return f

    return put


@query("""SELECT charge_id, class, flag, CASE WHEN class IN ('E11', 'E12') THEN 'PEPP' ELSE 'DRG' END AS system, CASE WHEN class = 'E1' AND flag = 'A' THEN 'attending' WHEN class = 'E1' THEN 'main' ELSE 'other' END AS care,
CASE WHEN class = 'E1' AND flag = 'A' THEN 'E1B' ELSE class END AS statistic, CASE WHEN class = 'NUB' OR (class = 'E33' AND flag = 'R') THEN 0 ELSE 1 END AS billable FROM charges""", "charges")
def charge_classify(spark, d):
    c = view(spark, d, "charges")
    k = F.col("class")
    whole = c.select("class").distinct().select("class", F.lit("*").alias("flag"), F.when(k.isin("E11", "E12"), "PEPP").otherwise("DRG").alias("system"), F.when(k == "E1", "main").otherwise("other").alias("care"), k.alias("statistic"), F.when(k != "NUB", 1).alias("billable"))
    special = c.where("(class = 'E1' and flag = 'A') or (class = 'E33' and flag = 'R')").select("class", "flag").distinct()
    special = special.select("class", "flag", F.lit("DRG").alias("system"), F.when(k == "E1", "attending").otherwise("other").alias("care"), F.when(k == "E1", "E1B").otherwise(k).alias("statistic"), F.when(k == "E1", 1).alias("billable"))
    return rv.classify(c, whole.unionByName(special)).select("charge_id", "class", "flag", "system", "care", "statistic", "billable")


@query("SELECT charge_id, round(price * (1 - discount), 4) AS net, CASE WHEN discount > 0 THEN 1 ELSE 0 END AS is_discounted, CASE WHEN planned = 'P' THEN 1 ELSE 0 END AS is_planned, substr(note, 5, length(note) - 6) AS centre, class || '-' || flag AS flag_text, day + CAST(quantity AS INTEGER) AS end_day FROM charges", "charges")
def charge_derive(spark, d):
    return rv.derive(view(spark, d, "charges")).select("charge_id", "net", "is_discounted", "is_planned", "centre", "flag_text", "end_day")


_RAW = "CASE WHEN code_id % 4 = 0 THEN 'none' WHEN code_id % 3 = 0 THEN CAST(size * 1000 + code_id % 1000 AS {0}) || '-' ELSE ' ' || CAST(size AS {0}) || ',' || CAST(code_id % 10 AS {0}) END"


@query(f"SELECT code_id, round(TRY_CAST(replace(regexp_replace(trim({_RAW.format('VARCHAR')}), '^(.*)-$', '-\\1'), ',', '.') AS DOUBLE) / 1000, 6) AS value FROM codes", "codes")
def catalog_value_clean(spark, d):
    return view(spark, d, "codes").withColumn("raw", F.expr(_RAW.format("STRING"))).select("code_id", rv.catalog_value(F.col("raw"), 3).alias("value"))


_W = ", wt AS (SELECT code_id, low, low + 29 AS high, round(0.5 + size * 0.01 + low * 0.001, 4) AS weight FROM codes, (SELECT unnest([0, 30, 60, 90]) AS low))"
_PM = _MS + _RATE + _OFF_DAYS + ", lo AS (SELECT case_id, CAST(sum(block_days + last_day) - max(nb_audit) AS BIGINT) AS los FROM ld LEFT JOIN nb USING (case_id) GROUP BY case_id)" + _W + """, mv AS (SELECT c.case_id, charge_id, c.code_id, class, ms.month, weight, round(weight * CASE WHEN class = 'E11' THEN CAST(ms.occupancy_days AS DOUBLE) ELSE quantity END, 4) AS month_weight, round(weight * CASE WHEN class = 'E11' THEN CAST(ms.occupancy_days AS DOUBLE) ELSE quantity END * rate, 4) AS month_amount
FROM charges c JOIN lo USING (case_id) LEFT JOIN wt ON wt.code_id = c.code_id AND los BETWEEN low AND high JOIN ms USING (case_id) LEFT JOIN ra ON year(ms.month) = y WHERE class IN ('E11', 'E12'))"""


def _month_value(spark, d):
    bands = F.explode(F.array(*[F.lit(x) for x in (0, 30, 60, 90)])).alias("low")
    w = view(spark, d, "codes").select("code_id", "size", bands).select("code_id", "low", (F.col("low") + 29).alias("high"), F.round(0.5 + F.col("size") * 0.01 + F.col("low") * 0.001, 4).alias("weight"))
    return rv.month_value(view(spark, d, "charges"), w, months(spark, d))


@query(_PM + " SELECT * FROM mv", "movements", "cases", "codes", "charges")
def pepp_month_value(spark, d):
    return _month_value(spark, d)


@query(_PM + ", t AS (SELECT case_id, charge_id, code_id, class, CAST(sum(CAST(month_weight AS DECIMAL(18, 4))) AS DOUBLE) AS total_weight, CAST(sum(CAST(month_amount AS DECIMAL(18, 4))) AS DOUBLE) AS total_amount, count(*) AS n_months FROM mv GROUP BY 1, 2, 3, 4) SELECT case_id, charge_id, mv.month, total_weight, total_amount, n_months, md5(case_id || '|' || charge_id || '|' || code_id || '|' || class) AS total_id FROM mv JOIN t USING (case_id, charge_id, code_id, class)", "movements", "cases", "codes", "charges")
def pepp_rollup(spark, d):
    return rv.rollup(_month_value(spark, d)).select("case_id", "charge_id", "month", "total_weight", "total_amount", "n_months", "total_id")


# One row per charge with the case's figures and the catalog's version of the day: admission charges (class E1) by the admission's day, others by the discharge's.
# Versions overlap: the second begins before the first ends, and codes of even size have a third for some months within the second.
_CATALOG = """, cv AS (SELECT code_id, size, DATE '1990-01-01' AS valid_from, DATE '1996-06-30' AS valid_to, 0.2 AS more, 1 AS least FROM codes UNION ALL SELECT code_id, size, DATE '1996-01-01', DATE '2099-12-31', 0.3, 2 FROM codes UNION ALL SELECT code_id, size, DATE '1997-03-01', DATE '1997-09-30', 0.7, 1 FROM codes WHERE size % 2 = 0),
rate AS (SELECT year(begin_date) AS y, CAST(count(*) % 97 + 2900 AS DOUBLE) AS base FROM cases GROUP BY 1)"""
_PRE = _LOS + _CATALOG + """, pd AS (SELECT c.case_id, c.charge_id, c.code_id, c.class, c.quantity, c.price AS unit_value, lo.los, lo.treatment_days, nb_audit, nb_care, CASE WHEN fl.from_hospital = 1 THEN 1 ELSE 0 END AS admit_ext, CASE WHEN fl.to_hospital = 1 THEN 1 ELSE 0 END AS disch_ext,
 CAST(CASE WHEN class = 'E1' THEN lo.admitted ELSE lo.discharged END AS DATE) AS day FROM charges c JOIN lo USING (case_id) JOIN fl USING (case_id) LEFT JOIN nb USING (case_id)),
pre AS (SELECT pd.*, year(day) AS y, cv.valid_from AS catalog_from, cv.size * 0.05 + more AS weight, cv.size % 5 + least AS low, cv.size % 5 + 4.4 AS mean, cv.size % 5 + 12 AS high, 0.11 AS low_rate, 0.07 AS high_rate, 0.09 AS transfer_rate, pd.code_id % 2 AS flat, pd.code_id % 9 AS formula, CASE WHEN pd.code_id % 4 = 0 THEN 0 ELSE cv.size * 0.01 END AS care_weight, 140.5 AS care_rate
 FROM pd LEFT JOIN cv ON pd.code_id = cv.code_id AND day BETWEEN cv.valid_from AND cv.valid_to QUALIFY rank() OVER (PARTITION BY charge_id ORDER BY cv.valid_from DESC) = 1), pc AS (SELECT pre.*, base FROM pre LEFT JOIN rate USING (y))"""


def _catalog(spark, d):
    k = view(spark, d, "codes")
    day = lambda x: F.lit(x).cast("date")
    version = lambda a, z, more, least: F.struct(day(a).alias("valid_from"), day(z).alias("valid_to"), F.lit(more).alias("more"), F.lit(least).alias("least"))
    first, second, third = version("1990-01-01", "1996-06-30", 0.2, 1), version("1996-01-01", "2099-12-31", 0.3, 2), version("1997-03-01", "1997-09-30", 0.7, 1)
    v = k.select("code_id", "size", F.explode(F.when(F.col("size") % 2 == 0, F.array(first, second, third)).otherwise(F.array(first, second))).alias("v")).select("code_id", "size", "v.*")
    return v.select(
        "code_id", "valid_from", "valid_to", (F.col("size") * 0.05 + F.col("more")).alias("weight"), (F.col("size") % 5 + F.col("least")).alias("low"), (F.col("size") % 5 + 4.4).alias("mean"), (F.col("size") % 5 + 12).alias("high"), F.lit(0.11).alias("low_rate"),
        F.lit(0.07).alias("high_rate"), F.lit(0.09).alias("transfer_rate"), (F.col("code_id") % 2).alias("flat"), (F.col("code_id") % 9).alias("formula"), F.when(F.col("code_id") % 4 == 0, 0.0).otherwise(F.col("size") * 0.01).alias("care_weight"), F.lit(140.5).alias("care_rate"),
    )


def pre_cube(spark, d):
    c = view(spark, d, "charges").select("case_id", "charge_id", "code_id", "class", "quantity", F.col("price").alias("unit_value"))
    flags = case_flags(view(spark, d, "movements")).select("case_id", F.col("from_hospital").alias("admit_ext"), F.col("to_hospital").alias("disch_ext"))
    stay = los(spark, d).select("case_id", "los", "treatment_days", "admitted", "discharged").join(flags, "case_id")
    year = F.year("begin_date").alias("y")
    rates = view(spark, d, "cases").groupBy(year).agg((F.count("*") % 97 + 2900).cast("double").alias("base")).select(F.make_date("y", F.lit(1), F.lit(1)).alias("valid_from"), F.make_date("y", F.lit(12), F.lit(31)).alias("valid_to"), "base")
    off = case_derive(view(spark, d, "cases")).select("case_id", "nb_audit", "nb_care")
    catalog = _catalog(spark, d)
    admission = F.col("class") == "E1"
    out = rv.pre_cube(c, stay, off, catalog, rates, by_admission=admission, code="code_id", values=[x for x in catalog.columns if x not in ("code_id", "valid_from", "valid_to")])
    return out.withColumn("y", F.year(F.when(admission, F.col("admitted")).otherwise(F.col("discharged"))))


_T = ("movements", "cases", "charges", "codes")


@query(_PRE + " SELECT charge_id, class, los, y, CAST(round(weight, 6) AS DOUBLE) AS weight, low, high, base FROM pc", *_T)
def charge_pre_cube(spark, d):
    return pre_cube(spark, d).select("charge_id", "class", "los", F.col("y").cast("long").alias("y"), F.round("weight", 6).alias("weight"), "low", "high", "base")


@query("SELECT code_id, CASE WHEN code_id % 3 = 0 OR (code_id % 3 = 1 AND size > 20) THEN coalesce(CAST(size AS DOUBLE), 0) ELSE coalesce(round(price, 4), 0) END AS value FROM codes", "codes")
def dept_type_pick(spark, d):
    kind = F.when(F.col("code_id") % 3 == 0, "main").when(F.col("code_id") % 3 == 1, F.lit(None).cast("string")).otherwise("attending")
    main = F.when((F.col("code_id") % 3 == 1) & (F.col("size") <= 20), 0.0).otherwise(F.col("size").cast("double"))
    return view(spark, d, "codes").select("code_id", rv.pick_by_department(kind, main, F.round("price", 4)).alias("value"))


_SH = "CASE WHEN ((flat = 1 AND los < low) OR ((flat = 1 OR (admit_ext = 0 AND disch_ext = 0)) AND los <= low)) THEN -(low - los + 1) * 0.11 ELSE 0 END"
_LG = "CASE WHEN los >= high THEN (los - high + 1) * 0.07 ELSE 0 END"
_TR = "CASE WHEN flat = 0 AND (disch_ext = 1 OR admit_ext = 1) AND los < round(mean, 0) THEN -(round(mean, 0) - los) * 0.09 ELSE 0 END"
_AM = _PRE + f", am AS (SELECT *, CASE WHEN class = 'E33' AND formula <> 7 THEN unit_value * los WHEN class = 'E33' AND formula = 7 THEN unit_value * treatment_days WHEN class IN ('E2', 'E32', 'NUB') THEN unit_value * quantity ELSE coalesce(base * (CAST(weight AS DOUBLE) + CAST({_SH} AS DOUBLE) + CAST({_LG} AS DOUBLE) + CAST({_TR} AS DOUBLE)), 0) END AS a FROM pc)"


@query(_AM + " SELECT charge_id, round(a, 2) AS amount FROM am", *_T)
def drg_amount(spark, d):
    return rv.case_amount(pre_cube(spark, d)).select("charge_id", F.round("amount", 2).alias("amount"))


@query(_AM + " SELECT charge_id, round(a / base, 6) AS effective_weight FROM am", *_T)
def drg_effective_weight(spark, d):
    return rv.case_amount(pre_cube(spark, d)).select("charge_id", "effective_weight")


@query(_PRE + " SELECT charge_id, CASE WHEN care_weight > 0 THEN round((los + nb_audit - nb_care) * CAST(care_weight AS DOUBLE), 4) END AS care_weight_sum, CASE WHEN care_weight > 0 THEN round((los + nb_audit - nb_care) * CAST(care_weight AS DOUBLE) * 140.5, 3) END AS care_amount FROM pc", *_T)
def drg_care_revenue(spark, d):
    return rv.care_revenue(pre_cube(spark, d)).select("charge_id", "care_weight_sum", F.round("care_amount", 3).alias("care_amount"))


@query(_PRE + " SELECT charge_id, CASE WHEN los >= high THEN 'long' WHEN los <= low THEN 'short' ELSE 'normal' END AS stay_class, CASE WHEN los >= mean AND los < high THEN 'costly' WHEN los < mean AND los > low THEN 'profitable' END AS value_class FROM pc", *_T)
def drg_stay_class(spark, d):
    return rv.stay_class(pre_cube(spark, d)).select("charge_id", "stay_class", "value_class")


_NO = "(los < high AND NOT (((admit_ext = 1 AND flat = 0) OR flat = 1 OR (admit_ext = 0 AND disch_ext = 0)) AND los <= low) AND NOT (flat = 0 AND (disch_ext = 1 OR (admit_ext = 1 AND los >= low)) AND los < round(mean, 0)))"
_SHO = "((flat = 1 OR (admit_ext = 0 AND disch_ext = 0)) AND los <= low)"
_MOV = "(flat = 0 AND (disch_ext = 1 OR admit_ext = 1) AND los < round(mean, 0))"


@query(_PRE + f" SELECT charge_id, CASE WHEN {_NO} THEN 1 ELSE 0 END AS is_normal, CASE WHEN {_NO} THEN los ELSE 0 END AS normal_days, CASE WHEN los >= high THEN 1 ELSE 0 END AS is_long, CASE WHEN los >= high THEN los - high + 1 ELSE 0 END AS long_days, CASE WHEN {_SHO} THEN 1 ELSE 0 END AS is_short, CASE WHEN {_SHO} THEN low - los + 1 ELSE 0 END AS short_days, CASE WHEN flat = 0 AND disch_ext = 1 AND los < round(mean, 0) THEN 1 ELSE 0 END AS moved_out, CASE WHEN flat = 0 AND admit_ext = 1 AND los < round(mean, 0) THEN 1 ELSE 0 END AS moved_in, CASE WHEN {_MOV} THEN CAST(round(mean, 0) - los AS BIGINT) ELSE 0 END AS transfer_days FROM pc", *_T)
def drg_components(spark, d):
    return rv.components(pre_cube(spark, d)).select("charge_id", "is_normal", "normal_days", "is_long", "long_days", "is_short", "short_days", "moved_out", "moved_in", "transfer_days")


@query(_PRE + " SELECT y AS year, count(*) AS n, CAST(sum(CAST(weight AS DECIMAL(18, 6))) AS DOUBLE) AS sum_weight, round(CAST(sum(CAST(weight AS DECIMAL(18, 6))) AS DOUBLE) / count(*), 6) AS mean_weight FROM pc GROUP BY 1", *_T)
def casemix(spark, d):
    return rv.casemix(pre_cube(spark, d), year=F.col("y").cast("long"))
