"""Charges and revenue: classification, catalog values, daily and case rates, effective weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import attach, slices

#: Statistic classes of the day rates, and what is paid by quantity.
DAY_CLASSES, QUANTITY_CLASSES = ("E11", "E12"), ("E2", "E32", "NUB")


def classify(charges: DataFrame, rules: DataFrame) -> DataFrame:
    """Charges with billing system, care type, statistic class and billable mark from a rule table (class, flag, system, care, statistic, billable).

    The rule of the charge's class and flag decides, else the one of its class
    with flag *; without a rule the charge is not billable and the rest null.
    """
    found = ("system", "care", "statistic", "billable")
    exact = rules.where("flag <> '*'").select("class", "flag", *[F.col(c).alias(f"_e_{c}") for c in found], F.lit(True).alias("_hit"))
    wild = rules.where("flag = '*'").select("class", *[F.col(c).alias(f"_w_{c}") for c in found])
    rows = charges.join(exact, ["class", "flag"], "left").join(wild, "class", "left")
    own = [F.when(F.col("_hit"), F.col(f"_e_{c}")).otherwise(F.col(f"_w_{c}")).alias(c) for c in found[:3]]
    billable = F.coalesce(F.when(F.col("_hit"), F.col("_e_billable")).otherwise(F.col("_w_billable")), F.lit(0)).alias("billable")
    return rows.select(*charges.columns, *own, billable)


def derive(charges: DataFrame) -> DataFrame:
    """Amount, discount mark, planned mark, cost centre (the first run of four or more digits of the note), flag text and the day it ends."""
    centre = F.nullif(F.regexp_extract(F.coalesce("note", F.lit("")), "([0-9]{4,})", 1), F.lit(""))
    net = F.round(F.col("price") * (1 - F.col("discount")), 4)
    return charges.select("*", net.alias("net"), (F.col("discount") > 0).cast("int").alias("is_discounted"), F.coalesce(F.col("planned") == "P", F.lit(False)).cast("int").alias("is_planned"), centre.alias("centre"), F.concat_ws("-", "class", "flag").alias("flag_text"), F.date_add("day", F.col("quantity").cast("int")).alias("end_day"))


def catalog_value(c: Column, scale: int) -> Column:
    """A signed number with the sign behind it, scaled down by powers of ten; null if it is none."""
    t = F.trim(c)
    n = F.regexp_replace(F.regexp_replace(t, r"^(.*)-$", "-$1"), ",", ".").try_cast("double")
    return F.round(n / 10**scale, 6)


#: Years of one bin of the interval join.
BIN_YEARS = 4


def disjoint(catalog: DataFrame, key: str, values: list[str]) -> DataFrame:
    """A catalog's versions without overlaps: on each day the one that began last holds (of equal ones the largest values); an earlier one comes back where a later one ends."""
    began = catalog.withColumn("_began", F.col("valid_from"))
    cut = attach(slices([catalog], key), began, key, ["_began", *values], "inner")
    one = cut.groupBy(key, "start", "end").agg(F.max_by(F.struct(*values), F.struct("_began", *values)).alias("_v"))
    return one.select(key, F.col("start").alias("valid_from"), F.col("end").alias("valid_to"), "_v.*")


def valid_on(rows: DataFrame, catalog: DataFrame, *, key: str, day: Column, values: list[str], few: bool = False) -> DataFrame:
    """``rows`` with the ``values`` of the catalog's version of their key on ``day``; null where it has none, and for null days.

    An interval join by bins: each version stands once in every bin of
    BIN_YEARS years that it touches, rows meet it by key and bin (an equi-join,
    which hash and AQE's skew handling can split), and the exact test follows.
    A catalog of ``few`` keys (rates by year) is broadcast, as its keys and bins would
    put all rows into as few tasks.
    """
    bin_of = lambda d: F.floor(F.year(d) / BIN_YEARS)
    bins = F.explode(F.sequence(bin_of(F.col("valid_from")), bin_of(F.col("valid_to")))).alias("_bin")
    c = disjoint(catalog, key, values).select(F.col(key).alias("_key"), bins, F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *values)
    c = F.broadcast(c) if few else c
    x = rows.withColumns({"_day": F.to_date(day), "_at": bin_of(F.to_date(day))})
    return x.join(c, (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_bin")) & F.col("_day").between(F.col("_from"), F.col("_to")), "left").drop("_day", "_at", "_key", "_bin", "_from", "_to")


def pre_cube(charges: DataFrame, stays: DataFrame, days_off: DataFrame, catalog: DataFrame, rates: DataFrame, *, by_admission: Column, code: str, values: list[str]) -> DataFrame:
    """Charges of cases with a stay, with its figures, days not billable, the catalog's values and the base rate of their day.

    The day is the admission's where ``by_admission`` holds, else the
    discharge's.  ``rates`` (valid_from, valid_to, base) hold for all codes.  A
    charge whose code has no version on its day keeps nulls.
    """
    day = F.when(by_admission, F.col("admitted")).otherwise(F.col("discharged"))
    rows = charges.join(stays, "case_id").join(days_off, "case_id", "left")
    rows = valid_on(rows, catalog, key=code, day=day, values=values)
    every = F.lit("all").alias("_tariff")
    return valid_on(rows.select("*", every), rates.select("*", every), key="_tariff", day=day, values=["base"], few=True).drop("_tariff")


def month_value(charges: DataFrame, weights: DataFrame, months: DataFrame) -> DataFrame:
    """Day-rate charges with the weight whose band holds the length of stay, per month: weight times days (E11) or quantity (E12), times the base rate.

    ``months`` bear their case's length of stay (``los``).  A charge gets the bands
    of its code before it meets its months, so that only charges are dealt by code,
    and the months stay where their cases are.
    """
    bands = weights.groupBy("code_id").agg(F.collect_list(F.struct("low", "high", "weight")).alias("_bands"))
    c = charges.where(F.col("class").isin(*DAY_CLASSES)).select("case_id", "charge_id", "code_id", "class", "quantity").join(bands, "code_id", "left")
    m = c.join(months.select("case_id", "month", F.col("occupancy_days").alias("days"), "rate", "los"), "case_id")
    fits = F.filter("_bands", lambda b: F.col("los").between(b["low"], b["high"]))
    m = m.withColumn("_band", F.explode_outer(fits)).withColumn("weight", F.col("_band.weight"))
    units = F.when(F.col("class") == "E11", F.col("days").cast("double")).otherwise(F.col("quantity"))
    return m.select("case_id", "charge_id", "code_id", "class", "month", "weight", F.round(F.col("weight") * units, 4).alias("month_weight"), F.round(F.col("weight") * units * F.col("rate"), 4).alias("month_amount"))


def rollup(months: DataFrame) -> DataFrame:
    """Months with the total of their charge, and the total's id; by a window, as months lie by case already."""
    key = ["case_id", "charge_id", "code_id", "class"]
    of, known = Window.partitionBy(*key), " and ".join(f"{k} is not null" for k in key)
    d = lambda c: F.col(c).cast("decimal(18,4)")
    return months.where(known).select("*", F.sum(d("month_weight")).over(of).cast("double").alias("total_weight"), F.sum(d("month_amount")).over(of).cast("double").alias("total_amount"), F.count("*").over(of).alias("n_months"), F.md5(F.concat_ws("|", *key)).alias("total_id"))


def pick_by_department(dept_type: Column, main: Column, other: Column) -> Column:
    """Main department's value if the department is one, or is unknown and has a value; else the attending doctor's."""
    return F.when((dept_type == "main") | (dept_type.isNull() & (main > 0)), F.coalesce(main, F.lit(0.0))).otherwise(F.coalesce(other, F.lit(0.0)))


# columns of the case rate: weight, los, low (short-stay limit), mean, high (long-stay limit), low_rate, high_rate, transfer_rate, flat (transfer flat), admit_ext, disch_ext, base


def short_stay(c=F.col) -> Column:
    plain = (c("admit_ext") == 0) & (c("disch_ext") == 0)
    due = ((c("flat") == 1) & (c("los") < c("low"))) | (((c("flat") == 1) | plain) & (c("los") <= c("low")))
    return F.when(due, -(c("low") - c("los") + 1) * c("low_rate")).otherwise(0.0)


def long_stay(c=F.col) -> Column:
    return F.when(c("los") >= c("high"), (c("los") - c("high") + 1) * c("high_rate")).otherwise(0.0)


def transfer(c=F.col) -> Column:
    mean = F.round(c("mean"), 0)
    return F.when((c("flat") == 0) & ((c("disch_ext") == 1) | (c("admit_ext") == 1)) & (c("los") < mean), -(mean - c("los")) * c("transfer_rate")).otherwise(0.0)


def case_amount(df: DataFrame) -> DataFrame:
    """amount: day rate (E33; formula 7 by treatment days), by quantity (E2, E32, NUB), else base rate times the effective weight; effective_weight: amount over the base rate."""
    k = F.col("class")
    weight = F.col("weight") + short_stay() + long_stay() + transfer()
    amount = F.when((k == "E33") & (F.col("formula") != 7), F.col("unit_value") * F.col("los")).when((k == "E33") & (F.col("formula") == 7), F.col("unit_value") * F.col("treatment_days")).when(k.isin(*QUANTITY_CLASSES), F.col("unit_value") * F.col("quantity")).otherwise(F.coalesce(F.col("base") * weight, F.lit(0.0)))
    return df.withColumn("amount", F.round(amount, 4)).withColumn("effective_weight", F.round(amount / F.col("base"), 6))


def care_revenue(df: DataFrame) -> DataFrame:
    """(length of stay and corrections) times care weight times care rate; null without a care weight."""
    days = F.col("los") + F.col("nb_audit") - F.col("nb_care")
    return df.withColumn("care_weight_sum", F.when(F.col("care_weight") > 0, F.round(days * F.col("care_weight"), 4))).withColumn("care_amount", F.when(F.col("care_weight") > 0, F.round(days * F.col("care_weight") * F.col("care_rate"), 4)))


def stay_class(df: DataFrame) -> DataFrame:
    los, low, mean, high = (F.col(c) for c in ("los", "low", "mean", "high"))
    kind = F.when(los >= high, "long").when(los <= low, "short").when((los > low) & (los < high), "normal")
    return df.withColumn("stay_class", kind).withColumn("value_class", F.when((los >= mean) & (los < high), "costly").when((los < mean) & (los > low), "profitable"))


def components(df: DataFrame) -> DataFrame:
    """Marks, weights and days of normal, long and short stays and of transfers."""
    los, low, high, mean = F.col("los"), F.col("low"), F.col("high"), F.round("mean", 0)
    a, e, flat = F.col("admit_ext") == 1, F.col("disch_ext") == 1, F.col("flat") == 1
    is_short = (flat | (~a & ~e)) & (los <= low)
    is_move = ~flat & (e | a) & (los < mean)
    normal = (los < high) & ~(((a & ~flat) | flat | (~a & ~e)) & (los <= low)) & ~(~flat & (e | (a & (los >= low))) & (los < mean))
    i = lambda c: c.cast("int")
    return df.select(
        "*", i(normal).alias("is_normal"), F.when(normal, F.col("weight")).alias("normal_weight"), F.when(normal, los).otherwise(0).alias("normal_days"), i(los >= high).alias("is_long"), F.when(los >= high, F.round((los - high + 1) * F.col("high_rate"), 6)).alias("long_weight"), F.when(los >= high, los - high + 1).otherwise(0).alias("long_days"),
        i(is_short).alias("is_short"), F.when(is_short, F.round(-(low - los + 1) * F.col("low_rate"), 6)).alias("short_weight"), F.when(is_short, low - los + 1).otherwise(0).alias("short_days"), i(~flat & e & (los < mean)).alias("moved_out"), i(~flat & a & (los < mean)).alias("moved_in"),
        F.when(is_move, (mean - los).cast("long")).otherwise(0).alias("transfer_days"), F.when(is_move, F.round(-(mean - los) * F.col("transfer_rate"), 6)).otherwise(0.0).alias("transfer_weight"),
    )


def casemix(df: DataFrame, *, year: Column) -> DataFrame:
    """Per year: cases, summed and mean weight."""
    w = F.col("weight").cast("decimal(18,6)")
    return df.groupBy(year.alias("year")).agg(F.count("*").alias("n"), F.sum(w).cast("double").alias("sum_weight"), F.round(F.sum(w).cast("double") / F.count("*"), 6).alias("mean_weight"))
