"""Movements, stays, length of stay and occupancy days.

Stay steps work on one row per movement: case_id, number, kind (1 admission,
2 discharge, 3 transfer, 4 ambulatory, 6 and 7 begin and end of leave), begin_ts,
end_ts and a few attributes.  Movements are dealt by case once; all windows and
groupings after that, by case or by case and slice, need no other exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_cancelled
from .history import islands


def derive(m: DataFrame) -> DataFrame:
    """Real end, unknown-end mark, duration in hours and days, planned mark and time, and the category marks, named after what they test."""
    k, end, off = F.col("kind"), F.when(F.year("end_ts") != 9999, F.col("end_ts")), is_cancelled(F.col("cancelled"))
    hours = ((F.unix_timestamp(end) - F.unix_timestamp("begin_ts")) / 3600).cast("long")
    mark = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return m.select(
        "*", end.alias("real_end"), mark(F.col("end_ts").isNull() | (F.year("end_ts") == 9999)).alias("end_unknown"), hours.alias("hours"), F.datediff(end, "begin_ts").alias("days"), mark(k == "1").alias("is_admission"), mark(k == "2").alias("is_discharge"),
        mark((k == "1") & off).alias("is_cancelled_admission"), mark((k == "2") & off).alias("is_cancelled_discharge"), mark((k == "4") & ~F.col("art").isin("VB", "AO") & off).alias("is_cancelled_ambulatory"),
        mark((F.col("art") == "VB") & off).alias("is_cancelled_prestationary"), mark((F.col("art") == "AO") & off).alias("is_cancelled_day_surgery"), mark((k == "1") & (F.col("day_patient") == 1) & off).alias("is_cancelled_day_patient"),
        mark((k == "1") & F.col("reason").isin("01", "02", "08")).alias("is_audit_relevant"), mark(F.col("planned") == "P").alias("is_planned"), F.when(F.col("planned") == "P", F.col("planned_ts")).alias("planned_at"),
    )


def cube(m: DataFrame, cases: DataFrame, units: DataFrame, centres: DataFrame) -> DataFrame:
    """Movements of cases with an admission, with case, unit and cost centre (by department and ward, else by department and *)."""
    real = m.where((F.col("kind") == "1") & ~is_cancelled(F.col("cancelled"))).select("case_id").distinct()
    out = m.where(~is_cancelled(F.col("cancelled"))).groupBy("case_id").agg(F.max((F.col("kind") == "2").cast("int")).alias("discharged"))
    rows = m.join(real, "case_id", "left_semi").join(out, "case_id", "left").join(cases.select("case_id", "patient_id", "case_type"), "case_id", "left").join(units.select(F.col("unit_id").alias("ward"), "unit_name"), "ward", "left")
    exact = centres.where("ward_key <> '*'").select("dept", F.col("ward_key").alias("_w"), F.col("centre").alias("_a"))
    wild = centres.where("ward_key = '*'").select("dept", F.col("centre").alias("_b"))
    rows = rows.withColumn("_w", F.col("ward").cast("string")).join(exact, ["dept", "_w"], "left").join(wild, "dept", "left")
    return rows.withColumn("centre", F.coalesce("_a", "_b")).drop("_w", "_a", "_b")


def with_case(m: DataFrame, cases: DataFrame, merged: DataFrame) -> DataFrame:
    """Movements that took place (a null plan mark counts as none) with their case, without cases that follow another in their billing group."""
    m = m.where(F.coalesce("planned", F.lit("")) != "P")
    return m.join(cases.join(merged.where("lead <> 'X'").select("case_id"), "case_id", "left_anti").select("case_id", "patient_id", "begin_date"), "case_id")


#: What tells the slices of a case apart, where rows have them.
SLICE = ("slice_id", "slice_from", "slice_to")


def _by(df: DataFrame) -> list[str]:
    """What is evaluated for itself: a case, or a slice of its time."""
    return ["case_id", *[c for c in SLICE if c in df.columns]]


def movements_of_stays(m: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Live movements of in-patient kinds, one row per number and kind with the latest begin and end (the begin where none); ``keep`` are columns with one value per case."""
    by = _by(m)
    live = m.where(~is_cancelled(F.col("cancelled")) & F.col("kind").isin("1", "2", "3", "6", "7")).select(*by, "number", "kind", "begin_ts", F.coalesce("end_ts", "begin_ts").alias("end_ts"), "art", "reason", F.col("to_hospital").alias("external"), *keep)
    if by == ["case_id"]:  # slices are made of rows that are dealt already
        live = live.repartition("case_id")
    return live.groupBy(*by, "number", "kind").agg(*[F.max(c).alias(c) for c in ("begin_ts", "end_ts", "art", "reason", "external", *keep)])


def pairs(s: DataFrame, *, now) -> DataFrame:
    """Each admission of a case with each discharge: period_id, discharge (else the movement that ends last), its time, days (to ``now`` for open cases), same-day mark."""
    by = _by(s)
    a = s.where("kind = '1'").select(*by, F.col("number").alias("admission"), F.col("begin_ts").alias("admitted"))
    d = s.where("kind = '2'").select(*by, F.col("number").alias("_d"), F.col("end_ts").alias("_t"))
    last = s.groupBy(*by).agg(F.max_by("number", F.struct("end_ts", "number")).alias("_l"), F.max("end_ts").alias("_m"))
    rows = a.join(d, by, "left").join(last, by)
    period = F.dense_rank().over(Window.partitionBy(*by).orderBy("admission", F.coalesce("_d", F.lit(0))))
    until = F.coalesce("_t", F.lit(now).cast("timestamp"))
    return rows.select(*by, period.alias("period_id"), "admission", "admitted", F.coalesce("_d", "_l").alias("discharge"), F.coalesce("_t", "_m").alias("discharged"), F.col("_d").isNull().cast("int").alias("discharge_unknown"), F.datediff(until, "admitted").alias("days"), (F.to_date("admitted") == F.to_date(until)).cast("int").alias("same_day"))


def time_slices(df: DataFrame, key: str) -> DataFrame:
    """Slices between all distinct starts and ends+1 of the versions of a key, numbered newest first."""
    starts = df.select(key, F.col("valid_from").alias("stamp")).unionByName(df.where(F.year("valid_to") < 2099).select(key, F.date_add("valid_to", 1).alias("stamp"))).distinct()
    w = Window.partitionBy(key)
    return starts.select(key, F.row_number().over(w.orderBy(F.desc("stamp"))).alias("slice_id"), F.col("stamp").alias("valid_from"), F.coalesce(F.date_sub(F.lead("stamp").over(w.orderBy("stamp")), 1), F.lit("2099-12-31").cast("date")).alias("valid_to"))


def by_slice(versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The versions of a case's rows as they stood in each slice of its time, and the slices with their validity.

    Rows have the slice's number and validity (``SLICE``) beside the case, so that
    every step by case (pairs, previous and next, blocks, length of stay) evaluates
    each slice for itself.  The versions are dealt by case once: a window gathers a
    case's starts and ends, each version is laid into the slices that begin
    within its validity, and what follows stays where it is.
    """
    last = F.lit("2099-12-31").cast("date")
    of = Window.partitionBy("case_id")
    ends = F.when(F.year("valid_to") < 2099, F.date_add("valid_to", 1))
    rows = versions.where("case_id is not null").withColumn("_cuts", F.array_sort(F.array_union(F.collect_set("valid_from").over(of), F.collect_set(ends).over(of))))
    span = lambda x, i: F.struct((F.size("_cuts") - i).cast("int").alias("slice_id"), x.alias("slice_from"), F.coalesce(F.date_sub(F.get("_cuts", i + 1), 1), last).alias("slice_to"))
    held = F.filter(F.transform("_cuts", span), lambda x: x["slice_from"].between(F.col("valid_from"), F.col("valid_to")))
    rows = rows.withColumn("_slice", F.explode(held)).select(*[c for c in versions.columns if c not in ("valid_from", "valid_to")], "_slice.*")
    return rows, time_slices(versions, "case_id")


def los_history(days: DataFrame, slices: DataFrame | None = None) -> DataFrame:
    """Versions of a case's length of stay: of the figures by slice (``length_of_stay`` on sliced rows), adjacent slices with equal figures as one, ranked newest first.

    A slice in which the case has no stay breaks the run and has no version.
    ``slices`` are those that count, if not all do.
    """
    figures = ("treatment_days", "occupancy_days", "not_billable", "admitted", "discharged", "los")
    days = days if slices is None else days.join(slices.select("case_id", "slice_id"), ["case_id", "slice_id"], "left_semi")
    rows = days.select("case_id", F.col("slice_from").alias("valid_from"), F.col("slice_to").alias("valid_to"), F.struct(*figures).alias("_v"))
    whole = islands(rows, ["case_id"], value="_v", unit="DAY")
    version = F.dense_rank().over(Window.partitionBy("case_id").orderBy(F.desc("valid_from")))
    return whole.select("case_id", "_v.*", F.to_date("valid_from").alias("valid_from"), F.to_date("valid_to").alias("valid_to"), version.cast("int").alias("version"))


def prev_next(s: DataFrame) -> DataFrame:
    """Next number, day gap to the previous end, latest earlier end and earliest later begin without leave, position from the end."""
    w, n = Window.partitionBy(*_by(s)), ["number"]
    by_kind = w.orderBy("begin_ts", "kind", *n)
    stay = F.col("kind") != "6"
    return s.select(
        "*", F.lead("number").over(w.orderBy("begin_ts", *n)).alias("next_number"), F.coalesce(F.datediff("begin_ts", F.lag("end_ts").over(w.orderBy(F.col("begin_ts"), F.desc("kind"), *n))), F.lit(0)).alias("gap"),
        F.max(F.when(stay, F.col("end_ts"))).over(by_kind.rowsBetween(Window.unboundedPreceding, -1)).alias("prev_end"), F.min(F.when(stay, F.col("begin_ts"))).over(by_kind.rowsBetween(1, Window.unboundedFollowing)).alias("next_begin"),
        F.row_number().over(w.orderBy(F.desc("begin_ts"), *n)).alias("pos"),
    )


#: Marks of movements that a case carries if any of its movements does.
FLAGS = ("died", "newborn", "delivery", "companion", "companion_medical", "from_hospital", "to_hospital", "prestationary", "poststationary", "day_patient", "ambulatory_surgery", "surgery", "emergency")


def _paid(name: str) -> Column:
    return F.max(F.coalesce(F.col("system") == name, F.lit(False)).cast("int"))


def case_flags(m: DataFrame, flags: tuple[str, ...] = FLAGS) -> DataFrame:
    """Per case whether some movement is paid by day (PEPP) or by DRG (column ``system``), each flag (0 or 1; null as 0) and the largest label."""
    return m.groupBy(*_by(m)).agg(_paid("PEPP").alias("pepp"), _paid("DRG").alias("drg"), *[F.max(F.coalesce(f, F.lit(0))).alias(f) for f in flags], F.max("label").alias("label"))


def with_system(m: DataFrame) -> DataFrame:
    """Movements with ``pepp`` and ``drg`` of their case, as ``case_flags`` has them, by a window: for rows that are dealt by case already."""
    of = Window.partitionBy(*_by(m))
    return m.select("*", _paid("PEPP").over(of).alias("pepp"), _paid("DRG").over(of).alias("drg"))


def blocks(p: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Gap-free blocks of a case: a new one at a day gap or at leave; with first and last movement and what follows (``external``: whether that leaves the house).

    The next movement and the figures of the whole case come by windows, so that no movement is joined with another.
    """
    by = _by(p)
    case = Window.partitionBy(*by)
    w = case.orderBy("begin_ts", "kind", "number").rowsBetween(Window.unboundedPreceding, 0)
    after = F.lead(F.struct("number", "kind", "begin_ts", "end_ts", "art", "external", "gap")).over(case.orderBy("begin_ts", "number", "kind"))
    z = p.where("case_id is not null").withColumn("_n", after).where("gap >= 0")
    z = z.withColumn("_n", F.when((F.col("_n.gap") >= 0) & F.col("_n.number").isNotNull(), F.col("_n")))
    nxt = {"next_art": F.when(F.col("_n.kind").isin("2", "6"), F.col("_n.art")), "next_day0": ((F.col("_n.kind") == "6") & (F.datediff("_n.end_ts", "_n.begin_ts") == 0)).cast("int"), "next_external": F.col("_n.external")}
    whole = {"admitted": F.min("begin_ts"), "discharged": F.max("end_ts"), "admission_reason": F.min_by("reason", F.struct("begin_ts", "number")), "discharge_reason": F.max("reason")}
    block = (F.sum(((F.col("gap") != 0) | F.col("kind").isin("6", "7")).cast("int")).over(w) + 1).cast("long")
    z = z.select("*", block.alias("block"), *[c.alias(k) for k, c in nxt.items()], *[c.over(case).alias(k) for k, c in whole.items()]).drop("_n")
    first = F.struct("pos", "number", "kind", "begin_ts", "gap", "prev_end", *whole, *keep)
    last = F.struct(F.col("pos"), F.col("number"), F.col("kind"), F.col("end_ts"), F.col("art"), F.col("next_art"), F.col("next_day0"), F.coalesce("next_external", "external").alias("external"), F.col("next_begin"))
    g = z.where("kind <> '6'").groupBy(*by, "block").agg(F.max_by(first, "pos").alias("a"), F.min_by(last, "pos").alias("z"))
    return g.select(
        *by, "block", F.col("a.number").alias("start_number"), F.col("a.kind").alias("start_kind"), F.col("a.begin_ts").alias("start_ts"), F.col("a.gap").alias("start_gap"), F.col("a.prev_end").alias("prev_end"), F.col("z.number").alias("end_number"), F.col("z.end_ts").alias("end_ts"),
        F.col("z.art").alias("end_art"), F.col("z.next_art").alias("next_art"), F.col("z.next_day0").alias("next_day0"), F.col("z.external").alias("external"), (F.col("z.kind") == "2").cast("int").alias("is_last"), F.datediff("z.end_ts", "a.begin_ts").alias("block_days"), *[F.col(f"a.{k}").alias(k) for k in (*whole, *keep)],
    )


def last_day_rules(b: DataFrame) -> DataFrame:
    """rule1 to rule7, each its own column, and last_day, whether the block's last day counts."""
    drg, pepp = F.col("drg") == 1, F.col("pepp") == 1
    begins_e = lambda c: F.substring(c, 1, 1) == "E"
    rules = [
        drg & (F.col("external") == 0) & (F.col("is_last") == 0) & ~begins_e("next_art") & (F.col("next_day0") == 0),
        drg & (F.col("admission_reason") == "03"),
        drg & begins_e("end_art") & (F.col("block_days") == 0) & (F.col("start_gap") > 0),
        drg & (F.col("next_day0") == 1) & begins_e("next_art") & (F.col("block_days") == 0),
        pepp & ((F.col("next_day0") == 0) | begins_e("next_art")) & ~F.col("discharge_reason").isin("17", "22"),
        drg & (F.to_date("start_ts") > F.to_date("prev_end")) & (F.col("is_last") == 1) & (F.col("block_days") == 0) & (F.col("start_kind") != "7"),
        F.to_date("admitted") == F.to_date("discharged"),
    ]
    out = b.withColumns({f"rule{i + 1}": F.coalesce(r, F.lit(False)).cast("int") for i, r in enumerate(rules)})
    return out.withColumn("last_day", F.greatest(*[F.col(f"rule{i + 1}") for i in range(7)]))


def length_of_stay(b: DataFrame, *, not_billable: Column) -> DataFrame:
    """Per case: treatment days, occupancy days (with counted last days), length of stay (without days not billable)."""
    g = b.withColumn("_nb", not_billable).groupBy(*_by(b)).agg(F.sum("block_days").alias("treatment_days"), F.sum(F.col("block_days") + F.col("last_day")).alias("occupancy_days"), F.max("_nb").alias("not_billable"), F.min("admitted").alias("admitted"), F.max("discharged").alias("discharged"))
    return g.withColumn("los", F.col("occupancy_days") - F.col("not_billable"))


def with_los(b: DataFrame, *, not_billable: Column) -> DataFrame:
    """Blocks with the length of stay of their case (``los``), as ``length_of_stay`` has it."""
    of = Window.partitionBy(*_by(b))
    return b.withColumn("_nb", not_billable).withColumn("los", F.sum(F.col("block_days") + F.col("last_day")).over(of) - F.max("_nb").over(of)).drop("_nb")


def month_split(b: DataFrame, *, least: tuple[str, ...] = ()) -> DataFrame:
    """Blocks cut into months: treatment days, counted last days and occupancy days per case and month; of the columns ``least`` the least value.

    The months of a block are made by ``sequence``, so no calendar is joined.
    """
    months = F.explode(F.sequence(F.trunc("start_ts", "month"), F.trunc("end_ts", "month"), F.expr("interval 1 month"))).alias("month")
    x = b.where("end_ts >= start_ts").select("case_id", "start_ts", "end_ts", "last_day", *least, months)
    stop = F.timestamp_add("SECOND", F.lit(-1), F.add_months("month", 1).cast("timestamp"))
    begin, end = F.greatest("start_ts", F.col("month").cast("timestamp")), F.least("end_ts", stop)
    last = F.when(F.col("end_ts").between(F.col("month").cast("timestamp"), stop), F.col("last_day")).otherwise(0) + F.when(F.col("end_ts") >= stop, 1).otherwise(0)
    x = x.select("case_id", "month", *least, F.datediff(end, begin).alias("t"), last.alias("l"))
    return x.groupBy("case_id", "month").agg(F.sum("t").alias("treatment_days"), F.sum("l").alias("last_days"), F.sum(F.col("t") + F.col("l")).alias("occupancy_days"), *[F.min(c).alias(c) for c in least])


def month_rates(months: DataFrame, rates: DataFrame) -> DataFrame:
    """Months with the base rate valid on their first day: an equi-join by year, then the range; rates are few rows a year, so the months are not dealt by year."""
    r = F.broadcast(rates.select(F.explode(F.sequence(F.year("valid_from"), F.year("valid_to"))).alias("_y"), "valid_from", "valid_to", "rate"))
    return months.withColumn("_y", F.year("month")).join(r, "_y", "left").where(F.col("rate").isNull() | F.col("month").between(F.col("valid_from"), F.col("valid_to"))).drop("_y", "valid_from", "valid_to")


def month_versions(versions: DataFrame, rates: DataFrame, *, values: list[str]) -> DataFrame:
    """Versions (case_id, month, valid_from, valid_to, admitted, values) with adjacent ones of equal values as one, ranked newest first, and the base rate valid on the day of admission.

    Values are compared by their hash; a null is a value of its own.
    """
    figures = (*values, "admitted")
    hash_id = F.sha1(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(v).cast("string")), F.lit("~")) for v in figures])).alias("hash_id")
    whole = islands(versions.withColumn("_v", F.struct(hash_id, *figures)), ["case_id", "month"], value="_v", unit="DAY").drop("n")
    out = whole.select("case_id", "month", "_v.*", "valid_from", "valid_to").withColumn("version", F.dense_rank().over(Window.partitionBy("case_id", "month").orderBy(F.desc("valid_from"))))
    r = rates.select(F.explode(F.sequence(F.year("valid_from"), F.year("valid_to"))).alias("_y"), F.col("valid_from").alias("_a"), F.col("valid_to").alias("_z"), "rate")
    day = F.to_date("admitted")
    return out.withColumn("_y", F.year(day)).join(r, "_y", "left").where(F.col("rate").isNull() | day.between(F.col("_a"), F.col("_z"))).drop("_y", "_a", "_z")
