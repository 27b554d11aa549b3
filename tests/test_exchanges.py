"""Rows are dealt by key once, and what follows stays where it is; results on odd rows."""

import datetime
import json

from pyspark.sql import functions as F

from ebbline import plans
from ebbline.operators import hierarchy, resources, revenue, search, stays
from tests.conftest import SF

QUERIES = plans.queries()


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def written(spark, df) -> int:
    """Bytes that exchanges wrote while all rows were made."""
    total = lambda: sum(e.totalShuffleWrite() for e in map(at, range(n)))
    at, n = (x := spark._jsc.sc().statusStore().executorList(False)).apply, x.length()
    before = total()
    df.write.format("noop").mode("overwrite").save()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    at, n = (x := spark._jsc.sc().statusStore().executorList(False)).apply, x.length()
    return total() - before


def test_slices_are_evaluated_behind_one_exchange(spark):
    """Movements once, days not billable once (its join may be a broadcast); none of the rows by slice."""
    assert exchanges(QUERIES["stay_los_history"](spark, SF)) <= 2
    ts = lambda d, h=8: datetime.datetime(2001, 1, d, h)
    day = lambda d: datetime.date(2001, 1, d)
    rows = [
        (1, 1, "1", ts(1), None, " ", "DRG", day(1), day(4)), (1, 1, "1", ts(1), ts(5), " ", "DRG", day(5), datetime.date(2099, 12, 31)), (1, 2, "3", ts(5), ts(7), " ", "PEPP", day(5), datetime.date(2099, 12, 31)),
        (None, 3, "1", ts(1), ts(2), " ", "DRG", day(1), day(9)), (2, 1, "1", None, None, " ", None, None, day(9)),
    ]
    v = spark.createDataFrame(rows, "case_id int, number int, kind string, begin_ts timestamp, end_ts timestamp, cancelled string, system string, valid_from date, valid_to date").withColumns({"art": F.lit("EN"), "reason": F.lit("01"), "to_hospital": F.lit(0)})
    sliced, _ = stays.by_slice(v)
    s = stays.movements_of_stays(stays.with_system(sliced), keep=("drg", "pepp"))
    got = {(r.case_id, r.slice_id): (str(r.slice_from), str(r.slice_to), r.drg, r.pepp, r.block_days) for r in stays.blocks(stays.prev_next(s), keep=("drg", "pepp")).collect()}
    assert got == {(1, 2): ("2001-01-01", "2001-01-04", 1, 0, 0), (1, 1): ("2001-01-05", "2099-12-31", 1, 1, 6)}


def test_cost_centres_of_cases_are_joined_without_exchanging_them(spark):
    m = spark.range(4000).select(F.col("id").alias("case_id"), (F.col("id") % 3).alias("dept"), (F.col("id") % 50).cast("string").alias("ward"))
    units = spark.range(600).select((F.col("id") % 3).alias("dept"), F.lit("").alias("ward"), F.concat(F.lit("K"), "id").alias("centre"))
    assert written(spark, hierarchy.case_centres(m, units)) < 500_000  # 800,000 rows
    m = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 2, None), (3, None, "a"), (4, 9, "a")], "case_id int, dept int, ward string")
    units = spark.createDataFrame([(1, "a", "K1"), (1, "", "K1"), (2, "", "K1"), (2, "b", "K2"), (2, "b", "K2"), (1, "c", None), (None, "a", "K9"), (1, None, "K9")], "dept int, ward string, centre string")
    got = sorted((tuple(r) for r in hierarchy.case_centres(m, units).collect()), key=repr)
    assert got == sorted([(1, "K1"), (1, "K2"), (2, "K1"), (2, None), (None, "K1")], key=repr)


def test_logins_of_equal_centres_share_their_patients(spark):
    roles = spark.range(300).select(F.concat(F.lit("L"), "id").alias("login"), F.lit("pflege").alias("role"))
    visible = roles.select("login", F.explode(F.array(F.lit("K1"), F.lit("K2"))).alias("centre"))
    centres = spark.range(2000).select(F.col("id").alias("case_id"), F.explode(F.array(F.lit("K1"), F.lit("K2"))).alias("centre"))
    cases = spark.range(2000).select(F.col("id").alias("case_id"), F.col("id").alias("patient_id"))
    df = hierarchy.visible_patients(roles, visible, centres, cases)
    assert written(spark, df) < 1_000_000 and df.count() == df.distinct().count() == 600_000
    roles = spark.createDataFrame([("a", "pflege"), ("b", "pflege"), ("c", "pflege"), ("d", "x")], "login string, role string")
    units = spark.createDataFrame([(1, "", "K1"), (1, "w", "K2"), (2, "w", "K3"), (None, "", "K4")], "dept int, ward string, centre string")
    m = spark.createDataFrame([(1, 1, "w"), (2, 1, None), (3, 2, "w"), (4, None, "w"), (5, 2, "v")], "case_id int, dept int, ward string")
    cases = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 13), (5, 14)], "case_id int, patient_id long")
    visible = spark.createDataFrame([("a", "K1"), ("a", "K2"), ("b", "K3"), ("c", "K4"), ("d", None)], "login string, centre string")
    wards, entries = hierarchy.by_entry(m, units)
    keyed = visible.join(entries, "centre").select("login", F.col("entry").alias("centre"))
    want = sorted([("a", "DEPT", 10), ("a", "DEPT", 11), ("b", "DEPT", None), ("c", "NONE", None), ("d", "NONE", None)], key=repr)
    for seen, by in ((keyed, wards.withColumnRenamed("entry", "centre")), (visible, hierarchy.case_centres(m, units))):
        assert sorted((tuple(r) for r in hierarchy.visible_patients(roles, seen, by, cases).collect()), key=repr) == want


def test_months_of_charges_stay_where_their_cases_are(spark):
    """Movements, flags, days not billable, charges, bands and rates (a few rows) once each; joins may be broadcasts."""
    assert exchanges(QUERIES["pepp_rollup"](spark, SF)) <= 6


def test_blocks_join_no_movements(spark):
    assert exchanges(QUERIES["stay_blocks"](spark, SF)) == 1
    ts = lambda d, h=8: datetime.datetime(2001, 1, d, h)
    rows = [(1, 1, "1", ts(1), ts(3), "01"), (1, 2, "3", ts(3), ts(4), "02"), (1, 3, "6", ts(4), ts(6), "03"), (1, 4, "7", ts(6), ts(6), "04"), (1, 5, "2", ts(7), None, "05"), (2, 9, "1", ts(9), ts(9, 9), None), (None, 1, "1", ts(1), ts(2), "01")]
    m = spark.createDataFrame(rows, "case_id int, number int, kind string, begin_ts timestamp, end_ts timestamp, reason string").withColumns({"cancelled": F.lit(None).cast("string"), "art": F.concat(F.lit("A"), "number"), "to_hospital": F.lit(0)})
    got = sorted((r.case_id, r.block, r.start_number, r.end_number, r.next_art, r.block_days, r.is_last, r.admitted.day, r.discharged.day, r.admission_reason, r.discharge_reason) for r in stays.blocks(stays.prev_next(stays.movements_of_stays(m))).collect())
    assert got == [(1, 1, 1, 2, "A3", 3, 0, 1, 7, "01", "05"), (1, 3, 4, 4, "A5", 0, 0, 1, 7, "01", "05"), (1, 4, 5, 5, None, 0, 1, 1, 7, "01", "05"), (2, 1, 9, 9, None, 0, 0, 9, 9, None, None)]


def test_last_day_rules_add_only_the_flags_of_cases(spark):
    assert exchanges(QUERIES["stay_last_day_rules"](spark, SF)) <= 2


def test_bands_of_a_code_by_length_of_stay(spark):
    """A month's weight for each fitting band, null without one; charges of other classes and of cases without months go."""
    charges = spark.createDataFrame([(1, 1, 5, "E11", 2.0), (2, 2, 5, "E12", 2.0), (3, 3, 6, "E12", 3.0), (4, 4, 7, "E11", 1.0), (1, 5, 5, "E1", 1.0), (9, 6, 5, "E11", 1.0)], "case_id int, charge_id int, code_id int, class string, quantity double")
    weights = spark.createDataFrame([(5, 0, 9, 0.5), (5, 8, 20, 0.7), (6, 30, 40, 0.9), (None, 0, 99, 9.0)], "code_id int, low int, high int, weight double")
    months = spark.createDataFrame([(1, "2001-01-01", 4, 10.0, 8), (1, "2001-02-01", 6, 10.0, 8), (2, "2001-01-01", 3, None, 20), (3, "2001-01-01", 3, 1.0, 2), (4, "2001-01-01", 3, 1.0, None)], "case_id int, month string, occupancy_days int, rate double, los int")
    got = sorted(((r.charge_id, r.month[5:7], r.weight, r.month_weight, r.month_amount) for r in revenue.month_value(charges, weights, months).collect()), key=repr)
    assert got == sorted([(1, "01", 0.5, 2.0, 20.0), (1, "01", 0.7, 2.8, 28.0), (1, "02", 0.5, 3.0, 30.0), (1, "02", 0.7, 4.2, 42.0), (2, "01", 0.7, 1.4, None), (3, "01", None, None, None), (4, "01", None, None, None)], key=repr)
    assert exchanges(QUERIES["pepp_month_value"](spark, SF)) <= 6


def test_months_of_blocks_are_grouped_where_the_blocks_are(spark):
    assert exchanges(QUERIES["los_month_split"](spark, SF)) <= 2


def test_charges_are_not_dealt_by_the_tariff(spark):
    """Base rates have one key and a few years; dealt by these, all charges would meet in one or two tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["drg_amount"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(dealt) > 6 and not [line for line in dealt if "_tariff" in line and "_at#" in line]


def test_team_members_travel_as_numbers(spark):
    p = spark.range(20_000).select(F.col("id").alias("procedure_id"), F.col("id").alias("case_id"), F.lit("5-1").alias("code"), F.lit("2001-01-01").alias("day"), F.lit(" ").alias("cancelled"), F.lit("R").alias("site"), (F.col("id") % 9).alias("unit"))
    owner = spark.range(100).select(F.col("id").alias("case_id"), F.col("id").alias("patient_id"))
    team = p.select("procedure_id", F.col("unit").alias("person"), F.lit("OPT1").alias("task"))
    assert written(spark, resources.procedures(p, owner, team)) < 700_000
    team = spark.createDataFrame([(1, 7, "OPT1"), (1, 3, " OPT1"), (1, 3, "OPT1"), (1, None, "0"), (2, None, None), (None, 5, "OPT1")], "procedure_id long, person long, task string")
    got = {r.id: r.body for r in resources.procedures(p.where("procedure_id < 4"), owner, team).collect()}
    uid = lambda kind, n: spark.range(1).select(resources.CLEAR.rid(kind, F.lit(n))).first()[0]
    crew = lambda n: json.loads(got[uid("Procedure", n)])["performer"][1:]
    assert sorted(x.get("actor", {}).get("reference", "") for x in crew(1)) == sorted(["", *[f"Practitioner/{uid('Practitioner', n)}" for n in (3, 7)]])
    assert crew(2) == [{}] and crew(3) == []


def test_words_are_counted_in_their_row(spark, tmp_path):
    rows = [(1, "b a B c  c-c"), (2, None), (3, ""), (4, "a"), (4, "a"), (None, "x y x")]
    df = search.counted(spark.createDataFrame(rows, "id long, text string"), id="id", text="text")
    assert exchanges(df) == 0
    assert sorted(map(tuple, df.collect()), key=repr) == sorted([(1, 6, "a", 1), (1, 6, "b", 2), (1, 6, "c", 3), (4, 1, "a", 1), (4, 1, "a", 1), (None, 3, "x", 2), (None, 3, "y", 1)], key=repr)
    docs = spark.range(2000).select("id", F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), F.col("id") % (k + 5)) for k in range(40)]).alias("text"))
    total = lambda: sum(x.apply(i).totalShuffleWrite() for x in [spark._jsc.sc().statusStore().executorList(False)] for i in range(x.length()))
    before = total()
    search.write_index(docs, f"file://{tmp_path}/index", id="id", text="text", block_docs=40)
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert total() - before < 1_000_000  # 80,000 pairs of document and word, dealt once
