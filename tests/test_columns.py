"""Column rules by value."""

import base64
import datetime
import hashlib
import hmac
import uuid

import pytest
from pyspark.sql import functions as F

from ebbline.functions import columns as c
from ebbline.operators import history, resources

SECRET = b"geheim"


def values(spark, make, *inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[1] for r in sorted(df.select("i", make(F.col("x")).alias("y")).collect())]


@pytest.mark.parametrize(
    "make, given, want",
    [
        (c.lab_number, ["2,5", "1.234,56", "1,234.56", "positiv", "", None, "-3", "12"], [2.5, 1234.56, 1234.56, None, None, None, -3.0, 12.0]),
        (c.lab_comparator, ["<0,05", "≥ 3", "4"], ["<", ">=", None]),
        (c.lab_quantity, ["<0,05", "≥ 3", "negativ"], [0.05, 3.0, None]),
        (lambda x: c.lab_range(x)[0], ["26 - 150", "bis 150", "ab 7", "negativ"], [26.0, None, 7.0, None]),
        (lambda x: c.lab_range(x)[1], ["26 - 150", "bis 150", "ab 7", "<3,5"], [150.0, 150.0, None, 3.5]),
        (lambda x: c.lab_range(x)[2], ["26 - 150", "negativ", ""], [None, "negativ", None]),
        (c.real_date, ["0101-01-01", "9999-12-31", "2026-02-03", "", None], [None, None, "2026-02-03", None, None]),
        (c.icd_group, ["i50.14", "J36", "x"], ["I50", "J36", None]),
        (
            c.iso_normalize,
            ["20240115T081500", "20240715T081500", "20240115T240000", "20240230", "2024-02-29", "18000101", "2024-01", "2024-07-01 10:30:00"],
            ["2024-01-15T08:15:00+01:00", "2024-07-15T08:15:00+02:00", "2024-01-15T23:59:59+01:00", "20240230", "2024-02-29", "18000101", "2024-01", "2024-07-01T10:30:00+02:00"],
        ),
        (c.deid_text, ["am 3.4.2020 Frau Muster a@b.de AB1234567", "Frau MÜLLER und herr müller, Dr. Meier", "PROF. ÖZ und ä3.4.2020 ü@ö.de", None], ["am [DATUM] Frau [NAME] [EMAIL] [ID]", "Frau [NAME] und herr [NAME], Dr. [NAME]", "PROF. [NAME] und ä3.4.2020 [EMAIL]", None]),
        (lambda x: c.lookup(F.lower(x), c.UNITS), ["umol/l", "mmHg", "/nl", "pg/ml", "min", "IU/L", "foo", None], ["umol/L", "mm[Hg]", "/nL", "pg/mL", "min", "[IU]/L", None, None]),
        (c.allergy_category, ["000001", "000007", "000015", "000016", "999999"], ["medication", "biologic", "environment", None, None]),
        (lambda x: c.risk_class(x, F.lit("MRSA")), ["000001", "000017", "999999"], ["allergy", "infection", "infection"]),
        (lambda x: c.is_cancelled(x), ["X", " ", "", "1", None, "0"], [True, False, False, True, False, False]),
        (c.code_concept, [" a ", "0", "", None], ["a", None, None, None]),
        (c.clean_text, [" a\t\nb  c "], ["a b c"]),
    ],
)
def test_values(spark, make, given, want):
    assert values(spark, make, *given) == want


def test_ids_equal_the_standard_library(spark):
    ids = ["1", "42", "äö"]
    assert values(spark, lambda x: c.stable_id(resources.NAMESPACE, "T", x, F.lit(None)), *ids) == [str(uuid.uuid5(uuid.UUID(resources.NAMESPACE), f"T|{i}")) for i in ids]
    mac = lambda m: hmac.new(SECRET, m.encode(), hashlib.sha256).digest()
    assert values(spark, lambda x: c.pseudonym(SECRET, x), *ids) == ["P" + base64.b32encode(mac(i))[:16].decode() for i in ids]
    assert values(spark, lambda x: c.hash_id(SECRET, x, "kvnr"), *ids) == ["KVN" + base64.b32encode(mac("kvnr:" + i))[:14].decode() for i in ids]
    assert values(spark, lambda x: c.shift_days(SECRET, x), *ids) == [int.from_bytes(mac("shift:" + i)[:4], "big") % 731 - 365 for i in ids]


def test_shift_keeps_lengths_and_sentinels(spark):
    a, b = "2026-02-02", "2026-02-09"
    got = values(spark, lambda x: c.date_shift(SECRET, F.lit("7"), x), a, b, "0101-01-01", "2026-02-02T10:00:00", None, "1899-06-01", "9999-12-31")
    day = datetime.date.fromisoformat
    assert day(got[1]) - day(got[0]) == datetime.timedelta(days=7) and got[0] != a
    assert got[2] == "0101-01-01" and got[3] == got[0] + "T10:00:00" and got[4] is None
    assert got[5] != "1899-06-01" and (day(got[5]) - day("1899-06-01")) == (day(got[0]) - day(a)) and got[6] == "9999-12-31"


def test_gap_rules(spark):
    """An insert after an insert lacks the delete between; a last update lacks its delete."""
    rows = [("k", "1", "I", "2024-01-02", "a"), ("k", "2", "I", "2024-01-05", "b"), ("k", "3", "U", "2024-01-07", "c")]
    df = spark.createDataFrame(rows, "key string, change_seq string, change_type string, t string, hash_id string").select("*", F.to_timestamp("t").alias("change_time"), F.lit(0).alias("storno"), F.lit(None).cast("timestamp").alias("storno_date"), F.to_timestamp(F.lit("2024-01-01")).alias("created"))
    got = history.gap_fill(history.gap_classify(history.sequence(df, ["key"]), ["key"])).orderBy("seq_id").collect()
    assert [(r.seq_id, r.change_type, r.hash_id) for r in got] == [(2, "I", "a"), (3, "D", "a"), (4, "I", "b"), (6, "U", "c"), (7, "D", "c")]
    assert got[0].change_time.day == 1 and got[1].change_time < got[2].change_time
