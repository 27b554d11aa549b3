"""Queries of column rules and nested resources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import resources as r
from ..sources.shared import new_path
from ..sources.sinks import read_resources, write_ndjson, write_resources
from ..sources.sinks import resource_index as index
from . import resource_sql as sql
from .base import duck, table, view
from .marts import _TEXTS, _texts
from .network import _MEMBERS, members
from .resource_sql import PRIV, SECRET

QUERIES, SQL = {}, {}
def query(body: str | None = None, *names: str):
    def put(f):
        QUERIES[f.__name__] = f
        if body is not None:
            SQL[f.__name__] = duck(body, *names)
        return f

    return put


_STABLE = f""", u AS (SELECT case_id, sha1(from_hex('{r.NAMESPACE.replace("-", "")}') || encode(concat_ws('|', 'Encounter', CAST(case_id AS VARCHAR), CASE WHEN case_id % 3 = 0 THEN CAST(patient_id AS VARCHAR) END))) AS h FROM cases)
SELECT case_id, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '5' || substr(h, 14, 3), substr('89ab', CAST('0x' || substr(h, 17, 1) AS BIGINT) % 4 + 1, 1) || substr(h, 18, 3), substr(h, 21, 12)) AS id FROM u"""
_SHIFT = ", s AS (SELECT *, CAST(CAST('0x' || substr(" + sql.hmac_sql("'shift:' || CAST(patient_id AS VARCHAR)") + ", 1, 8) AS BIGINT) % 731 - 365 AS INTEGER) AS days FROM cases) SELECT case_id, patient_id, CAST(begin_date + days AS VARCHAR) AS begin, CAST(end_date + days AS VARCHAR) AS \"end\" FROM s"
NUM = "CASE WHEN regexp_full_match({t}, '[+-]?\\d*\\.?\\d+') THEN CAST({t} AS DOUBLE) END"


def _num(x: str) -> str:
    t = f"CASE WHEN {x} LIKE '%,%' AND {x} LIKE '%.%' THEN CASE WHEN strpos(reverse({x}), ',') < strpos(reverse({x}), '.') THEN replace(replace({x}, '.', ''), ',', '.') ELSE replace({x}, ',', '') END WHEN {x} LIKE '%,%' THEN replace({x}, ',', '.') ELSE {x} END"
    return NUM.format(t=f"({t})")


_LAB = ", lb AS (SELECT lab_id, raw, normal, flag, unit, status, trim(regexp_replace(raw, '^(<=|>=|<|>)\\s*', '')) AS body, regexp_extract(raw, '^(<=|>=|<|>)', 1) AS comp FROM labs), lq AS (SELECT *, " + _num("body") + " AS q, CASE WHEN normal = '10 - 150' THEN 10.0 WHEN normal = '> 20' THEN 20.0 END AS lo, CASE WHEN normal = '10 - 150' THEN 150.0 WHEN normal = 'bis 50,5' THEN 50.5 END AS hi FROM lb)"


@query(_STABLE, "cases")
def stable_id(spark, d):
    return view(spark, d, "cases").select("case_id", c.stable_id(r.NAMESPACE, "Encounter", F.col("case_id"), F.when(F.col("case_id") % 3 == 0, F.col("patient_id"))).alias("id"))


@query("SELECT case_id, CASE WHEN end_date IS NULL THEN NULL ELSE CAST(end_date AS VARCHAR) END AS real FROM cases", "cases")
def real_date(spark, d):
    s = F.when(F.col("end_date").isNull(), F.when(F.col("case_id") % 2 == 0, "0101-01-01").otherwise("9999-12-31")).otherwise(F.col("end_date").cast("string"))
    return view(spark, d, "cases").select("case_id", c.real_date(s).alias("real"))


@query("SELECT lab_id, CASE WHEN lab_id % 4 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS stamp FROM labs WHERE strftime(ts, '%H:%M') <> '00:00'", "labs")
def combine_datetime(spark, d):
    t = F.when(F.col("lab_id") % 4 == 0, "00:00:00").otherwise(F.date_format("ts", "HH:mm:ss"))
    return view(spark, d, "labs").where(F.date_format("ts", "HH:mm") != "00:00").select("lab_id", c.combine_datetime(F.date_format("ts", "yyyy-MM-dd HH:mm"), t).alias("stamp"))


@query("SELECT code_id, CASE WHEN size % 7 = 0 THEN NULL ELSE CAST(size % 7 AS VARCHAR) END AS code, CASE WHEN size % 5 = 0 THEN NULL ELSE '00' || size % 5 END AS ref FROM codes", "codes")
def code_concept(spark, d):
    return view(spark, d, "codes").select("code_id", c.code_concept(F.concat(F.lit(" "), (F.col("size") % 7).cast("string"), F.lit(" "))).alias("code"), c.valid_ref(F.concat(F.lit("00"), (F.col("size") % 5).cast("string"))).alias("ref"))


@query("SELECT code_id, CASE WHEN size % 5 = 0 THEN NULL ELSE '00' || size % 5 END AS ref FROM codes", "codes")
def valid_ref(spark, d):
    return view(spark, d, "codes").select("code_id", c.valid_ref(F.concat(F.lit("00"), (F.col("size") % 5).cast("string"))).alias("ref"))


@query(_LAB + " SELECT lab_id, q AS number FROM lq", "labs")
def lab_number_parse(spark, d):
    return view(spark, d, "labs").select("lab_id", c.lab_quantity(F.col("raw")).alias("number"))


@query(_LAB + " SELECT lab_id, nullif(comp, '') AS comparator, q AS number, CASE WHEN q IS NULL THEN trim(raw) END AS text FROM lq", "labs")
def lab_value_parse(spark, d):
    return view(spark, d, "labs").select("lab_id", c.lab_comparator(F.col("raw")).alias("comparator"), c.lab_quantity(F.col("raw")).alias("number"), c.lab_text(F.col("raw")).alias("text"))


@query(_LAB + " SELECT lab_id, CAST(lo AS DOUBLE) AS low, CAST(hi AS DOUBLE) AS high, CASE WHEN normal = 'negativ' THEN normal END AS text FROM lq", "labs")
def lab_range_parse(spark, d):
    low, high, text = c.lab_range(F.col("normal"))
    return view(spark, d, "labs").select("lab_id", low.alias("low"), high.alias("high"), text.alias("text"))


@query(_LAB + " SELECT lab_id, CASE WHEN flag = '+' THEN 'H' WHEN flag <> '' THEN flag WHEN q > hi THEN 'H' WHEN q < lo THEN 'L' WHEN q IS NOT NULL AND (lo IS NOT NULL OR hi IS NOT NULL) THEN 'N' END AS interpretation FROM lq", "labs")
def lab_interpret(spark, d):
    low, high, _ = c.lab_range(F.col("normal"))
    parsed = view(spark, d, "labs").withColumns({"low": low, "high": high, "q": c.lab_quantity(F.col("raw"))})
    return parsed.select("lab_id", c.lab_interpret(F.col("flag"), F.col("q"), F.col("low"), F.col("high")).alias("interpretation"))


@query("SELECT lab_id, CASE status WHEN 'F' THEN 'final' WHEN 'P' THEN 'preliminary' WHEN 'C' THEN 'corrected' ELSE 'final' END AS state, CASE unit WHEN 'mg/dl' THEN 'mg/dL' WHEN 'Tsd/ul' THEN '10*3/uL' WHEN '%' THEN '%' WHEN 'umol/l' THEN 'umol/L' WHEN 'IU/l' THEN '[IU]/L' WHEN 'mmHg' THEN 'mm[Hg]' WHEN '/nl' THEN '/nL' WHEN 'g/mol' THEN 'g/mol' WHEN 'pg/ml' THEN 'pg/mL' WHEN 'mval/l' THEN 'meq/L' WHEN 'min' THEN 'min' END AS ucum FROM labs", "labs")
def unit_ucum(spark, d):
    return view(spark, d, "labs").select("lab_id", c.lookup(F.upper("status"), c.LAB_STATES, "final").alias("state"), c.lookup(F.lower("unit"), c.UNITS).alias("ucum"))


@query("SELECT CASE trim(case_type) WHEN '1' THEN 'IMP' WHEN '2' THEN 'AMB' WHEN '3' THEN 'SS' END AS class, count(*) AS n FROM cases GROUP BY 1", "cases")
def code_maps(spark, d):
    return view(spark, d, "cases").groupBy(c.lookup(F.col("case_type"), c.CASE_TYPES).alias("class")).agg(F.count("*").alias("n"))


@query("SELECT lab_id, CASE status WHEN 'P' THEN 'preliminary' WHEN 'C' THEN 'corrected' ELSE 'final' END AS state FROM labs", "labs")
def lab_status(spark, d):
    return view(spark, d, "labs").select("lab_id", c.lookup(F.upper("status"), c.LAB_STATES, "final").alias("state"))


@query("SELECT patient_id, CASE sex WHEN '1' THEN 'male' WHEN '2' THEN 'female' WHEN '3' THEN 'other' ELSE 'unknown' END AS gender FROM patients", "patients")
def sex(spark, d):
    return view(spark, d, "patients").select("patient_id", c.lookup(F.col("sex"), c.SEXES, "unknown").alias("gender"))


@query("SELECT case_id, CASE case_type WHEN '1' THEN 'IMP' WHEN '2' THEN 'AMB' WHEN '3' THEN 'SS' END AS class FROM cases", "cases")
def case_type(spark, d):
    return view(spark, d, "cases").select("case_id", c.lookup(F.col("case_type"), c.CASE_TYPES, "IMP").alias("class"))


@query("SELECT case_id, number, CASE kind WHEN '1' THEN 'Aufnahme' WHEN '2' THEN 'Entlassung' WHEN '3' THEN 'Verlegung' WHEN '4' THEN 'ambulanter Besuch' WHEN '6' THEN 'Abwesenheit Beginn' WHEN '7' THEN 'Abwesenheit Ende' ELSE 'Bewegung' END AS text FROM movements", "movements")
def movement_type(spark, d):
    return view(spark, d, "movements").select("case_id", "number", c.lookup(F.col("kind"), c.MOVEMENT_TYPES, "Bewegung").alias("text"))


@query("SELECT code_id, CASE WHEN code_id % 60 BETWEEN 1 AND 16 OR code_id % 60 IN (22, 23) THEN 'allergy' WHEN code_id % 60 IN (0, 17, 19, 20, 21, 24, 25, 26, 29, 30, 31, 34, 35, 36, 39, 41, 43, 45, 53) THEN 'infection' ELSE 'admin' END AS class FROM codes", "codes")
def risk_class(spark, d):
    return view(spark, d, "codes").select("code_id", c.risk_class(F.lpad((F.col("code_id") % 60).cast("string"), 6, "0"), F.col("text")).alias("class"))


@query("SELECT lab_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+01:00' AS iso FROM labs", "labs")
def iso_normalize(spark, d):
    raw = F.when(F.col("lab_id") % 2 == 0, F.date_format("ts", "yyyyMMdd'T'HHmmss")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return view(spark, d, "labs").select("lab_id", c.iso_normalize(raw).alias("iso"))


@query("SELECT case_id, strftime(begin_date, '%Y-%m-%d') AS start_iso, strftime(end_date, '%Y-%m-%d') AS end_iso, case_type FROM cases", "cases")
def iso_normalize_tree(spark, d):
    k = view(spark, d, "cases").select("case_id", F.struct(F.date_format("begin_date", "yyyyMMdd").alias("start"), F.date_format("end_date", "yyyyMMdd").alias("end")).alias("period"), "case_type")
    k = k.withColumn("period", F.struct(c.iso_normalize(F.col("period.start")).alias("start"), c.iso_normalize(F.col("period.end")).alias("end")))
    return k.select("case_id", F.col("period.start").alias("start_iso"), F.col("period.end").alias("end_iso"), "case_type")


@query("SELECT regexp_extract(upper(trim(code)), '^([A-Z][0-9]{2})', 1) AS grp, count(*) AS n FROM diagnoses GROUP BY 1", "diagnoses")
def icd_group(spark, d):
    return view(spark, d, "diagnoses").groupBy(c.icd_group(F.col("code")).alias("grp")).agg(F.count("*").alias("n"))


@query(", mp AS (SELECT 'view' AS code, '1-1' AS loinc UNION ALL SELECT 'purchase', '2-2') SELECT code, count(*) AS n, avg(CASE WHEN loinc IS NOT NULL THEN 1.0 ELSE 0.0 END) AS hit FROM labs LEFT JOIN mp USING (code) GROUP BY 1", "labs")
def loinc_map_coverage(spark, d):
    return view(spark, d, "labs").join(_loinc(spark, d), "code", "left").groupBy("code").agg(F.count("*").alias("n"), F.avg(F.when(F.col("loinc").isNotNull(), 1.0).otherwise(0.0)).alias("hit"))


def _loinc(spark, d):
    return view(spark, d, "labs").select("code").distinct().where("code in ('view', 'purchase')").select("code", F.when(F.col("code") == "view", "1-1").otherwise("2-2").alias("loinc"))


@query(", h AS (SELECT patient_id, " + sql.hmac_sql("CAST(patient_id AS VARCHAR)") + " AS h FROM patients) SELECT patient_id, 'P' || " + sql.base32_sql("h", 16) + " AS pseudonym FROM h", "patients")
def pseudonym(spark, d):
    return view(spark, d, "patients").select("patient_id", c.pseudonym(SECRET, F.col("patient_id")).alias("pseudonym"))


@query(", h AS (SELECT patient_id, name, " + sql.hmac_sql("'kvnr:' || name") + " AS h FROM patients) SELECT patient_id, CASE WHEN name <> '' THEN 'KVN' || " + sql.base32_sql("h", 14) + " END AS hash FROM h", "patients")
def hash_id(spark, d):
    return view(spark, d, "patients").select("patient_id", c.hash_id(SECRET, F.col("name"), "kvnr").alias("hash"))


@query(_SHIFT, "cases")
def date_shift(spark, d):
    return view(spark, d, "cases").select("case_id", "patient_id", c.date_shift(SECRET, F.col("patient_id"), F.col("begin_date").cast("string")).alias("begin"), c.date_shift(SECRET, F.col("patient_id"), F.col("end_date").cast("string")).alias("end"))


@query(sql.persons("patients") + " SELECT pseudo AS patient_id, substr(birth, 1, 4) AS birth, sex, marital, dead, CAST(CAST(substr(dead_on, 1, 10) AS DATE) + days AS VARCHAR) || substr(dead_on, 11) AS dead_on FROM patients JOIN pt ON pid = patient_id", "patients")
def redact_patient(spark, d):
    return r.redacted(view(spark, d, "patients").select("patient_id", "name", "street", "city", "postcode", "country", "birth", "sex", "marital", "dead", "dead_on"), PRIV)


@query("SELECT doc_id, " + sql.DEID.format("text") + " AS text FROM documents")
def deid_text(spark, d):
    return table(spark, d, "documents").select("doc_id", c.deid_text(F.col("text")).alias("text"))


@query("SELECT trim(regexp_replace(turn_text, '[\\x00-\\x20\\x7f]+', ' ', 'g')) AS text, conv_id, turn FROM (SELECT conv_id, turn, text AS turn_text FROM conversations)")
def clean_text(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", c.clean_text(F.col("text")).alias("text"))


# resources ---------------------------------------------------------------------------------------------


def _owner(spark, d):
    return view(spark, d, "cases").select("case_id", "patient_id")


def _staff(spark, d):
    return view(spark, d, "procedures").select("case_id", F.col("unit").alias("person"), F.lit("1").alias("role"), "cancelled")


@query(sql.persons("patients") + sql.patient(), "patients")
def res_patient(spark, d):
    return r.patients(view(spark, d, "patients"), PRIV)


@query(sql.case(_MEMBERS), "cases", "movements", "procedures")
def res_case(spark, d):
    m = members(spark, d)
    links = m.where("lead = 'X'").select("case_id", (F.col("case_id") + 1).alias("partner"), F.lit("M").alias("role"), "cancelled")
    return r.cases(view(spark, d, "cases"), view(spark, d, "movements"), _staff(spark, d), links, m.select("case_id", "grp"), PRIV)


@query(sql.movement(), "cases", "movements")
def res_movement(spark, d):
    return r.movements(view(spark, d, "movements"), _owner(spark, d), PRIV)


@query(sql.condition(_TEXTS), "cases", "diagnoses", "codes")
def res_condition(spark, d):
    return r.conditions(view(spark, d, "diagnoses"), _owner(spark, d), _texts(spark, d), PRIV)


@query(sql.procedure(), "cases", "procedures")
def res_procedure(spark, d):
    p = view(spark, d, "procedures")
    return r.procedures(p, _owner(spark, d), p.select("procedure_id", F.col("unit").alias("person"), F.lit("OPT1").alias("task")), PRIV)


def _labs(spark, d):
    """Values by document (kind by code, patient and day); some bear no time or name of their own."""
    part = {"doc_kind": F.when(F.col("code") == "view", "MIK").otherwise("LAB"), "doc_number": F.col("patient_id"), "doc_version": F.date_format("ts", "yyMM"), "doc_part": F.date_format("ts", "dd"), "name": F.when(F.col("unit") == "foo", " ").otherwise(F.concat("code", F.lit(" in "), "unit"))}
    return view(spark, d, "labs").withColumns(part)


def _heads(spark, d):
    """Headers of documents that have a value without the flag ``krass``, with the patient's last case."""
    heads = _labs(spark, d).where("flag <> 'krass'").groupBy(*r.DOC).agg(F.min("patient_id").alias("patient_id"), F.min("ts").alias("ts"), F.min("status").alias("status"))
    return heads.join(_owner(spark, d).groupBy("patient_id").agg(F.max("case_id").alias("case_id")), "patient_id", "left")


@query(sql.lab_report(), "labs", "cases")
def res_lab_report(spark, d):
    return r.lab_reports(_heads(spark, d), _labs(spark, d), PRIV)


@query(sql.lab_value(_LAB), "labs", "cases")
def res_lab_value(spark, d):
    values = _labs(spark, d).withColumn("ts", F.when(F.col("status") != "Q", F.col("ts")))
    return r.lab_values(values, _heads(spark, d), _loinc(spark, d), PRIV)


@query(sql.document())
def res_document(spark, d):
    x = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 1000 + 1).alias("patient_id"), F.col("lang").alias("doc_type"), F.lit("2024-03-05").alias("day"), F.lit("08:15:00").alias("time"), (F.col("doc_id") % 50).alias("author"), (F.col("doc_id") % 10).alias("unit"), F.when(F.col("source") == "src1", "X").otherwise("").alias("cancelled"))
    return r.documents(x, PRIV)


@query(sql.coverage(), "cases", "patients")
def res_coverage(spark, d):
    x = view(spark, d, "cases").select(F.col("case_id").alias("coverage_id"), "case_id", "patient_id", (F.col("case_id") % 25).cast("int").alias("payer"), "begin_date", "end_date", F.col("specialty").alias("kind"), "cancelled")
    ins = view(spark, d, "patients").select("patient_id", F.col("region").alias("payer"), F.col("name").alias("member"))
    return r.coverages(x, ins, PRIV)


@query(sql.birth(), "cases")
def res_birth(spark, d):
    x = view(spark, d, "cases").select("case_id", "patient_id", F.col("begin_date").alias("day"), (F.col("case_id") % 3000 + 1500).alias("weight"), (F.col("case_id") % 20 + 40).alias("length"), F.when(F.col("case_id") % 3 == 0, 34).alias("head"))
    return r.births(x, PRIV)


@query(sql.location(), "units")
def res_location(spark, d):
    return r.locations(view(spark, d, "units").select(F.col("unit_id").alias("location_id"), F.col("unit_name").alias("name"), F.lit("ZI").alias("kind"), F.when(F.col("unit_id") > 10, F.col("unit_id") % 10).alias("parent"), F.col("unit_id").alias("unit")), PRIV)


@query(sql.medication(), "cases", "charges", "codes")
def res_medication(spark, d):
    x = view(spark, d, "charges").join(_owner(spark, d), "case_id").join(view(spark, d, "codes").select("code_id", "text", "brand"), "code_id")
    return r.medications(x.select(F.col("charge_id").alias("order_id"), "case_id", "patient_id", F.when(F.col("code_id") % 2 == 0, F.col("code_id").cast("string")).otherwise(F.col("brand")).alias("drug"), "text", "day", F.concat(F.col("quantity").cast("int").cast("string"), F.lit("-0-0")).alias("dose"), "quantity", F.when(F.col("flag") == "A", "X").otherwise("").alias("aut_idem"), F.when(F.col("flag") == "R", "X").otherwise("").alias("cancelled")), PRIV)


@query(sql.risk(), "labs")
def res_risk(spark, d):
    x = view(spark, d, "labs").select(F.col("lab_id").alias("risk_id"), "patient_id", F.lpad((F.col("lab_id") % 60).cast("string"), 6, "0").alias("code"), F.col("raw").alias("text"), F.to_date("ts").alias("day"), F.when(F.col("lab_id") % 11 == 0, "X").otherwise("").alias("deleted"))
    return r.risks(x, PRIV)


def _org(df, key, name):
    return df.select(F.col(key).alias("org_id"), F.col(name).alias("name"), (F.lit(260000000) + F.col(key)).cast("string").alias("ik"), F.lit("").alias("deleted"))


@query(sql.organization("nation", "n_nationkey", "n_name", "OrgPayer", "pay", r.ISH + "kostr"))
def res_payer(spark, d):
    return r.organizations(_org(table(spark, d, "nation"), "n_nationkey", "n_name"), "OrgPayer", "pay", r.ISH + "kostr", PRIV)


@query(sql.organization("supplier", "s_suppkey", "s_name", "OrgUnit", "dept", r.ISH + "orgid", ik=False, parent=sql.ref("Organization", "OrgFacility", "s_suppkey % 5")))
def res_unit(spark, d):
    u = _org(table(spark, d, "supplier"), "s_suppkey", "s_name").withColumn("ik", F.lit(None).cast("string"))
    return r.organizations(u, "OrgUnit", "dept", r.ISH + "orgid", PRIV, parent=PRIV.ref("Organization", "OrgFacility", F.col("org_id") % 5))


@query(sql.organization("region", "r_regionkey", "r_name", "OrgFacility", None, r.ISH + "einri"))
def res_facility(spark, d):
    return r.organizations(_org(table(spark, d, "region"), "r_regionkey", "r_name"), "OrgFacility", None, r.ISH + "einri", PRIV)


@query(sql.organization("nation", "n_nationkey", "n_name", "OrgClearing", None, r.ISH + "das301"))
def res_clearing_house(spark, d):
    return r.organizations(_org(table(spark, d, "nation"), "n_nationkey", "n_name"), "OrgClearing", None, r.ISH + "das301", PRIV)


@query(sql.practitioner())
def res_practitioner(spark, d):
    u = table(spark, d, "supplier")
    names = u.where("s_acctbal >= 0").select(F.col("s_suppkey").alias("person"), F.col("s_name").alias("name"), F.lit("").alias("name_deleted"))
    roles = u.where("s_nationkey <> 3").select(F.col("s_suppkey").alias("person"), F.col("s_suppkey").cast("string").alias("lanr"), F.lit("0100").alias("specialty"), F.when(F.col("s_suppkey") % 10 == 0, "X").otherwise("").alias("role_deleted"))
    return r.practitioners(names, roles, PRIV)


@query(sql.account(_MEMBERS), "cases")
def res_account(spark, d):
    m = members(spark, d)
    groups = m.join(_owner(spark, d), "case_id").where("lead = 'X'").select("grp", "patient_id", F.col("cancelled").alias("group_cancelled"))
    return r.accounts(groups, m, PRIV)


@query(sql.order())
def res_order(spark, d):
    x = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("order_id"), (F.col("conv_id") % 100 + 1).alias("patient_id"), F.substring("text", 1, 30).alias("title"), F.col("text").alias("note"), F.when(F.col("conv_id") % 2 == 0, F.col("conv_id") % 20).alias("person"), (F.col("conv_id") % 10).alias("unit"), F.lit("2024-05-01").alias("day"), F.lit("").alias("cancelled"))
    return r.orders(x, PRIV)


_EVERY = f"{_MEMBERS}, ev AS (SELECT * FROM ({duck(sql.persons('patients') + sql.patient(), 'patients')}) UNION ALL SELECT * FROM ({duck(sql.account(_MEMBERS), 'cases')}) UNION ALL SELECT * FROM ({duck(sql.location(), 'units')}))"


def _every(spark, d):
    return res_patient(spark, d).unionByName(res_account(spark, d)).unionByName(res_location(spark, d)).withColumn("run_id", F.lit("run-1"))


@query(_EVERY + " SELECT resource_type, id, patient, 'run-1' AS run_id FROM ev", "cases")
def resource_index(spark, d):
    return index(_every(spark, d))


_DECADE, _BUILDING = "substr(birth, 1, 3) || '0s'", "(SELECT * FROM patients WHERE segment = 'BUILDING') q"
_AGAIN = f"{_EVERY}, ag AS (SELECT * FROM ({duck(sql.persons('patients') + sql.patient(_DECADE, _BUILDING), 'patients')})), nw AS (SELECT *, 'run-2' AS run_id FROM ag UNION ALL SELECT *, 'run-1' FROM ev WHERE id NOT IN (SELECT id FROM ag))"


def _runs(spark, d):
    """A first run of patients, accounts and locations, and a second one of some patients, with births as decades."""
    again = r.patients(view(spark, d, "patients").where("segment = 'BUILDING'"), r.Privacy("anonymize", SECRET))
    return _every(spark, d).unionByName(again.withColumn("run_id", F.lit("run-2")))


def _laid_out(spark, d):
    path = new_path(spark, "resources")
    write_resources(_runs(spark, d), path)
    return path


@query(_AGAIN + f" SELECT * FROM nw WHERE resource_type = 'Patient' AND id = {sql.uid('Patient', '3')}", "cases")
def resource_get(spark, d):
    one = spark.range(1).select(PRIV.rid("Patient", F.lit(3))).first()[0]
    return read_resources(spark, _laid_out(spark, d), resource_type="Patient", id=one)


@query(_AGAIN + " SELECT * FROM nw WHERE resource_type = 'Patient' ORDER BY id LIMIT 50", "cases")
def resource_search(spark, d):
    return read_resources(spark, _laid_out(spark, d), resource_type="Patient", most=50)


@query(_EVERY + " SELECT resource_type, 'run-1' AS run_id, body AS value FROM ev", "cases")
def sink_ndjson(spark, d):
    path = new_path(spark, "ndjson")
    write_ndjson(_every(spark, d), path)
    return spark.read.text(path).select("resource_type", "run_id", "value")
