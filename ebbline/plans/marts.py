"""Queries of marts, serving, masking and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookups as lk
from ..operators import marts as m
from .base import duck, table, view

QUERIES, SQL = {}, {}
LIVE = "coalesce(trim({}), '') NOT IN ('X', '1')"


def query(sql: str | None = None, *names: str):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = duck(sql.replace("LIVE(", "(coalesce(trim(").replace(")LIVE", "), '') NOT IN ('X', '1'))"), *names)
        return f

    return put


_LOS = ", los AS (SELECT case_id, begin_date AS admitted, end_date AS discharged, CAST(end_date - begin_date AS INTEGER) AS los_days FROM cases WHERE case_type = '1' AND end_date IS NOT NULL AND LIVE(cancelled)LIVE)"


def _los(spark, d):
    return m.length_of_stay(view(spark, d, "cases"), case="case_id", kind="case_type", begin="begin_date", end="end_date")


@query("SELECT strftime(begin_date, '%Y-%m') AS month, case_type, count(*) AS n FROM cases WHERE LIVE(cancelled)LIVE AND locked <> 'X' GROUP BY 1, 2", "cases")
def cases_per_month(spark, d):
    return m.cases_per_month(view(spark, d, "cases"), begin="begin_date", kind="case_type")


@query(_LOS + " SELECT * FROM los", "cases")
def los_simple(spark, d):
    return _los(spark, d)


@query(_LOS + " SELECT avg(los_days) AS mean, median(los_days) AS median, count(*) AS n FROM los", "cases")
def los_stats(spark, d):
    return m.los_stats(_los(spark, d))


@query(_LOS + " SELECT CASE WHEN los_days <= 1 THEN '0-1' WHEN los_days <= 3 THEN '2-3' WHEN los_days <= 6 THEN '4-6' WHEN los_days <= 10 THEN '7-10' WHEN los_days <= 15 THEN '11-15' WHEN los_days <= 21 THEN '16-21' ELSE '>21' END AS bucket, count(*) AS n FROM los WHERE los_days >= 0 GROUP BY 1", "cases")
def los_histogram(spark, d):
    return m.los_histogram(_los(spark, d))


@query(", o AS (SELECT coalesce(ward, dept) AS unit, count(*) AS open_movements FROM movements WHERE end_ts IS NULL AND LIVE(cancelled)LIVE GROUP BY 1) SELECT unit, open_movements, unit_name FROM o LEFT JOIN units ON unit = unit_id", "movements", "units")
def occupancy_by_unit(spark, d):
    return m.occupancy(view(spark, d, "movements"), ward="ward", dept="dept", end="end_ts", units=view(spark, d, "units"))


_TEXTS = ", texts AS (SELECT chr(65 + CAST(code_id % 26 AS INTEGER)) || lpad(CAST(code_id % 100 AS VARCHAR), 2, '0') || '.' || CAST(code_id % 10 AS VARCHAR) AS code, min(text) AS text FROM codes GROUP BY 1)"


def _texts(spark, d):
    c = view(spark, d, "codes")
    code = F.concat(F.char(65 + F.col("code_id") % 26), F.lpad((F.col("code_id") % 100).cast("string"), 2, "0"), F.lit("."), (F.col("code_id") % 10).cast("string"))
    return c.select(code.alias("code"), "text").groupBy("code").agg(F.min("text").alias("text"))


@query(_TEXTS + ", t AS (SELECT code, count(*) AS n FROM diagnoses WHERE principal = 'X' AND LIVE(cancelled)LIVE GROUP BY 1 ORDER BY n DESC, code LIMIT 50) SELECT code, n, text FROM t LEFT JOIN texts USING (code)", "diagnoses", "codes")
def top_diagnoses(spark, d):
    return m.top_codes(view(spark, d, "diagnoses"), "code", where=F.col("principal") == "X", texts=_texts(spark, d))


@query("SELECT strftime(day, '%Y-%m') AS month, CAST(sum(CASE WHEN principal = 'X' THEN 1 ELSE 0 END) AS BIGINT) AS principal, CAST(sum(CASE WHEN admission = 'X' THEN 1 ELSE 0 END) AS BIGINT) AS admission, CAST(sum(CASE WHEN discharge = 'X' THEN 1 ELSE 0 END) AS BIGINT) AS discharge, CAST(sum(CASE WHEN treatment = 'X' THEN 1 ELSE 0 END) AS BIGINT) AS treatment, CAST(sum(CASE WHEN surgery = 'X' THEN 1 ELSE 0 END) AS BIGINT) AS surgery, count(*) AS total FROM diagnoses WHERE LIVE(cancelled)LIVE GROUP BY 1", "diagnoses")
def diagnosis_usage_month(spark, d):
    return m.usage_by_month(view(spark, d, "diagnoses"), day="day", flags={k: k for k in ("principal", "admission", "discharge", "treatment", "surgery")})


@query("SELECT code, count(*) AS n FROM procedures GROUP BY 1 ORDER BY n DESC, code LIMIT 50", "procedures")
def top_procedures(spark, d):
    return m.top_codes(view(spark, d, "procedures"), "code", cancelled=None)


@query(_LOS + " SELECT (SELECT count(*) FROM cases WHERE LIVE(cancelled)LIVE) AS n_cases, (SELECT count(*) FROM cases WHERE LIVE(cancelled)LIVE AND end_date IS NULL) AS n_open, (SELECT count(*) FROM patients) AS n_patients, (SELECT count(*) FROM labs) AS n_labs, (SELECT round(avg(los_days), 6) FROM los) AS los_mean, (SELECT median(los_days) FROM los) AS los_median", "cases", "patients", "labs")
def kpis(spark, d):
    return m.kpis(view(spark, d, "cases"), view(spark, d, "patients"), view(spark, d, "labs"), _los(spark, d), end="end_date")


@query("SELECT CAST(least(floor((2020 - CAST(substr(birth, 1, 4) AS INTEGER)) / 10) * 10, 90) AS INTEGER) AS band, sex, count(*) AS n FROM patients WHERE CAST(substr(birth, 1, 4) AS INTEGER) BETWEEN 1900 AND 2020 GROUP BY 1, 2", "patients")
def age_sex_pyramid(spark, d):
    return m.age_sex(view(spark, d, "patients"), birth="birth", sex="sex", year=2020)


@query("SELECT coalesce(nullif(trim(specialty), ''), 'ohne') AS specialty, count(*) AS n FROM cases WHERE LIVE(cancelled)LIVE GROUP BY 1 ORDER BY n DESC, 1 LIMIT 12", "cases")
def specialties_top(spark, d):
    return m.top_specialties(view(spark, d, "cases"), "specialty")


@query("SELECT patient_id, sex, substr(birth, 1, 4) AS birth, '***' AS name, dead FROM patients", "patients")
def masked_tables(spark, d):
    return m.serving("patients", view(spark, d, "patients"))


@query("SELECT case_id, patient_id, case_type, begin_date, end_date, specialty, status, cancelled FROM cases WHERE coalesce(locked, '') <> 'X'", "cases")
def masked_cases(spark, d):
    return m.serving("cases", view(spark, d, "cases"))


@query("SELECT case_id, number, kind, art, reason, begin_ts, end_ts, dept, ward, cancelled FROM movements", "movements")
def masked_movements(spark, d):
    return m.serving("movements", view(spark, d, "movements"))


@query("SELECT case_id, number, code, code2, certainty, day, principal, department, admission, discharge, treatment, surgery, cancelled FROM diagnoses", "diagnoses")
def masked_diagnoses(spark, d):
    return m.serving("diagnoses", view(spark, d, "diagnoses"))


@query("SELECT case_id, procedure_id, code, day, unit, cancelled FROM procedures", "procedures")
def masked_procedures(spark, d):
    return m.serving("procedures", view(spark, d, "procedures"))


@query("SELECT doc_id, lang AS doc_type, DATE '2024-03-05' AS day FROM documents")
def masked_documents(spark, d):
    return m.serving("documents", table(spark, d, "documents").withColumns({"doc_type": F.col("lang"), "day": F.lit("2024-03-05").cast("date")}))


@query("SELECT case_id, charge_id AS sequence, class AS code, discount AS weight, day AS created FROM charges", "charges")
def masked_drg(spark, d):
    return m.serving("drg", view(spark, d, "charges").select("case_id", F.col("charge_id").alias("sequence"), F.col("class").alias("code"), F.col("discount").alias("weight"), F.col("day").alias("created"), "note"))


@query("SELECT brand AS code, text, size AS weight FROM codes", "codes")
def masked_drg_catalog(spark, d):
    return m.serving("drg_catalog", view(spark, d, "codes").select(F.col("brand").alias("code"), "text", F.col("size").alias("weight"), "price"))


@query(", h AS (SELECT lab_id, patient_id, CAST(ts AS DATE) AS head_day FROM labs WHERE code <> 'click'), v AS (SELECT lab_id, code, raw, unit, CASE WHEN lab_id % 3 = 0 THEN NULL ELSE CAST(ts AS DATE) + 1 END AS value_day FROM labs) SELECT patient_id, code, raw, unit, coalesce(value_day, head_day) AS day FROM v LEFT JOIN h USING (lab_id)", "labs")
def masked_lab(spark, d):
    labs = view(spark, d, "labs")
    heads = labs.where("code <> 'click'").select("lab_id", "patient_id", F.to_date("ts").alias("head_day"))
    values = labs.select("lab_id", "code", "raw", "unit", F.when(F.col("lab_id") % 3 != 0, F.date_add(F.to_date("ts"), 1)).alias("value_day"))
    return m.masked_lab(values, heads, key=["lab_id"], value_day="value_day", head_day="head_day", columns=["patient_id", "code", "raw", "unit"])


@query("SELECT patient_id, sex, birth FROM patients WHERE name ILIKE '%customer#%1%' AND birth LIKE '19%' ORDER BY patient_id LIMIT 20", "patients")
def patient_search(spark, d):
    return m.patient_search(view(spark, d, "patients"), view(spark, d, "cases"), name="customer#%1", birth="19").select("patient_id", "sex", "birth")


_CASEDIAG = "JOIN (SELECT DISTINCT case_id, patient_id FROM cases) USING (case_id)"


@query(f"SELECT patient_id, 'case' AS part, CAST(case_id AS VARCHAR) AS ref, case_type AS detail FROM cases WHERE LIVE(cancelled)LIVE UNION ALL SELECT patient_id, 'diagnosis', CAST(case_id AS VARCHAR), code || CASE WHEN principal = 'X' THEN ' HD' ELSE ' ND' END FROM diagnoses {_CASEDIAG} WHERE LIVE(diagnoses.cancelled)LIVE UNION ALL SELECT patient_id, 'procedure', CAST(case_id AS VARCHAR), code FROM procedures {_CASEDIAG} WHERE LIVE(procedures.cancelled)LIVE UNION ALL SELECT patient_id, 'lab', CAST(lab_id AS VARCHAR), code FROM labs", "cases", "diagnoses", "procedures", "labs")
def patient_360(spark, d):
    """The four lists of every patient, as one table."""
    cases = view(spark, d, "cases")
    owner = cases.select("case_id", "patient_id")
    diag = lk.case_to_patient(m.live(view(spark, d, "diagnoses")), owner).where("patient_id is not null")
    proc = lk.case_to_patient(m.live(view(spark, d, "procedures")), owner).where("patient_id is not null")

    def part(df, name, ref, detail):
        return df.select("patient_id", F.lit(name).alias("part"), F.col(ref).cast("string").alias("ref"), detail.alias("detail"))

    return (
        part(m.live(cases), "case", "case_id", F.col("case_type"))
        .unionByName(part(diag, "diagnosis", "case_id", F.concat("code", F.when(F.col("principal") == "X", " HD").otherwise(" ND"))))
        .unionByName(part(proc, "procedure", "case_id", F.col("code")))
        .unionByName(part(view(spark, d, "labs"), "lab", "lab_id", F.col("code")))
    )


@query(f"""SELECT patient_id, begin_date AS day, 'case' AS kind, CAST(case_id AS VARCHAR) AS ref, case_type AS detail FROM cases WHERE begin_date BETWEEN DATE '1995-01-01' AND DATE '1997-12-31'
UNION ALL SELECT patient_id, CAST(begin_ts AS DATE), 'movement', CAST(case_id AS VARCHAR), kind FROM movements {_CASEDIAG} WHERE CAST(begin_ts AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1997-12-31'
UNION ALL SELECT patient_id, day, 'diagnosis', CAST(case_id AS VARCHAR), code FROM diagnoses {_CASEDIAG} WHERE day BETWEEN DATE '1995-01-01' AND DATE '1997-12-31' UNION ALL SELECT patient_id, day, 'procedure', CAST(case_id AS VARCHAR), code FROM procedures {_CASEDIAG} WHERE day BETWEEN DATE '1995-01-01' AND DATE '1997-12-31'""", "cases", "movements", "diagnoses", "procedures")
def patient_timeline(spark, d):
    cases = view(spark, d, "cases")
    own = lambda name: lk.case_to_patient(view(spark, d, name), cases).where("patient_id is not null")
    ref = F.col("case_id")
    return m.timeline({"case": (cases, F.col("begin_date"), ref, F.col("case_type")), "movement": (own("movements"), F.col("begin_ts"), ref, F.col("kind")), "diagnosis": (own("diagnoses"), F.col("day"), ref, F.col("code")), "procedure": (own("procedures"), F.col("day"), ref, F.col("code")), "document": (None, ref, ref, ref)}, since="1995-01-01", until="1997-12-31")


@query(", c AS (SELECT patient_id, count(*) AS n, count(*) FILTER (WHERE end_date IS NULL) AS o, max(begin_date) AS last_admission FROM cases WHERE LIVE(cancelled)LIVE GROUP BY 1) SELECT p.patient_id, sex, coalesce(n, 0) AS n_cases, coalesce(o, 0) AS n_open, last_admission FROM patients p LEFT JOIN c USING (patient_id) ORDER BY last_admission DESC NULLS LAST, p.patient_id LIMIT 50 OFFSET 50", "cases", "patients")
def patient_list_page(spark, d):
    return m.patient_list(view(spark, d, "patients"), view(spark, d, "cases"), offset=50, most=50)


@query("SELECT c.case_id, c.patient_id, c.case_type, m.number, m.kind, u.unit_name FROM cases c JOIN movements m USING (case_id) LEFT JOIN units u ON m.ward = u.unit_id WHERE LIVE(c.cancelled)LIVE AND LIVE(m.cancelled)LIVE", "cases", "movements", "units")
def case_detail(spark, d):
    heads = m.live(view(spark, d, "cases")).select("case_id", "patient_id", "case_type")
    chain = m.live(view(spark, d, "movements")).select("case_id", "number", "kind", F.col("ward").alias("unit_id"))
    return heads.join(chain, "case_id").join(view(spark, d, "units").select("unit_id", "unit_name"), "unit_id", "left").drop("unit_id")


_HD = ", hd AS (SELECT case_id, code AS hd_code, principal = 'X' AS is_principal FROM diagnoses WHERE LIVE(cancelled)LIVE QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY principal = 'X' DESC, day DESC, code, number) = 1)"
_UNIT = ", lu AS (SELECT case_id, max_by(CAST(dept AS VARCHAR), (begin_ts, number, CAST(dept AS VARCHAR))) AS dept, max_by(CAST(ward AS VARCHAR), (begin_ts, number, CAST(ward AS VARCHAR))) AS ward FROM movements WHERE LIVE(cancelled)LIVE GROUP BY 1)"
_DRG = ", dl AS (SELECT case_id, max_by(class, (charge_id, code_id, price)) AS class, max_by(price, (charge_id, code_id, price)) AS price FROM charges WHERE LIVE(CASE WHEN flag = 'R' THEN 'X' END)LIVE GROUP BY 1)"


@query(_HD + " SELECT * FROM hd", "diagnoses")
def principal_diagnosis(spark, d):
    return m.principal_diagnosis(view(spark, d, "diagnoses"))


@query(_UNIT + " SELECT * FROM lu", "movements")
def last_unit_per_case(spark, d):
    return m.last_unit(view(spark, d, "movements"))


def _drg(spark, d):
    return m.latest_by(view(spark, d, "charges").where("flag <> 'R'"), ["case_id"], ["class", "price"], ["charge_id", "code_id", "price"])


@query(_DRG + " SELECT * FROM dl", "charges")
def drg_latest(spark, d):
    return _drg(spark, d)


@query("SELECT substr(brand, 7) AS code, max_by(text, (kind, code_id)) AS text FROM codes WHERE brand LIKE 'Brand%' GROUP BY 1", "codes")
def drg_catalog_latest(spark, d):
    c = view(spark, d, "codes").where(F.col("brand").startswith("Brand")).withColumn("code", F.substring("brand", 7, 100))
    return m.latest_by(c, ["code"], ["text"], ["kind", "code_id"])


@query(_HD + _UNIT + _DRG + " SELECT c.case_id, c.patient_id, hd_code, is_principal, dept, ward, class, price FROM cases c LEFT JOIN hd USING (case_id) LEFT JOIN lu USING (case_id) LEFT JOIN dl USING (case_id)", "cases", "diagnoses", "movements", "charges")
def case_enriched(spark, d):
    cases = view(spark, d, "cases").select("case_id", "patient_id")
    return cases.join(m.principal_diagnosis(view(spark, d, "diagnoses")), "case_id", "left").join(m.last_unit(view(spark, d, "movements")), "case_id", "left").join(_drg(spark, d), "case_id", "left")


@query(_TEXTS + " SELECT patient_id, code, max(text) AS text, count(*) AS n, min(day) AS first_day, max(day) AS last_day, max(CASE WHEN principal = 'X' THEN 1 ELSE 0 END) AS ever_principal FROM diagnoses JOIN (SELECT case_id, patient_id FROM cases) USING (case_id) LEFT JOIN texts USING (code) WHERE LIVE(cancelled)LIVE GROUP BY 1, 2", "diagnoses", "cases", "codes")
def problem_list(spark, d):
    return m.problem_list(view(spark, d, "diagnoses"), view(spark, d, "cases"), texts=_texts(spark, d))


@query("SELECT patient_id, code, ts, raw, unit FROM labs WHERE patient_id = 7 ORDER BY code, ts, lab_id LIMIT 500", "labs")
def lab_series(spark, d):
    return view(spark, d, "labs").where("patient_id = 7").orderBy("code", "ts", "lab_id").limit(500).select("patient_id", "code", "ts", "raw", "unit")


@query("SELECT case_type, count(*) AS n, count(DISTINCT patient_id) AS patients FROM cases WHERE locked <> 'X' GROUP BY 1 ORDER BY 1 LIMIT 100", "cases")
def cohort_sql(spark, d):
    m.masked(view(spark, d, "cases"), ["case_id", "patient_id", "case_type"], locked="locked").createOrReplaceTempView("masked_case")
    return spark.sql("SELECT case_type, count(*) AS n, count(DISTINCT patient_id) AS patients FROM masked_case GROUP BY 1 ORDER BY 1").limit(100)


@query("SELECT state AS table_name, max_by(value, _seq) AS value, max(_seq) AS _seq FROM changes GROUP BY 1", "changes")
def latest_per_table(spark, d):
    return m.latest_by(view(spark, d, "changes").withColumnRenamed("state", "table_name"), ["table_name"], ["value", "_seq"], ["_seq"])


# lookups ---------------------------------------------------------------------------------------------


@query("SELECT 'part' AS catalog, trim(CAST(p_partkey AS VARCHAR)) AS code, trim(p_name) AS text FROM part UNION ALL SELECT 'unit', trim(CAST(s_suppkey AS VARCHAR)), trim(s_name) FROM supplier UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), trim(n_name) FROM nation")
def ref_catalogs(spark, d):
    def one(name, key, texts, label):
        c = lk.catalog(table(spark, d, name), [key], texts)
        return c.select(F.lit(label).alias("catalog"), F.col(key).alias("code"), "text")

    return one("part", "p_partkey", ["p_longname", "p_name"], "part").unionByName(one("supplier", "s_suppkey", ["s_name"], "unit")).unionByName(one("nation", "n_nationkey", ["n_text", "n_name"], "nation"))


@query("SELECT 'icd' AS catalog, '56' AS version, code, text FROM (SELECT brand AS code, min(text) AS text FROM codes GROUP BY 1) WHERE code = 'Brand#12'", "codes")
def resolve_code(spark, d):
    c = view(spark, d, "codes").groupBy(F.col("brand").alias("code")).agg(F.min("text").alias("text")).select(F.lit("icd").alias("catalog"), F.lit("56").alias("version"), "code", "text")
    return lk.resolve_code(c, "icd", "Brand#12")


@query(_TEXTS + " SELECT case_id, number, d.code, text FROM diagnoses d LEFT JOIN texts t ON d.code = t.code", "diagnoses", "codes")
def lookup_code_text(spark, d):
    """German texts of a catalog that has English ones too."""
    t = _texts(spark, d).select("code", "text")
    both = t.withColumn("language", F.lit("D ")).unionByName(t.select("code", F.upper("text").alias("text"), F.lit("E").alias("language")))
    return lk.code_text(view(spark, d, "diagnoses").select("case_id", "number", "code"), both, ["code"])


@query(", g AS (SELECT case_id, max(ward) AS ward FROM movements WHERE LIVE(cancelled)LIVE GROUP BY 1) SELECT case_id, patient_id, ward FROM cases LEFT JOIN g USING (case_id)", "cases", "movements")
def lookup_billing_group(spark, d):
    return lk.billing_group(view(spark, d, "cases").select("case_id", "patient_id"), m.live(view(spark, d, "movements")), case="case_id", group="ward")


@query("SELECT case_id, number, patient_id FROM movements LEFT JOIN (SELECT DISTINCT case_id, patient_id FROM cases WHERE status <> 'P') USING (case_id)", "movements", "cases")
def case_to_patient(spark, d):
    return lk.case_to_patient(view(spark, d, "movements").select("case_id", "number"), view(spark, d, "cases").where("status <> 'P'"))


@query(", k AS (SELECT case_id, string_agg(number || ':' || kind, ',' ORDER BY number) AS chain, count(*) AS n FROM movements WHERE LIVE(cancelled)LIVE GROUP BY 1) SELECT case_id, n, chain FROM cases LEFT JOIN k USING (case_id)", "cases", "movements")
def children_list(spark, d):
    out = lk.children_list(view(spark, d, "cases").select("case_id"), m.live(view(spark, d, "movements")), key="case_id", fields=["number", "kind"])
    text = F.array_join(F.transform("children", lambda x: F.concat(x["number"].cast("string"), F.lit(":"), x["kind"])), ",")
    return out.select("case_id", F.when(F.col("children").isNotNull(), F.size("children").cast("long")).alias("n"), text.alias("chain"))


@query(", v AS (SELECT c_custkey AS patient_id, c_nationkey AS payer, c_name AS member, row_number() OVER (PARTITION BY c_custkey, c_nationkey ORDER BY c_name) AS r FROM customer) SELECT o_orderkey AS case_id, o_custkey AS patient_id, o_orderkey % 25 AS payer, member FROM orders LEFT JOIN (SELECT * FROM v WHERE r = 1) v ON o_custkey = v.patient_id AND o_orderkey % 25 = v.payer".replace(", v AS", "WITH v AS", 1))
def best_insurance_match(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("case_id"), F.col("o_custkey").alias("patient_id"), (F.col("o_orderkey") % 25).cast("int").alias("payer"))
    own = table(spark, d, "customer").select(F.col("c_custkey").alias("patient_id"), F.col("c_nationkey").alias("payer"), F.col("c_name").alias("member"))
    return lk.best_match(rows, own, ["patient_id", "payer"], ["member"], ["member"]).withColumn("payer", F.col("payer").cast("long"))


@query(", k AS (SELECT DISTINCT case_id FROM cases WHERE trim(specialty) <> '') SELECT 'movements' AS table_name, count(*) AS n_orphans FROM movements WHERE case_id NOT IN (SELECT case_id FROM k) UNION ALL SELECT 'procedures', count(*) FROM procedures WHERE case_id NOT IN (SELECT case_id FROM k)", "cases", "movements", "procedures")
def orphan_rows(spark, d):
    return lk.orphans({n: view(spark, d, n) for n in ("movements", "procedures")}, view(spark, d, "cases").where("trim(specialty) <> ''"))


@query("SELECT coalesce(a.s_nationkey, b.n_nationkey) AS nationkey, s_name, n_name FROM (SELECT * FROM supplier WHERE s_acctbal >= 0) a FULL JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) b ON s_nationkey = n_nationkey")
def full_outer_merge(spark, d):
    a = table(spark, d, "supplier").where("s_acctbal >= 0").select(F.col("s_nationkey").alias("nationkey"), "s_name")
    b = table(spark, d, "nation").where("n_regionkey <> 1").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return lk.full_outer(a, b, "nationkey")
