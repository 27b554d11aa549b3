"""Queries of graph, text search, hierarchies and visibility."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as g
from ..operators import hierarchy as h
from ..operators import search as s
from ..sources.shared import new_path
from .base import duck, table, view

QUERIES, SQL = {}, {}


def query(sql: str | None = None, *names: str):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = duck(sql, *names)
        return f

    return put


def _v(spark, d, *names):
    return [view(spark, d, n) for n in names]


@query("""SELECT DISTINCT 'patient' AS kind, CAST(patient_id AS VARCHAR) AS id FROM patients UNION ALL SELECT DISTINCT 'case', CAST(case_id AS VARCHAR) FROM cases UNION ALL SELECT DISTINCT 'movement', case_id || '-' || number FROM movements WHERE case_id IN (SELECT case_id FROM cases)
UNION ALL SELECT DISTINCT 'unit', CAST(coalesce(ward, dept) AS VARCHAR) FROM movements UNION ALL SELECT DISTINCT 'diagnosis', code FROM diagnoses UNION ALL SELECT DISTINCT 'procedure', code FROM procedures""", "patients", "cases", "movements", "diagnoses", "procedures")
def graph_nodes(spark, d):
    return g.nodes(*_v(spark, d, "patients", "cases", "movements", "diagnoses", "procedures"))


_EDGES = """, e AS (SELECT DISTINCT 'has_case' AS kind, CAST(patient_id AS VARCHAR) AS src, CAST(case_id AS VARCHAR) AS dst FROM cases UNION ALL SELECT DISTINCT 'has_movement', CAST(case_id AS VARCHAR), case_id || '-' || number FROM movements WHERE case_id IN (SELECT case_id FROM cases)
UNION ALL SELECT DISTINCT 'in_unit', case_id || '-' || number, CAST(coalesce(ward, dept) AS VARCHAR) FROM movements WHERE case_id IN (SELECT case_id FROM cases) UNION ALL SELECT DISTINCT 'has_diagnosis', CAST(case_id AS VARCHAR), code FROM diagnoses WHERE case_id IN (SELECT case_id FROM cases)
UNION ALL SELECT DISTINCT 'has_procedure', CAST(case_id AS VARCHAR), code FROM procedures WHERE case_id IN (SELECT case_id FROM cases))"""


@query(_EDGES + " SELECT * FROM e", "cases", "movements", "diagnoses", "procedures")
def graph_edges(spark, d):
    return g.edges(*_v(spark, d, "cases", "movements", "diagnoses", "procedures"))


@query(", m AS (SELECT DISTINCT case_id, number FROM movements WHERE case_id IN (SELECT case_id FROM cases)), x AS (SELECT case_id, number, lead(number) OVER (PARTITION BY case_id ORDER BY number) AS n FROM m) SELECT case_id || '-' || number AS src, case_id || '-' || n AS dst FROM x WHERE n IS NOT NULL", "movements", "cases")
def edge_follows(spark, d):
    return g.follows(*_v(spark, d, "movements", "cases"))


_MEMBERS = ", mem AS (SELECT case_id // 5 AS grp, case_id, CASE WHEN case_id % 5 = 0 THEN 'X' ELSE '' END AS lead, CASE case_id % 4 WHEN 1 THEN 'RV' WHEN 2 THEN 'WA' WHEN 3 THEN 'KO' ELSE 'ZZ' END AS reason, cancelled FROM cases)"


def members(spark, d):
    """Billing groups of five case numbers, led by the first."""
    k = F.col("case_id")
    reason = F.when(k % 4 == 1, "RV").when(k % 4 == 2, "WA").when(k % 4 == 3, "KO").otherwise("ZZ")
    return view(spark, d, "cases").select(F.expr("case_id div 5").alias("grp"), "case_id", F.when(k % 5 == 0, "X").otherwise("").alias("lead"), reason.alias("reason"), "cancelled")


@query(_MEMBERS + ", l AS (SELECT grp, case_id FROM mem WHERE lead = 'X' AND trim(cancelled) NOT IN ('X', '1')), s AS (SELECT * FROM mem WHERE lead <> 'X' AND trim(cancelled) NOT IN ('X', '1')) SELECT l.case_id AS src, s.case_id AS dst, s.reason, CASE s.reason WHEN 'RV' THEN 'Rueckverlegung' WHEN 'WA' THEN 'Wiederaufnahme' WHEN 'KO' THEN 'Komplikation' ELSE 'Sonstiges' END AS reason_text FROM l JOIN s USING (grp)", "cases")
def edge_merged(spark, d):
    return g.merged(members(spark, d), view(spark, d, "cases"), group="grp", case="case_id", lead="lead", reason="reason", cancelled="cancelled")


@query(""", hd AS (SELECT case_id, min(code) AS code FROM diagnoses WHERE principal = 'X' AND trim(cancelled) NOT IN ('X', '1') GROUP BY 1), f AS (SELECT patient_id, case_id, begin_date, end_date, regexp_extract(upper(code), '^([A-Z][0-9]{2})', 1) AS icd3 FROM cases JOIN hd USING (case_id) WHERE trim(cancelled) NOT IN ('X', '1'))
SELECT a.case_id AS src, b.case_id AS dst, CAST(b.begin_date - a.end_date AS INTEGER) AS days FROM f a JOIN f b ON a.patient_id = b.patient_id AND a.icd3 = b.icd3 AND a.case_id <> b.case_id WHERE a.end_date IS NOT NULL AND b.begin_date > a.end_date AND b.begin_date - a.end_date <= 400""", "cases", "diagnoses")
def edge_readmission(spark, d):
    return g.readmissions(*_v(spark, d, "cases", "diagnoses"), days=400)


@query(", a AS (SELECT DISTINCT patient_id, case_id FROM cases), b AS (SELECT DISTINCT case_id, number, coalesce(ward, dept) AS unit FROM movements) SELECT CAST(patient_id AS VARCHAR) AS n0, CAST(case_id AS VARCHAR) AS n1, case_id || '-' || number AS n2, CAST(unit AS VARCHAR) AS n3 FROM a JOIN b USING (case_id)", "cases", "movements")
def graph_pattern_query(spark, d):
    return g.paths(g.edges(*_v(spark, d, "cases", "movements", "diagnoses", "procedures")), "has_case", "has_movement", "in_unit")


@query(", m AS (SELECT DISTINCT case_id, number FROM movements WHERE case_id IN (SELECT case_id FROM cases)), r AS (SELECT case_id, number, row_number() OVER (PARTITION BY case_id ORDER BY number) - 1 AS steps FROM m) SELECT case_id || '-' || number AS node, CAST(steps AS INTEGER) AS steps FROM r", "movements", "cases")
def graph_follow_chain(spark, d):
    f = g.follows(*_v(spark, d, "movements", "cases"))
    mv = view(spark, d, "movements").join(view(spark, d, "cases").select("case_id"), "case_id", "left_semi")
    first = mv.groupBy("case_id").agg(F.min("number").alias("number")).select(F.concat_ws("-", F.col("case_id").cast("string"), F.col("number").cast("string")))
    return g.shortest_chain(f, first)


# search ----------------------------------------------------------------------------------------------

_TERMS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"


@query("SELECT d.doc_id || '-' || d.lang AS doc_key, d.text, l.quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL")
def doc_text_table(spark, d):
    docs = table(spark, d, "documents")
    links = docs.select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id").select("doc_id", "lang", "quality")
    return s.doc_texts(docs, links, key=["doc_id", "lang"], text="text", columns=["quality"])


@query(f"WITH t AS (SELECT conv_id * 1000 + turn AS id, {_TERMS} AS w FROM conversations), x AS (SELECT id, CAST(len(w) AS BIGINT) AS length, unnest(w) AS term FROM t) SELECT term, id, length, count(*) AS tf FROM x GROUP BY 1, 2, 3")
def doc_term_index(spark, d):
    c = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    return s.index(c, id="id", text="text")


_BM25 = f"""WITH t AS (SELECT doc_id, text, {_TERMS} AS w FROM documents), c AS (SELECT doc_id, text, len(w) AS n, len(list_filter(w, lambda x: x = 'the')) AS a, len(list_filter(w, lambda x: x = 'der')) AS b, len(list_filter(w, lambda x: x = 'idiot')) AS e FROM t),
g AS (SELECT count(*) AS big, avg(n) AS av, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db, count(*) FILTER (WHERE e > 0) AS de FROM c),
r AS (SELECT doc_id, text, ln((big - da + 0.5) / (da + 0.5) + 1) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * n / av)) + ln((big - db + 0.5) / (db + 0.5) + 1) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * n / av)) + ln((big - de + 0.5) / (de + 0.5) + 1) * e * 2.2 / (e + 1.2 * (0.25 + 0.75 * n / av)) AS score FROM c, g WHERE a > 0 OR b > 0 OR e > 0)
SELECT doc_id, round(score, 6) AS score, substr(text, 1, 500) AS snippet FROM r ORDER BY round(score, 6) DESC, doc_id LIMIT 10"""


@query(_BM25)
def doc_search_bm25(spark, d):
    return s.bm25(table(spark, d, "documents"), "idiot der the", id="doc_id", text="text")


@query(_BM25)
def doc_search_index(spark, d):
    """The same search over an index on disk, written first."""
    path, docs = new_path(spark, "index"), table(spark, d, "documents")
    s.write_index(docs, path, id="doc_id", text="text", block_docs=256)
    best = s.search_index(spark, path, "idiot der the")
    return docs.join(F.broadcast(best), F.col("doc_id") == F.col("id")).select("doc_id", "score", F.substring("text", 1, 500).alias("snippet"))  # 10 rows


# hierarchies -----------------------------------------------------------------------------------------


def tree(spark, d):
    """Region, nation, customer and supplier as one tree (parent, child, valid_from, valid_to); accounts below zero ended in 2009, nations of region 2 began in 2005."""
    n, c, u = table(spark, d, "nation"), table(spark, d, "customer"), table(spark, d, "supplier")

    def edge(df, a, x, b, y):
        balance = F.col(f"{b.lower()}_acctbal") if b != "N" else F.lit(0.0)
        begin = F.when(F.col("n_regionkey") == 2, "2005-01-01").otherwise("2000-01-01") if b == "N" else F.lit("2000-01-01")
        return df.select(F.concat(F.lit(a), F.col(x)).alias("parent"), F.concat(F.lit(b), F.col(y)).alias("child"), begin.cast("date").alias("valid_from"), F.when(balance < 0, "2004-12-31").otherwise("2099-12-31").cast("date").alias("valid_to"))

    return edge(n, "R", "n_regionkey", "N", "n_nationkey").unionByName(edge(u, "N", "s_nationkey", "S", "s_suppkey")).unionByName(edge(c, "N", "c_nationkey", "C", "c_custkey"))


_TREE = """e AS (SELECT 'R' || n_regionkey AS parent, 'N' || n_nationkey AS child, CASE WHEN n_regionkey = 2 THEN DATE '2005-01-01' ELSE DATE '2000-01-01' END AS lo, DATE '2099-12-31' AS hi FROM nation
UNION ALL SELECT 'N' || s_nationkey, 'S' || s_suppkey, DATE '2000-01-01', CASE WHEN s_acctbal < 0 THEN DATE '2004-12-31' ELSE DATE '2099-12-31' END FROM supplier UNION ALL SELECT 'N' || c_nationkey, 'C' || c_custkey, DATE '2000-01-01', CASE WHEN c_acctbal < 0 THEN DATE '2004-12-31' ELSE DATE '2099-12-31' END FROM customer)"""
_PATHS = f"WITH RECURSIVE {_TREE}, p AS (SELECT DISTINCT parent AS node, 1 AS level, parent AS path, DATE '1900-01-01' AS a, DATE '2099-12-31' AS z FROM e WHERE parent NOT IN (SELECT child FROM e) UNION ALL SELECT child, level + 1, path || '|' || child, greatest(a, lo), least(z, hi) FROM p JOIN e ON node = parent AND lo <= z AND hi >= a)"
VALID = ("valid_from", "valid_to")


@query(_PATHS + " SELECT node, CAST(level AS INTEGER) AS level, path, a AS valid_from, z AS valid_to FROM p")
def org_tree_paths(spark, d):
    return h.tree_paths(tree(spark, d), parent="parent", child="child", valid=VALID)


@query(_PATHS + " SELECT node, CAST(level AS INTEGER) AS level, string_split(path, '|')[1] AS level1, string_split(path, '|')[2] AS level2, string_split(path, '|')[3] AS level3, string_split(path, '|')[4] AS level4, string_split(path, '|')[5] AS level5, string_split(path, '|')[6] AS level6 FROM p")
def org_levels_pivot(spark, d):
    return h.path_levels(h.tree_paths(tree(spark, d), parent="parent", child="child", valid=VALID))


@query(_PATHS + ", k AS (SELECT 'S' || s_suppkey AS node, s_name AS name, CASE WHEN s_acctbal < 0 THEN 'C' ELSE 'D' END AS type FROM supplier) SELECT node, name, type, CASE type WHEN 'C' THEN 'clinic' WHEN 'D' THEN 'department' END AS type_text, path, CASE WHEN name LIKE 'Supplier#00000001%' THEN 'ward' WHEN name LIKE 'Supplier#0000000%' THEN 'head' WHEN name LIKE 'Supplier#%' THEN 'unit' ELSE 'other' END AS class FROM k LEFT JOIN p USING (node)")
def org_cube(spark, d):
    k = table(spark, d, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("node"), F.col("s_name").alias("name"), F.when(F.col("s_acctbal") < 0, "C").otherwise("D").alias("type"))
    p = h.tree_paths(tree(spark, d), parent="parent", child="child", valid=VALID).select("node", "path")
    types = k.select("type").distinct().withColumn("text", F.when(F.col("type") == "C", "clinic").otherwise("department"))
    classes = spark.createDataFrame([("Supplier#", "unit"), ("Supplier#0000000", "head"), ("Supplier#00000001", "ward")], "prefix string, class string")
    return h.unit_cube(k, types, p, classes).select("node", "name", "type", "type_text", "path", "class")


@query(f"WITH RECURSIVE {_TREE}, r AS (SELECT 'R' || r_regionkey AS root FROM region WHERE r_regionkey < 3), t AS (SELECT root, root AS member FROM r UNION SELECT root, child FROM t JOIN e ON member = parent) SELECT root, member FROM t")
def set_closure(spark, d):
    roots = table(spark, d, "region").where("r_regionkey < 3").select(F.concat(F.lit("R"), "r_regionkey"))
    return h.set_closure(tree(spark, d), roots, parent="parent", child="child")


@query("WITH n AS (SELECT n_regionkey AS parent, n_nationkey AS child FROM nation), l AS (SELECT s_nationkey AS set_id, s_suppkey AS low, s_suppkey + s_suppkey % 2 AS high FROM supplier), t AS (SELECT n_nationkey AS set_id, n_name AS text FROM nation) SELECT child, parent, p.text AS parent_text, c.text AS child_text, low, high, CASE WHEN low = high THEN 'value' WHEN low IS NOT NULL THEN 'range' END AS leaf_kind FROM n LEFT JOIN t p ON parent = p.set_id LEFT JOIN t c ON child = c.set_id LEFT JOIN l ON child = l.set_id")
def set_hierarchy_cube(spark, d):
    n = table(spark, d, "nation")
    leaves = table(spark, d, "supplier").select(F.col("s_nationkey").alias("set_id"), F.col("s_suppkey").alias("low"), (F.col("s_suppkey") + F.col("s_suppkey") % 2).alias("high"))
    return h.set_cube(n.select(F.col("n_regionkey").alias("parent"), F.col("n_nationkey").alias("child")), leaves, n.select(F.col("n_nationkey").alias("set_id"), F.col("n_name").alias("text")))


# visibility ------------------------------------------------------------------------------------------


def _auth(spark, d):
    """Logins from customers, cost centres from suppliers, sets from nations and regions."""
    c, u, n = table(spark, d, "customer"), table(spark, d, "supplier"), table(spark, d, "nation")
    k = F.col("c_custkey")
    logins = c.select(F.concat(F.lit("L"), k).alias("login"), k.alias("person"), F.col("c_mktsegment").alias("segment"), F.lit("2020-01-01").cast("date").alias("begin"), F.when(k % 30 == 0, "2021-01-01").otherwise("2099-12-31").cast("date").alias("end"))
    n_units = F.broadcast(u.agg(F.count("*").alias("_units")))  # one row
    assigned = c.crossJoin(n_units).select(k.alias("person"), F.concat(F.lit("K"), (k % F.col("_units")).cast("string")).alias("centre"), F.lit("2020-01-01").cast("date").alias("begin"), F.lit("2099-12-31").cast("date").alias("end"))
    leaves = u.select(F.concat(F.lit("N"), "s_nationkey").alias("set_id"), F.concat(F.lit("K"), "s_suppkey").alias("centre"))
    roots = n.join(u, F.col("n_nationkey") == F.col("s_nationkey")).select(F.concat(F.lit("R"), "n_regionkey").alias("set_id"), F.concat(F.lit("K"), "s_suppkey").alias("centre"))
    edges = n.select(F.concat(F.lit("R"), "n_regionkey").alias("parent"), F.concat(F.lit("N"), "n_nationkey").alias("child"))
    unit_map = u.select((F.col("s_suppkey") % 10).alias("dept"), F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.col("s_suppkey").cast("string")).alias("ward"), F.concat(F.lit("K"), "s_suppkey").alias("centre"))
    return logins, assigned, leaves.unionByName(roots), edges, unit_map


_AUTH = """logins AS (SELECT 'L' || c_custkey AS login, c_custkey AS person, c_mktsegment AS segment, CASE WHEN c_custkey % 30 = 0 THEN DATE '2021-01-01' ELSE DATE '2099-12-31' END AS ende FROM customer),
own AS (SELECT login, 'K' || CAST(person % (SELECT count(*) FROM supplier) AS VARCHAR) AS centre FROM logins WHERE ende >= DATE '2024-06-01'),
leaf AS (SELECT DISTINCT 'N' || s_nationkey AS set_id, 'K' || s_suppkey AS centre FROM supplier UNION SELECT 'R' || n_regionkey, 'K' || s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
sz AS (SELECT set_id, count(*) AS size FROM leaf GROUP BY 1), ed AS (SELECT 'R' || n_regionkey AS parent, 'N' || n_nationkey AS child FROM nation)"""


@query("WITH " + _AUTH + " SELECT 'login' AS kind, count(*) AS n FROM logins UNION ALL SELECT 'leaf', count(*) FROM leaf UNION ALL SELECT 'edge', count(*) FROM ed UNION ALL SELECT 'unit', count(*) FROM supplier")
def auth_tables(spark, d):
    logins, _, leaves, edges, unit_map = _auth(spark, d)
    one = lambda k, df: df.agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n")
    return one("login", logins).unionByName(one("leaf", leaves.distinct())).unionByName(one("edge", edges)).unionByName(one("unit", unit_map))


@query("WITH " + _AUTH + " SELECT DISTINCT login, centre FROM own")
def employee_cost_centres(spark, d):
    logins, assigned, *_ = _auth(spark, d)
    return h.employee_centres(logins, assigned, today="2024-06-01")


# a nation's set is never larger than its region's, so the smallest fitting set decides; with all unions below the limit, the union is that of the chosen sets and those below
_VIS = _AUTH + """, fit AS (SELECT * FROM sz WHERE size <= 60), cand AS (SELECT login, o.centre, f.set_id, rank() OVER (PARTITION BY login, o.centre ORDER BY size) AS r FROM own o JOIN leaf l ON o.centre = l.centre JOIN fit f ON l.set_id = f.set_id),
grp AS (SELECT DISTINCT login, set_id FROM cand WHERE r = 1), ext AS (SELECT login, set_id FROM grp UNION SELECT login, child FROM grp JOIN ed ON set_id = parent WHERE child NOT IN (SELECT set_id FROM sz WHERE size > 60)),
vis AS (SELECT login, centre FROM own UNION SELECT login, centre FROM ext JOIN leaf USING (set_id))"""


@query("WITH " + _VIS + " SELECT login, centre FROM vis")
def dept_visibility(spark, d):
    logins, assigned, leaves, edges, _ = _auth(spark, d)
    return h.dept_visibility(h.employee_centres(logins, assigned, today="2024-06-01"), edges, leaves)


_CENTRES = "cm AS (SELECT DISTINCT l_orderkey AS case_id, 'K' || s_suppkey AS centre FROM lineitem JOIN supplier ON l_suppkey % 10 = s_suppkey % 10 AND (s_suppkey % 3 = 0 OR l_suppkey = s_suppkey))"


@query("WITH " + _CENTRES + " SELECT case_id, centre FROM cm")
def case_cost_centres(spark, d):
    *_, unit_map = _auth(spark, d)
    return h.case_centres(view(spark, d, "movements").select("case_id", "dept", F.col("ward").cast("string").alias("ward")), unit_map)


@query("WITH " + _VIS + ", " + _CENTRES + ", roles AS (SELECT login, CASE segment WHEN 'MACHINERY' THEN 'pflege' WHEN 'BUILDING' THEN 'Admin ' END AS role FROM logins), pc AS (SELECT DISTINCT o_custkey AS patient_id, centre FROM cm JOIN orders ON o_orderkey = case_id) SELECT DISTINCT login, CASE WHEN role = 'Admin ' THEN 'ALL' ELSE 'NONE' END AS scope, CAST(NULL AS BIGINT) AS patient_id FROM roles WHERE role IS NULL OR role = 'Admin ' OR NOT EXISTS (SELECT 1 FROM vis JOIN pc USING (centre) WHERE vis.login = roles.login) UNION SELECT login, 'DEPT', patient_id FROM vis JOIN roles USING (login) JOIN pc USING (centre) WHERE role = 'pflege'")
def visible_patients(spark, d):
    logins, assigned, leaves, edges, unit_map = _auth(spark, d)
    roles = logins.select("login", F.when(F.col("segment") == "MACHINERY", "pflege").when(F.col("segment") == "BUILDING", "Admin ").alias("role"))
    visible = h.dept_visibility(h.employee_centres(logins, assigned, today="2024-06-01"), edges, leaves)
    wards, entries = h.by_entry(view(spark, d, "movements").select("case_id", "dept", F.col("ward").cast("string").alias("ward")), unit_map)
    by_entry = visible.join(entries, "centre").select("login", F.col("entry").alias("centre")).distinct()
    return h.visible_patients(roles, by_entry, wards.withColumnRenamed("entry", "centre"), view(spark, d, "cases"))
