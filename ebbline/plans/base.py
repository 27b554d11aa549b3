"""The driver's tables read as hospital tables, in Spark and as DuckDB CTEs of the same names.

orders stand for cases, lineitem for movements, diagnoses, procedures and
charges, customer for patients, supplier for units, events for the change feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


_SPARK = {
    "cases": ("orders", """
        o_orderkey AS case_id, o_custkey AS patient_id, CAST(o_orderkey % 3 + 1 AS STRING) AS case_type, CAST(o_orderdate AS DATE) AS begin_date,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 20 AS INT)) END AS end_date,
        CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE o_orderpriority END AS specialty, o_orderstatus AS status,
        CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE ' ' END AS cancelled, CASE WHEN o_orderkey % 23 = 0 THEN 'X' ELSE '' END AS locked, o_totalprice AS amount, CAST(o_orderkey % 4 AS INT) AS days_off, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderkey % 3 AS INT) END AS days_off_audit"""""),
    "movements": ("lineitem", """
        l_orderkey AS case_id, CAST(l_linenumber * 10000000 + l_partkey AS BIGINT) AS number, CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN '3' WHEN 3 THEN '6' WHEN 4 THEN '7' WHEN 5 THEN '3' WHEN 6 THEN '2' ELSE '4' END AS kind,
        l_shipdate AS begin_ts, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE timestampadd(HOUR, CAST(l_quantity AS INT) * 5, l_shipdate) END AS end_ts,
        l_suppkey AS ward, l_suppkey % 10 AS dept, CASE WHEN l_partkey % 3 = 0 THEN 'VB' WHEN l_partkey % 3 = 1 THEN 'AO' ELSE 'EN' END AS art,
        lpad(CAST(l_partkey % 9 AS STRING), 2, '0') AS reason, CASE WHEN l_returnflag = 'R' THEN 'X' ELSE ' ' END AS cancelled, CASE WHEN l_orderkey % 3 = 0 THEN 'PEPP' ELSE 'DRG' END AS system, CASE WHEN l_partkey % 101 = 0 THEN 1 ELSE 0 END AS died, CASE WHEN l_partkey % 43 = 0 THEN 1 ELSE 0 END AS newborn, CASE WHEN l_partkey % 41 = 0 THEN 1 ELSE 0 END AS delivery,
        CASE WHEN l_partkey % 37 = 0 THEN 1 ELSE 0 END AS companion, CASE WHEN l_partkey % 74 = 0 THEN 1 ELSE 0 END AS companion_medical, CASE WHEN l_suppkey % 10 = 3 THEN 1 ELSE 0 END AS from_hospital, CASE WHEN l_suppkey % 10 = 7 THEN 1 ELSE 0 END AS to_hospital,
        CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS prestationary, CASE WHEN l_partkey % 31 = 0 THEN 1 ELSE 0 END AS poststationary, CASE WHEN l_linenumber = 1 AND l_partkey % 9 = 3 THEN 1 ELSE 0 END AS day_patient, CASE WHEN l_partkey % 3 = 1 THEN 1 ELSE 0 END AS ambulatory_surgery,
        CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END AS surgery, CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END AS emergency, concat('M', CAST(l_partkey % 7 AS STRING)) AS label, CASE WHEN l_quantity < 30 THEN l_suppkey ELSE NULL END AS room, CASE WHEN l_quantity < 20 THEN l_suppkey ELSE 0 END AS bed,
        CASE WHEN l_tax > 0.04 THEN 'P' ELSE ' ' END AS planned, CASE WHEN l_tax > 0.04 THEN timestampadd(HOUR, -CAST(l_quantity AS INT), l_shipdate) ELSE NULL END AS planned_ts"""),
    "diagnoses": ("lineitem", """
        l_orderkey AS case_id, CAST(l_linenumber * 10000000 + l_partkey AS BIGINT) AS number, concat(chr(65 + CAST(l_partkey % 26 AS INT)), lpad(CAST(l_partkey % 100 AS STRING), 2, '0'), '.', CAST(l_partkey % 10 AS STRING)) AS code,
        CAST(l_shipdate AS DATE) AS day, CASE WHEN l_suppkey % 9 = 0 THEN 'eigener Text' ELSE ' ' END AS own_text, CASE WHEN l_linenumber = 1 THEN 'X' ELSE '' END AS principal, CASE WHEN l_suppkey % 2 = 0 THEN 'X' ELSE '' END AS admission,
        CASE WHEN l_suppkey % 3 = 0 THEN 'X' ELSE '' END AS discharge, CASE WHEN l_suppkey % 5 = 0 THEN 'X' ELSE '' END AS treatment, CASE WHEN l_suppkey % 7 = 0 THEN 'X' ELSE '' END AS surgery,
        CASE WHEN l_returnflag = 'R' THEN 'X' ELSE ' ' END AS cancelled, concat(chr(65 + CAST(l_partkey % 26 AS INT)), lpad(CAST(CASE WHEN l_quantity < 40 THEN l_partkey ELSE l_suppkey END % 100 AS STRING), 2, '0'), '.', CAST(l_partkey % 10 AS STRING)) AS code2, CASE l_partkey % 6 WHEN 0 THEN 'G' WHEN 1 THEN 'V' WHEN 2 THEN 'A' WHEN 3 THEN 'Z' WHEN 4 THEN 'T' ELSE ' ' END AS certainty,
        CASE WHEN l_linenumber = 2 THEN 'X' ELSE '' END AS department, CASE WHEN l_suppkey % 11 = 0 THEN 'X' ELSE '' END AS referral, CASE WHEN l_suppkey % 13 = 0 THEN 'X' ELSE '' END AS preoperative, CASE WHEN l_partkey % 101 = 0 THEN 'X' ELSE '' END AS death, CASE WHEN l_suppkey % 17 = 0 THEN 'X' ELSE '' END AS working,
        CASE WHEN l_quantity < 5 THEN 'x' ELSE lpad(CAST(l_linenumber AS STRING), 2, '0') END AS drg_place, CASE l_linenumber % 4 WHEN 1 THEN 'P' WHEN 2 THEN 'S' WHEN 3 THEN ' ' ELSE 'N' END AS drg_category, CASE WHEN l_tax > 0.03 THEN 'X' ELSE '' END AS drg_relevant, CASE WHEN l_discount > 0.07 THEN ' ' ELSE CAST(l_suppkey % 5 AS STRING) END AS drg_level"""),
    "procedures": ("lineitem", """
        l_orderkey AS case_id, (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS procedure_id, concat('5-', lpad(CAST(l_partkey % 1000 AS STRING), 3, '0')) AS code, CAST(l_shipdate AS DATE) AS day, l_suppkey AS unit,
        CASE WHEN l_returnflag = 'R' THEN 'X' ELSE ' ' END AS cancelled, CASE l_partkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'L' WHEN 2 THEN 'B' ELSE ' ' END AS site"""),
    "patients": ("customer", """
        c_custkey AS patient_id, CASE c_custkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' ELSE ' ' END AS sex, CAST(date_add(DATE'1925-01-01', CAST(c_custkey * 37 % 33000 AS INT)) AS STRING) AS birth, c_name AS name,
        c_nationkey AS region, c_mktsegment AS segment, CASE WHEN c_custkey % 19 = 0 THEN 'X' ELSE '' END AS dead, CASE WHEN c_custkey % 29 = 0 AND c_custkey > 29 THEN c_custkey - 29 ELSE NULL END AS merged_into, c_acctbal AS balance, CASE c_custkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' WHEN 4 THEN '5' ELSE ' ' END AS marital, CASE WHEN c_acctbal < 0 THEN NULL ELSE concat('Street ', CAST(c_custkey % 90 AS STRING)) END AS street, concat('City ', CAST(c_nationkey AS STRING)) AS city,
        lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS postcode, CAST(c_nationkey AS STRING) AS country, CASE WHEN c_acctbal > 5000 THEN c_custkey % 97 ELSE 0 END AS doctor, CASE WHEN c_custkey % 19 = 0 AND c_acctbal > 0 THEN '2003-05-06T07:08:09' ELSE NULL END AS dead_on"""),
    "units": ("supplier", "s_suppkey AS unit_id, s_name AS unit_name, s_nationkey AS house"),
    "codes": ("part", """p_partkey AS code_id, p_name AS text, p_brand AS brand, p_type AS kind, p_size AS size, p_retailprice AS price"""),
    "changes": ("events", """
        user_id AS key, lpad(CAST(event_id AS STRING), 12, '0') AS _seq, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS _op, event_type AS state, value, CAST(ts AS TIMESTAMP) AS ts,
        date_format(ts, 'yyyy') AS jahr"""),
    "charges": ("lineitem", """
        l_orderkey AS case_id, (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS charge_id, l_partkey AS code_id, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax, l_returnflag AS flag,
        CAST(l_shipdate AS DATE) AS day, CASE l_linenumber WHEN 1 THEN 'E1' WHEN 2 THEN 'E2' WHEN 3 THEN 'E31' WHEN 4 THEN 'E32' WHEN 5 THEN 'E33' WHEN 6 THEN 'E11' ELSE 'NUB' END AS class, CASE WHEN l_tax > 0.04 THEN 'P' ELSE ' ' END AS planned, concat('KST ', CAST(1000 + l_suppkey AS STRING), ' ', l_linestatus) AS note"""),
    "labs": ("events", """
        event_id AS lab_id, user_id AS patient_id, event_type AS code, ts, value AS number,
        CASE event_id % 6 WHEN 0 THEN concat('<', replace(CAST(CAST(value AS DECIMAL(12, 2)) AS STRING), '.', ',')) WHEN 1 THEN CAST(CAST(value AS DECIMAL(12, 2)) AS STRING) WHEN 2 THEN concat('1.', lpad(CAST(event_id % 1000 AS STRING), 3, '0'), ',5')
          WHEN 3 THEN 'positiv' WHEN 4 THEN concat('1,', lpad(CAST(event_id % 1000 AS STRING), 3, '0'), '.25') ELSE concat('>= ', CAST(event_id % 90 AS STRING)) END AS raw,
        CASE event_id % 5 WHEN 0 THEN '10 - 150' WHEN 1 THEN 'bis 50,5' WHEN 2 THEN '> 20' WHEN 3 THEN 'negativ' ELSE NULL END AS normal,
        CASE event_id % 9 WHEN 0 THEN '+' WHEN 1 THEN 'LL' WHEN 2 THEN 'krass' ELSE '' END AS flag, CASE event_id % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'P' WHEN 2 THEN 'C' ELSE 'Q' END AS status,
        CASE event_id % 12 WHEN 0 THEN 'mg/dl' WHEN 1 THEN 'Tsd/ul' WHEN 2 THEN '%' WHEN 3 THEN 'umol/l' WHEN 4 THEN 'IU/l' WHEN 5 THEN 'mmHg' WHEN 6 THEN '/nl' WHEN 7 THEN 'g/mol' WHEN 8 THEN 'pg/ml' WHEN 9 THEN 'mval/l' WHEN 10 THEN 'min' ELSE 'foo' END AS unit"""),
}

_DUCK = {
    "cases": """SELECT o_orderkey AS case_id, o_custkey AS patient_id, CAST(o_orderkey % 3 + 1 AS VARCHAR) AS case_type, CAST(o_orderdate AS DATE) AS begin_date,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) END AS end_date, CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE o_orderpriority END AS specialty, o_orderstatus AS status,
  CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE ' ' END AS cancelled, CASE WHEN o_orderkey % 23 = 0 THEN 'X' ELSE '' END AS locked, o_totalprice AS amount, CAST(o_orderkey % 4 AS INT) AS days_off, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderkey % 3 AS INT) END AS days_off_audit FROM orders""",
    "movements": """SELECT l_orderkey AS case_id, CAST(l_linenumber * 10000000 + l_partkey AS BIGINT) AS number, CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN '3' WHEN 3 THEN '6' WHEN 4 THEN '7' WHEN 5 THEN '3' WHEN 6 THEN '2' ELSE '4' END AS kind,
  CAST(l_shipdate AS TIMESTAMP) AS begin_ts, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_quantity AS INTEGER) * 5) END AS end_ts, l_suppkey AS ward, l_suppkey % 10 AS dept,
  CASE WHEN l_partkey % 3 = 0 THEN 'VB' WHEN l_partkey % 3 = 1 THEN 'AO' ELSE 'EN' END AS art, lpad(CAST(l_partkey % 9 AS VARCHAR), 2, '0') AS reason, CASE WHEN l_returnflag = 'R' THEN 'X' ELSE ' ' END AS cancelled, CASE WHEN l_orderkey % 3 = 0 THEN 'PEPP' ELSE 'DRG' END AS system, CASE WHEN l_partkey % 101 = 0 THEN 1 ELSE 0 END AS died, CASE WHEN l_partkey % 43 = 0 THEN 1 ELSE 0 END AS newborn, CASE WHEN l_partkey % 41 = 0 THEN 1 ELSE 0 END AS delivery,
        CASE WHEN l_partkey % 37 = 0 THEN 1 ELSE 0 END AS companion, CASE WHEN l_partkey % 74 = 0 THEN 1 ELSE 0 END AS companion_medical, CASE WHEN l_suppkey % 10 = 3 THEN 1 ELSE 0 END AS from_hospital, CASE WHEN l_suppkey % 10 = 7 THEN 1 ELSE 0 END AS to_hospital,
        CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS prestationary, CASE WHEN l_partkey % 31 = 0 THEN 1 ELSE 0 END AS poststationary, CASE WHEN l_linenumber = 1 AND l_partkey % 9 = 3 THEN 1 ELSE 0 END AS day_patient, CASE WHEN l_partkey % 3 = 1 THEN 1 ELSE 0 END AS ambulatory_surgery,
        CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END AS surgery, CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END AS emergency, concat('M', CAST(l_partkey % 7 AS VARCHAR)) AS label, CASE WHEN l_quantity < 30 THEN l_suppkey ELSE NULL END AS room, CASE WHEN l_quantity < 20 THEN l_suppkey ELSE 0 END AS bed,
        CASE WHEN l_tax > 0.04 THEN 'P' ELSE ' ' END AS planned, CASE WHEN l_tax > 0.04 THEN CAST(l_shipdate AS TIMESTAMP) - to_hours(CAST(l_quantity AS INTEGER)) ELSE NULL END AS planned_ts FROM lineitem""",
    "diagnoses": """SELECT l_orderkey AS case_id, CAST(l_linenumber * 10000000 + l_partkey AS BIGINT) AS number, chr(65 + CAST(l_partkey % 26 AS INTEGER)) || lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') || '.' || CAST(l_partkey % 10 AS VARCHAR) AS code, CAST(l_shipdate AS DATE) AS day,
  CASE WHEN l_suppkey % 9 = 0 THEN 'eigener Text' ELSE ' ' END AS own_text, CASE WHEN l_linenumber = 1 THEN 'X' ELSE '' END AS principal, CASE WHEN l_suppkey % 2 = 0 THEN 'X' ELSE '' END AS admission, CASE WHEN l_suppkey % 3 = 0 THEN 'X' ELSE '' END AS discharge, CASE WHEN l_suppkey % 5 = 0 THEN 'X' ELSE '' END AS treatment,
  CASE WHEN l_suppkey % 7 = 0 THEN 'X' ELSE '' END AS surgery, CASE WHEN l_returnflag = 'R' THEN 'X' ELSE ' ' END AS cancelled, concat(chr(65 + CAST(l_partkey % 26 AS INT)), lpad(CAST(CASE WHEN l_quantity < 40 THEN l_partkey ELSE l_suppkey END % 100 AS VARCHAR), 2, '0'), '.', CAST(l_partkey % 10 AS VARCHAR)) AS code2, CASE l_partkey % 6 WHEN 0 THEN 'G' WHEN 1 THEN 'V' WHEN 2 THEN 'A' WHEN 3 THEN 'Z' WHEN 4 THEN 'T' ELSE ' ' END AS certainty,
        CASE WHEN l_linenumber = 2 THEN 'X' ELSE '' END AS department, CASE WHEN l_suppkey % 11 = 0 THEN 'X' ELSE '' END AS referral, CASE WHEN l_suppkey % 13 = 0 THEN 'X' ELSE '' END AS preoperative, CASE WHEN l_partkey % 101 = 0 THEN 'X' ELSE '' END AS death, CASE WHEN l_suppkey % 17 = 0 THEN 'X' ELSE '' END AS working,
        CASE WHEN l_quantity < 5 THEN 'x' ELSE lpad(CAST(l_linenumber AS VARCHAR), 2, '0') END AS drg_place, CASE l_linenumber % 4 WHEN 1 THEN 'P' WHEN 2 THEN 'S' WHEN 3 THEN ' ' ELSE 'N' END AS drg_category, CASE WHEN l_tax > 0.03 THEN 'X' ELSE '' END AS drg_relevant, CASE WHEN l_discount > 0.07 THEN ' ' ELSE CAST(l_suppkey % 5 AS VARCHAR) END AS drg_level FROM lineitem""",
    "procedures": """SELECT l_orderkey AS case_id, (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS procedure_id, '5-' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS code, CAST(l_shipdate AS DATE) AS day, l_suppkey AS unit,
  CASE WHEN l_returnflag = 'R' THEN 'X' ELSE ' ' END AS cancelled, CASE l_partkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'L' WHEN 2 THEN 'B' ELSE ' ' END AS site FROM lineitem""",
    "patients": """SELECT c_custkey AS patient_id, CASE c_custkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' ELSE ' ' END AS sex, CAST(DATE '1925-01-01' + CAST(c_custkey * 37 % 33000 AS INTEGER) AS VARCHAR) AS birth, c_name AS name,
  c_nationkey AS region, c_mktsegment AS segment, CASE WHEN c_custkey % 19 = 0 THEN 'X' ELSE '' END AS dead, CASE WHEN c_custkey % 29 = 0 AND c_custkey > 29 THEN c_custkey - 29 ELSE NULL END AS merged_into, c_acctbal AS balance, CASE c_custkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' WHEN 4 THEN '5' ELSE ' ' END AS marital, CASE WHEN c_acctbal < 0 THEN NULL ELSE concat('Street ', CAST(c_custkey % 90 AS VARCHAR)) END AS street, concat('City ', CAST(c_nationkey AS VARCHAR)) AS city,
        lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postcode, CAST(c_nationkey AS VARCHAR) AS country, CASE WHEN c_acctbal > 5000 THEN c_custkey % 97 ELSE 0 END AS doctor, CASE WHEN c_custkey % 19 = 0 AND c_acctbal > 0 THEN '2003-05-06T07:08:09' ELSE NULL END AS dead_on FROM customer""",
    "units": "SELECT s_suppkey AS unit_id, s_name AS unit_name, s_nationkey AS house FROM supplier",
    "codes": "SELECT p_partkey AS code_id, p_name AS text, p_brand AS brand, p_type AS kind, p_size AS size, p_retailprice AS price FROM part",
    "changes": """SELECT user_id AS key, lpad(CAST(event_id AS VARCHAR), 12, '0') AS _seq, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS _op, event_type AS state, value, CAST(ts AS TIMESTAMP) AS ts, strftime(ts, '%Y') AS jahr FROM events""",
    "charges": """SELECT l_orderkey AS case_id, (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS charge_id, l_partkey AS code_id, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS day,
  CASE l_linenumber WHEN 1 THEN 'E1' WHEN 2 THEN 'E2' WHEN 3 THEN 'E31' WHEN 4 THEN 'E32' WHEN 5 THEN 'E33' WHEN 6 THEN 'E11' ELSE 'NUB' END AS class, CASE WHEN l_tax > 0.04 THEN 'P' ELSE ' ' END AS planned, concat('KST ', CAST(1000 + l_suppkey AS VARCHAR), ' ', l_linestatus) AS note FROM lineitem""",
    "labs": """SELECT event_id AS lab_id, user_id AS patient_id, event_type AS code, CAST(ts AS TIMESTAMP) AS ts, value AS number,
  CASE event_id % 6 WHEN 0 THEN '<' || replace(CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR), '.', ',') WHEN 1 THEN CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) WHEN 2 THEN '1.' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || ',5'
    WHEN 3 THEN 'positiv' WHEN 4 THEN '1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '.25' ELSE '>= ' || CAST(event_id % 90 AS VARCHAR) END AS raw,
  CASE event_id % 5 WHEN 0 THEN '10 - 150' WHEN 1 THEN 'bis 50,5' WHEN 2 THEN '> 20' WHEN 3 THEN 'negativ' ELSE NULL END AS normal, CASE event_id % 9 WHEN 0 THEN '+' WHEN 1 THEN 'LL' WHEN 2 THEN 'krass' ELSE '' END AS flag,
  CASE event_id % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'P' WHEN 2 THEN 'C' ELSE 'Q' END AS status, CASE event_id % 12 WHEN 0 THEN 'mg/dl' WHEN 1 THEN 'Tsd/ul' WHEN 2 THEN '%' WHEN 3 THEN 'umol/l' WHEN 4 THEN 'IU/l' WHEN 5 THEN 'mmHg' WHEN 6 THEN '/nl' WHEN 7 THEN 'g/mol' WHEN 8 THEN 'pg/ml' WHEN 9 THEN 'mval/l' WHEN 10 THEN 'min' ELSE 'foo' END AS unit FROM events""",
}


def view(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A hospital table over the driver's tables; only the columns in use are read."""
    source, columns = _SPARK[name]
    return table(spark, d, source).selectExpr(*_split(columns))


def _split(columns: str) -> list[str]:
    """Top-level comma-separated expressions."""
    out, depth, quoted, now = [], 0, False, ""
    for c in columns:
        quoted ^= c == "'"
        depth += 0 if quoted else (c == "(") - (c == ")")
        if c == "," and not depth and not quoted:
            out.append(now.strip())
            now = ""
        else:
            now += c
    return [*out, now.strip()]


def duck(body: str, *names: str) -> str:
    """``body`` with the named hospital tables as CTEs before it; ``body`` may begin with more CTEs (", x AS (...)")."""
    ctes = ", ".join(f"{n} AS ({_DUCK[n]})" for n in names)
    return f"WITH {ctes}{body if body.lstrip().startswith(',') else ' ' + body}" if names else body


def money(column):
    """A double as an exact decimal, so that sums do not depend on their order."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,4)")
