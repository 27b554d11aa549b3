"""Queries of sources, change feeds, current state and quality."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import current_state as cs
from ..operators import quality as q
from ..sources import bronze as br
from ..sources import changes as ch
from ..sources import cohort as co
from ..sources import registry as rg
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


ORDERS = rg.TableSpec("orders", ("o_orderkey",), ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), partition_date="o_orderdate", tenant_col="o_orderstatus")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders WHERE o_orderstatus = 'F'")
def scan_registry(spark, d):
    return rg.scan(spark, d, ORDERS, tenant="F")


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment, CAST(NULL AS VARCHAR) AS house FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, 'h' || s_nationkey FROM supplier")
def scan_merge_schema(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("h"), F.col("s_nationkey")).alias("house"))
    return rg.merge_schema(a, b)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders WHERE (o_custkey > 100) OR (o_custkey = 100 AND o_orderkey > 500)")
def keyset_after(spark, d):
    return rg.after_key(table(spark, d, "orders"), ["o_custkey", "o_orderkey"], [100, 500]).select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")


@query("SELECT jahr, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(substr(coalesce(CAST(end_date AS VARCHAR), ''), 1, 4), '^[0-9]{4}$') THEN substr(CAST(end_date AS VARCHAR), 1, 4) ELSE 'unknown' END AS jahr FROM cases) GROUP BY jahr", "cases")
def year_partition_key(spark, d):
    return view(spark, d, "cases").select(F.coalesce(rg.year_partition(F.col("end_date")), F.lit("unknown")).alias("jahr")).groupBy("jahr").agg(F.count("*").alias("n"))


@query("SELECT CAST(year(o_orderdate) AS VARCHAR) AS jahr, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY 1")
def backfill_partitioned(spark, d):
    """A backfill in four slices that stops after two, and another run that goes on from its log."""
    root, df = new_path(spark, "backfill"), rg.scan(spark, d, ORDERS)
    for most in (2, None):
        br.backfill_table(df, root, ORDERS, rows_per_slice=math.ceil(df.count() / 4), most_slices=most)
    return br.read_backfill(spark, root, "orders").groupBy("jahr").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("SELECT 'orders' AS table_name, 'backfill' AS phase, '{\"o_orderkey\":' || max(o_orderkey) || '}' AS cursor, count(*) AS rows_total FROM orders")
def backfill_cursor(spark, d):
    """What the log of a finished backfill says."""
    root, df = new_path(spark, "backfill"), rg.scan(spark, d, ORDERS)
    br.backfill_table(df, root, ORDERS, rows_per_slice=math.ceil(df.count() / 3))
    return br.backfill_state(spark, root, "orders").select("table_name", "phase", "cursor", "rows_total")


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def backfill_reference(spark, d):
    """Two reference tables copied whole; the copies, joined."""
    n, r = (new_path(spark, name) for name in ("nation", "region"))
    rg.copy_whole(table(spark, d, "nation"), n)
    rg.copy_whole(table(spark, d, "region"), r)
    return spark.read.parquet(n).join(spark.read.parquet(r), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


@query("SELECT key, _seq, _op, state FROM changes WHERE _seq > '000000000500'", "changes")
def cdc_change_rows(spark, d):
    return ch.change_rows(view(spark, d, "changes").select("key", "_seq", "_op", "state"), "000000000500")


@query("""SELECT user_id, value, CASE upper(event_type) WHEN 'SIGNUP' THEN 'I' WHEN 'ERROR' THEN 'D' ELSE 'U' END AS _op, CAST(event_id AS VARCHAR) AS _seq FROM events""")
def cdc_normalize_ops(spark, d):
    raw = table(spark, d, "events").select("user_id", "value", F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "DELETE").otherwise(F.col("event_type")).alias("header__change_oper"), F.col("event_id").alias("header__change_seq"))
    return ch.normalize_changes(raw)


@query("SELECT case_id, 'U' AS _op, CAST(begin_date AS VARCHAR) AS _seq FROM cases WHERE begin_date >= DATE '1997-01-01' - 1", "cases")
def cdc_watermark_overlap(spark, d):
    return ch.watermark_changes(view(spark, d, "cases").select("case_id", "begin_date"), "begin_date", "1997-01-01").select("case_id", "_op", "_seq")


@query("""SELECT table_name, watermark, oldest, coalesce(oldest > watermark, false) AS gap FROM (SELECT state AS table_name, CASE WHEN state IN ('signup', 'error') THEN '' ELSE '000000000400' END AS watermark, min(_seq) FILTER (WHERE _seq > '000000000300') AS oldest FROM changes GROUP BY 1)""", "changes")
def cdc_retention_gap(spark, d):
    c = view(spark, d, "changes").withColumnRenamed("state", "table_name")
    state = c.select("table_name").distinct().withColumn("watermark", F.when(F.col("table_name").isin("signup", "error"), "").otherwise("000000000400"))
    return ch.retention_gaps(c.where("_seq > '000000000300'"), state)


_COHORT = ", adm AS (SELECT DISTINCT case_id FROM movements WHERE kind = '1' AND trim(cancelled) NOT IN ('X', '1') AND end_ts IS NULL), pats AS (SELECT DISTINCT patient_id FROM cases WHERE case_id IN (SELECT case_id FROM adm))"


def _patients(spark, d):
    return co.current_inpatients(view(spark, d, "movements"), view(spark, d, "cases"), case="case_id", patient="patient_id", kind="kind", end="end_ts", cancelled="cancelled")


@query(_COHORT + " SELECT patient_id FROM pats", "cases", "movements")
def cohort_current_inpatients(spark, d):
    return _patients(spark, d)


@query(_COHORT + " SELECT case_id, patient_id, begin_date FROM cases WHERE patient_id IN (SELECT patient_id FROM pats)", "cases", "movements")
def cohort_expand_history(spark, d):
    return co.expand_history(view(spark, d, "cases"), _patients(spark, d), patient="patient_id").select("case_id", "patient_id", "begin_date")


@query(_COHORT + ", cc AS (SELECT case_id FROM cases WHERE patient_id IN (SELECT patient_id FROM pats)) SELECT case_id, number, code FROM diagnoses WHERE case_id IN (SELECT case_id FROM cc)", "cases", "movements", "diagnoses")
def cohort_filter_table(spark, d):
    keys = co.expand_history(view(spark, d, "cases"), _patients(spark, d), patient="patient_id").select("case_id")
    return co.semi(view(spark, d, "diagnoses"), keys, "case_id").select("case_id", "number", "code")


@query("""SELECT key, state, max_by(_seq, ts) AS change_seq, CAST(sum(1) AS BIGINT) AS rows_total, max(ts) AS last_run FROM (SELECT key, state, _seq, ts FROM changes) GROUP BY key, state""", "changes")
def extract_state_latest(spark, d):
    log = view(spark, d, "changes").select("key", "state", F.col("_seq").alias("change_seq"), "ts", F.lit(1).alias("n"))
    return ch.latest_state(log, ["key", "state"], ts="ts", values=["change_seq"], rows="n")


@query("SELECT _seq, state FROM changes ORDER BY ts DESC, _seq DESC LIMIT 100", "changes")
def run_log_recent(spark, d):
    return view(spark, d, "changes").orderBy(F.desc("ts"), F.desc("_seq")).limit(100).select("_seq", "state")


@query("SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS is_unique FROM lineitem")
def pk_uniqueness(spark, d):
    return q.pk_uniqueness(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT 'specialty' AS column_name, count(*) FILTER (WHERE trim(specialty) <> '') AS filled, count(*) AS n_rows FROM cases UNION ALL SELECT 'end_date', count(end_date), count(*) FROM cases UNION ALL SELECT 'locked', count(*) FILTER (WHERE trim(locked) <> ''), count(*) FROM cases""", "cases")
def fill_audit(spark, d):
    return q.fill_audit(view(spark, d, "cases"), ["specialty", "end_date", "locked"])


@query("SELECT count(DISTINCT c.patient_id) AS n_keys, count(DISTINCT p.patient_id) AS n_matched FROM cases c LEFT JOIN (SELECT patient_id FROM patients WHERE segment <> 'BUILDING') p USING (patient_id)", "cases", "patients")
def join_coverage(spark, d):
    return q.join_coverage(view(spark, d, "cases"), view(spark, d, "patients").where("segment <> 'BUILDING'"), "patient_id", "patient_id")


@query("SELECT kind AS a, cancelled AS b, count(*) AS n FROM movements GROUP BY 1, 2", "movements")
def pair_distribution(spark, d):
    return q.pair_distribution(view(spark, d, "movements"), F.col("kind"), F.col("cancelled"))


# current state -----------------------------------------------------------------------------------------

_SPLIT = ", base AS (SELECT * FROM changes WHERE _seq < '000000000300'), delta AS (SELECT * FROM changes WHERE _seq >= '000000000300')"
_NOW = _SPLIT + ", b1 AS (SELECT key, max_by(state, _seq) AS state, max_by(value, _seq) AS value, max_by(ts, _seq) AS ts FROM base GROUP BY key), every AS (SELECT key, state, value, ts, '' AS _seq, '' AS _op FROM b1 UNION ALL SELECT key, state, value, ts, _seq, _op FROM delta), now AS (SELECT key, max_by(state, _seq) AS state, max_by(value, _seq) AS value, max_by(ts, _seq) AS ts, max_by(_op, _seq) AS op FROM every GROUP BY key)"


def _base_delta(spark, d):
    c = view(spark, d, "changes")
    base = c.where("_seq < '000000000300'").groupBy("key").agg(*[F.max_by(x, "_seq").alias(x) for x in ("state", "value", "ts")])
    return base, c.where("_seq >= '000000000300'").drop("jahr")


@query(_NOW + " SELECT key, state, value, ts FROM now WHERE op <> 'D'", "changes")
def current_state(spark, d):
    return cs.current_state(*_base_delta(spark, d), key=["key"])


@query(_NOW + " SELECT key, state, value, ts FROM now WHERE op <> 'D'", "changes")
def current_state_partial_pk(spark, d):
    return cs.current_state(*_base_delta(spark, d), key=["client", "key"])


def _years(spark, d, since: str | None = "1997"):
    """All cases. Of those that end from ``since`` on (None: of all), the partly billed ones come as inserts only and the open ones as updates too, deletes where they are locked; the base holds all others."""
    c = view(spark, d, "cases").select("case_id", "patient_id", F.coalesce("end_date", "begin_date").cast("string").alias("end_date"), "status", "locked")
    recent = F.col("end_date") >= since if since else F.lit(True)
    op = F.when(F.col("locked") == "X", "D").when(F.col("status") == "P", "I").otherwise("U")
    base = c.where(~recent | (F.col("status") != "P")).drop("status", "locked")
    delta = c.where(recent & (F.col("status") != "F")).select("case_id", (F.col("patient_id") + 1).alias("patient_id"), "end_date", op.alias("_op"), F.lpad(F.col("case_id").cast("string"), 12, "0").alias("_seq"))
    return base, delta


_C = ", c AS (SELECT case_id, patient_id, CAST(coalesce(end_date, begin_date) AS VARCHAR) AS end_date, status, locked FROM cases)"
_Y = _C + ", delta AS (SELECT * FROM c WHERE status <> 'F' AND end_date >= '1997')"


@query(_Y + " SELECT case_id, CASE WHEN case_id IN (SELECT case_id FROM delta) THEN patient_id + 1 ELSE patient_id END AS patient_id, end_date, substr(end_date, 1, 4) AS jahr FROM c WHERE case_id NOT IN (SELECT case_id FROM delta WHERE locked = 'X')", "cases")
def compact_deltas(spark, d):
    """The table by year and its files of changes, written; compacted; read again."""
    base, delta = _years(spark, d)
    root = new_path(spark, "bronze")
    br.write_years(base, f"{root}/cases", "end_date", key=["case_id"], parts=2)
    delta.write.parquet(f"{root}/_delta/cases")
    br.compact_table(spark, root, "cases", key=["case_id"], date="end_date")
    return br.read_years(spark, f"{root}/cases")


@query(_C + ", y AS (SELECT status, coalesce(substr(end_date, 1, 4), 'unknown') AS jahr FROM c), delta AS (SELECT jahr FROM y WHERE status <> 'F') SELECT jahr FROM delta UNION SELECT jahr FROM y WHERE status <> 'P' AND 'unknown' IN (SELECT jahr FROM delta)", "cases")
def affected_partitions(spark, d):
    """The years of all changes, whenever the case ended."""
    base, delta = _years(spark, d, since=None)
    return cs.affected_partitions(delta, base.withColumn("jahr", rg.year_partition(F.col("end_date"))), date="end_date")


@query("SELECT case_id, begin_date FROM cases WHERE begin_date >= DATE '1998-01-01' - 90", "cases")
def archive_horizon(spark, d):
    return cs.within_horizon(view(spark, d, "cases").select("case_id", "begin_date"), ingested="begin_date", today="1998-01-01")


@query("SELECT patient_id, name FROM patients WHERE patient_id IN (SELECT key FROM changes WHERE _seq > '000000000800')", "patients", "changes")
def changed_keys_filter(spark, d):
    c = view(spark, d, "changes").withColumnRenamed("key", "patient_id")
    return cs.changed_keys(view(spark, d, "patients").select("patient_id", "name"), [c.where("_op <> 'D'"), c.where("_op = 'D'")], key=["patient_id"], since="000000000800")


@query("SELECT state, max(_seq) AS max_seq FROM changes GROUP BY state", "changes")
def delta_max_seq(spark, d):
    return cs.max_seq(view(spark, d, "changes"), table="state")


@query(""", e AS (SELECT key, _seq, _op, state, value FROM changes), l AS (SELECT key, max_by(_op, _seq) AS op, max_by(state, _seq) AS state, max_by(value, _seq) AS value, max(_seq) AS _seq FROM e GROUP BY key) SELECT key, state, value, _seq FROM l WHERE op <> 'D'""", "changes")
def cdc_stream_upsert(spark, d):
    from ..streaming.upsert import run_once

    return run_once(spark, view(spark, d, "changes").select("key", "_seq", "_op", "state", "value"), new_path(spark, "stream"), key=["key"])


# quality -----------------------------------------------------------------------------------------------


@query(""", o AS (SELECT o_orderstatus || '-' || substr(o_orderpriority, 1, 1) AS table_name, o_totalprice FROM orders), l AS (SELECT table_name, count(*) AS local_rows FROM o WHERE NOT (table_name IN ('F-2', 'P-4') AND o_totalprice < 5000) GROUP BY 1), s AS (SELECT table_name, count(*) AS source_rows FROM o WHERE table_name <> 'P-5' GROUP BY 1)
SELECT table_name, local_rows, source_rows, round(abs(source_rows - local_rows) / greatest(source_rows, 1), 6) AS deviation, CASE WHEN source_rows IS NULL THEN 'UNKNOWN' WHEN table_name = 'O-3' THEN 'COHORT' WHEN abs(source_rows - local_rows) / greatest(source_rows, 1) <= 0.001 THEN 'OK' ELSE 'ALARM' END AS status FROM l LEFT JOIN s USING (table_name)""".replace(", o AS", "WITH o AS", 1))
def reconcile_counts(spark, d):
    o = table(spark, d, "orders").withColumn("table_name", F.concat_ws("-", "o_orderstatus", F.substring("o_orderpriority", 1, 1)))
    local = o.where("not (table_name in ('F-2', 'P-4') and o_totalprice < 5000)").groupBy("table_name").agg(F.count("*").alias("local_rows"))
    source = o.where("table_name <> 'P-5'").groupBy("table_name").agg(F.count("*").alias("source_rows"))
    return q.reconcile(local, source, cohort=F.col("table_name") == "O-3")


def _profile_sql(cols):
    part = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS v FROM cases" for c in cols)
    return f""", x AS ({part}), n AS (SELECT column_name, v, count(*) AS n FROM x GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, v) AS r FROM n WHERE v IS NOT NULL),
t AS (SELECT column_name, string_agg(v || ' (' || n || ')', ', ' ORDER BY r) AS top_values FROM r WHERE r <= 8 GROUP BY 1)
SELECT column_name, CAST(sum(n) AS BIGINT) AS n_rows, round(coalesce(sum(n) FILTER (WHERE v IS NULL), 0) * 100.0 / sum(n), 2) AS null_percent, coalesce(any_value(top_values), '') AS top_values FROM n LEFT JOIN t USING (column_name) GROUP BY column_name"""


@query(_profile_sql(["case_type", "end_date", "specialty", "status", "cancelled"]), "cases")
def field_profile(spark, d):
    return q.field_profile(view(spark, d, "cases"), ["case_type", "end_date", "specialty", "status", "cancelled"])


@query("SELECT DISTINCT l_suppkey AS unit_id FROM lineitem WHERE l_suppkey NOT IN (SELECT unit_id FROM (SELECT s_suppkey AS unit_id FROM supplier WHERE s_nationkey <> 7))")
def coverage_diff(spark, d):
    return q.coverage_diff(view(spark, d, "movements").select(F.col("ward").alias("unit_id")), view(spark, d, "units").where("house <> 7"), "unit_id")


@query(""", m AS (SELECT kind, avg(CAST(epoch(end_ts) - epoch(begin_ts) AS DOUBLE)) AS avg_s, count(*) AS n_runs FROM movements WHERE end_ts IS NOT NULL GROUP BY kind) SELECT kind, n_runs, round(avg_s, 4) AS avg_s, round(avg_s / (SELECT sum(avg_s) FROM m), 4) AS ratio FROM m""", "movements")
def log_step_stats(spark, d):
    return q.log_step_stats(view(spark, d, "movements").where("end_ts is not null"), run="case_id", step="kind", seconds=F.unix_timestamp("end_ts") - F.unix_timestamp("begin_ts"))


@query("SELECT case_id, max_by(kind, (begin_ts, number)) AS kind FROM movements GROUP BY case_id", "movements")
def log_latest_value(spark, d):
    return q.log_latest(view(spark, d, "movements"), run="case_id", order=[F.col("begin_ts"), F.col("number")], value="kind")


@query("""WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS child, 'n' || n_nationkey AS parent FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
t AS (SELECT 'r1' AS node, 0 AS depth UNION ALL SELECT parent, depth + 1 FROM t JOIN e ON node = child) SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM t GROUP BY node""")
def lineage_impact(spark, d):
    e = q.union_all([
        table(spark, d, "nation").select(F.concat(F.lit("r"), F.col("n_regionkey")).alias("child"), F.concat(F.lit("n"), F.col("n_nationkey")).alias("parent")),
        table(spark, d, "supplier").select(F.concat(F.lit("n"), F.col("s_nationkey")).alias("child"), F.concat(F.lit("s"), F.col("s_suppkey")).alias("parent")),
        table(spark, d, "customer").select(F.concat(F.lit("n"), F.col("c_nationkey")).alias("child"), F.concat(F.lit("c"), F.col("c_custkey")).alias("parent")),
    ])
    changed = table(spark, d, "region").where("r_regionkey = 1").select(F.concat(F.lit("r"), F.col("r_regionkey")))
    return q.lineage_impact(e, changed, child="child", parent="parent")


@query(""", p AS (SELECT conv_id, turn, coalesce(text, '') AS payload, sha256(coalesce(lag(coalesce(text, '')) OVER w, '')) AS lag_h FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
c AS (SELECT conv_id, turn, CASE WHEN turn = 0 THEN '' ELSE lag_h END AS prev, sha256(payload) AS own FROM p) SELECT conv_id, count(*) AS n, min(turn) FILTER (WHERE turn > 0 OR conv_id % 10 = 3) AS first_break FROM c GROUP BY conv_id""".replace(", p AS", "WITH p AS", 1))
def audit_chain_verify(spark, d):
    """Chains whose first entry is sound (but for one in ten, tampered with) and whose others do not refer to it."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("payload"))
    c = c.withColumn("prev", F.when(F.col("turn") == 0, "").otherwise(F.sha2(F.concat(F.lit("none"), F.col("payload")), 256)))
    tampered = (F.col("conv_id") % 10 == 3) & (F.col("turn") == 0)
    c = c.withColumn("entry", F.sha2(F.concat(F.col("prev"), F.when(tampered, F.concat(F.col("payload"), F.lit("!"))).otherwise(F.col("payload"))), 256))
    return q.audit_chain(c, order="turn", payload="payload", prev="prev", entry="entry", chain="conv_id")


@query("SELECT 'log' AS chain, count(*) AS n, min(event_id) FILTER (WHERE event_id > (SELECT min(event_id) FROM events)) AS first_break FROM events")
def audit_chain_single(spark, d):
    """All events as one chain whose entries do not refer to the one before, so that it breaks at the second; read by ranges."""
    e = table(spark, d, "events").select(F.lit("log").alias("chain"), "event_id", F.concat("event_type", F.col("event_id").cast("string")).alias("payload"), F.lit("").alias("prev"))
    return q.audit_chain(e.withColumn("entry", F.sha2("payload", 256)), order="event_id", payload="payload", prev="prev", entry="entry", chain="chain")
