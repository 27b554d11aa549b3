"""Queries of validity history and temporal joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import history as hi
from ..operators import temporal as tj
from .base import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


AT = "2024-01-28 00:00:00"
SEQ9 = "9" * 35


def _changes(spark, d):
    """Events as changes of users, and customers as the snapshot."""
    e = table(spark, d, "events").select(
        F.col("user_id").alias("key"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("change_seq"),
        F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").when(F.col("event_type") == "view", "B").otherwise("U").alias("change_type"),
        F.date_trunc("second", "ts").cast("timestamp").alias("change_time"), F.floor(F.col("value") / 60).cast("long").alias("payload"), F.when(F.col("event_id") % 7 == 0, 1).otherwise(0).alias("storno"),
        F.when(F.col("event_id") % 7 == 0, F.date_trunc("day", "ts").cast("timestamp")).alias("storno_date"), F.lit("2024-01-01 06:00:00").cast("timestamp").alias("created"),
    )
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), (F.col("c_custkey") % 3).alias("payload"), F.lit(0).alias("storno"), F.lit(None).cast("timestamp").alias("storno_date"), F.lit("2024-01-01 06:00:00").cast("timestamp").alias("created"))
    return c, e


_C0 = f"""WITH e AS (SELECT user_id AS key, lpad(CAST(event_id AS VARCHAR), 12, '0') AS change_seq, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' WHEN 'view' THEN 'B' ELSE 'U' END AS change_type,
  (CAST(date_trunc('second', ts) AS TIMESTAMP) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' AS change_time, CAST(floor(value / 60) AS BIGINT) AS payload, CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS storno,
  CASE WHEN event_id % 7 = 0 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS storno_date, TIMESTAMP '2024-01-01 06:00:00' AS created FROM events),
c0 AS (SELECT c_custkey AS key, '{SEQ9}' AS change_seq, 'O' AS change_type, TIMESTAMP '{AT}' AS change_time, c_custkey % 3 AS payload, 0 AS storno, CAST(NULL AS TIMESTAMP) AS storno_date, TIMESTAMP '2024-01-01 06:00:00' AS created FROM customer
  UNION ALL SELECT * FROM e WHERE change_time <= TIMESTAMP '{AT}')"""
_C1 = _C0 + ", c1 AS (SELECT *, sha1(concat_ws('|', coalesce('=' || CAST(payload AS VARCHAR), '~'), coalesce('=' || CAST(storno AS VARCHAR), '~'))) AS hash_id FROM c0)"
_C2 = _C1 + ", c2 AS (SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY change_seq, change_type) * 2 AS BIGINT) AS seq_id FROM c1)"
_C3 = _C2 + """, c3a AS (SELECT *, lag(change_type) OVER w AS pt, lag(hash_id) OVER w AS ph, lead(hash_id) OVER w AS nh, lag(change_time) OVER w AS pv FROM c2 WINDOW w AS (PARTITION BY key ORDER BY seq_id)),
c3 AS (SELECT key, change_seq, change_type, CASE WHEN ph IS NULL AND change_type = 'I' AND created < change_time THEN created ELSE change_time END AS change_time, payload, storno, storno_date, created, hash_id, seq_id,
  CASE WHEN nh IS NULL AND change_type NOT IN ('O', 'D') THEN 1 WHEN change_type = 'O' AND pt = 'D' THEN 2 WHEN change_type = 'O' AND pt <> 'D' AND hash_id <> ph THEN 22 WHEN ph IS NULL AND change_type <> 'I' THEN 3 WHEN change_type = 'D' AND pt = 'D' THEN 4
   WHEN change_type = 'D' AND pt IN ('I', 'U') AND hash_id <> ph THEN 5 WHEN change_type = 'I' AND pt IN ('I', 'U') THEN 6 WHEN change_type = 'B' AND pt = 'D' THEN 7 WHEN change_type = 'B' AND pt IN ('I', 'U') AND hash_id <> ph THEN 8 ELSE 0 END AS add_op, pv AS prev_time, ph AS prev_hash FROM c3a)"""
_C4 = _C3 + """, c4 AS (SELECT * FROM c3 UNION ALL SELECT key, change_seq, CASE WHEN add_op IN (2, 3, 4, 7) THEN 'I' WHEN add_op IN (5, 8, 22) THEN 'U' ELSE 'D' END,
  CASE WHEN add_op = 1 THEN change_time + INTERVAL 1 MINUTE WHEN add_op = 3 AND change_time - INTERVAL 1 MINUTE > created THEN created WHEN add_op NOT IN (1) AND change_time - INTERVAL 1 MINUTE > coalesce(prev_time, TIMESTAMP '1900-01-01 12:00:00') THEN change_time - INTERVAL 1 MINUTE ELSE prev_time + INTERVAL 1 SECOND END,
  payload, storno, storno_date, created, CASE WHEN add_op = 6 THEN prev_hash ELSE hash_id END, seq_id + CASE WHEN add_op = 1 THEN 1 ELSE -1 END, add_op, prev_time, prev_hash FROM c3 WHERE add_op > 0)"""
_C5 = _C4 + ", c5 AS (SELECT * FROM c4 QUALIFY row_number() OVER (PARTITION BY key, CAST(change_time AS DATE) ORDER BY seq_id DESC) = 1)"
_C6 = _C5 + """, c6a AS (SELECT *, lag(change_type) OVER w AS pt, lag(hash_id) OVER w AS ph, lag(change_time) OVER w AS pa, lead(change_type) OVER w AS nt, coalesce(lead(change_time) OVER w, TIMESTAMP '2099-12-31 23:59:59') AS na, lag(storno) OVER w AS ps FROM c5 WINDOW w AS (PARTITION BY key ORDER BY seq_id)),
c6 AS (SELECT * EXCLUDE (pt, ph, pa, nt, na, ps), CASE WHEN coalesce((change_type IN ('I', 'U') AND epoch(na) - epoch(change_time) < 3600) OR (change_type IN ('I', 'U', 'O') AND pt IN ('I', 'U') AND hash_id = ph) OR (change_type IN ('I', 'U', 'O') AND pt = 'D' AND epoch(change_time) - epoch(coalesce(pa, TIMESTAMP '1900-01-01')) < 3600 AND hash_id = ph)
  OR (change_type = 'D' AND nt IN ('I', 'U', 'O') AND epoch(na) - epoch(change_time) < 3600) OR (change_type = 'D' AND pt = 'I' AND epoch(change_time) - epoch(coalesce(pa, TIMESTAMP '1900-01-01')) < 3600) OR (change_type = 'D' AND pt = 'D'), false) THEN 0 ELSE 1 END AS changed,
  CASE WHEN storno = 1 AND coalesce(ps, 1) = 0 THEN 1 ELSE 0 END AS storno_switch FROM c6a)"""
_C7 = _C6 + ", c7 AS (SELECT * FROM c6 WHERE changed = 1 AND (storno = 0 OR storno_switch = 1))"
_END = "TIMESTAMP '2099-12-31 23:59:59'"
_C8 = _C7 + f""", c8a AS (SELECT *, lead(change_type) OVER w AS nt, lead(change_time) OVER w AS na, lead(storno_date) OVER w AS nd, coalesce(lead(storno_switch) OVER w, 0) = 1 AS sw FROM c7 WINDOW w AS (PARTITION BY key ORDER BY seq_id)),
c8 AS (SELECT * EXCLUDE (nt, na, nd, sw), change_time AS valid_from, CASE WHEN sw AND coalesce(nd, {_END}) <= coalesce(na, {_END}) THEN coalesce(nd - INTERVAL 1 SECOND, {_END}) ELSE coalesce(na - INTERVAL 1 SECOND, {_END}) END AS valid_to,
  CASE WHEN nt = 'D' THEN 1 ELSE 0 END AS deleted, CASE WHEN nt = 'D' THEN na ELSE {_END} END AS deleted_at, CASE WHEN sw THEN 1 ELSE storno END AS is_storno, CASE WHEN sw THEN nd ELSE storno_date END AS storno_at, CASE WHEN CAST(change_time AS DATE) = CAST(na AS DATE) THEN 0 ELSE 1 END AS last_on_date FROM c8a)"""
_C9 = _C8 + f""", c9a AS (SELECT * REPLACE (CAST(CAST(valid_from AS DATE) AS TIMESTAMP) AS valid_from) FROM c8 WHERE change_type IN ('I', 'U', 'O') AND storno_switch = 0 AND last_on_date = 1),
c9 AS (SELECT key, payload, hash_id, seq_id, valid_from, coalesce(lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from) - INTERVAL 1 SECOND, {_END}) AS valid_to, CAST(rank() OVER (PARTITION BY key ORDER BY valid_from DESC) AS INTEGER) AS version FROM c9a)"""


def _h0(spark, d):
    c, e = _changes(spark, d)
    return hi.collect_changes(c, [e], at=AT)


def _h1(spark, d):
    return _h0(spark, d).withColumn("hash_id", hi.row_hash("payload", "storno"))


def _h2(spark, d):
    return hi.sequence(_h1(spark, d), ["key"])


def _h3(spark, d):
    return hi.gap_classify(_h2(spark, d), ["key"])


def _h4(spark, d):
    return hi.gap_fill(_h3(spark, d))


def _h5(spark, d):
    return hi.last_per_day(_h4(spark, d), ["key"])


def _h6(spark, d):
    return hi.debounce(_h5(spark, d), ["key"], seconds=3600)


def _h7(spark, d):
    return hi.storno_filter(_h6(spark, d))


def _h8(spark, d):
    return hi.valid_intervals(_h7(spark, d), ["key"])


def _h9(spark, d):
    return hi.final_versions(_h8(spark, d), ["key"], grain="day").select("key", "payload", "hash_id", "seq_id", "valid_from", "valid_to", "version")


@query(_C0 + " SELECT key, change_seq, change_type, change_time, payload, storno FROM c0")
def hist_collect_changes(spark, d):
    return _h0(spark, d).select("key", "change_seq", "change_type", "change_time", "payload", "storno")


@query(_C1 + " SELECT key, change_seq, hash_id FROM c1")
def hist_row_hash(spark, d):
    return _h1(spark, d).select("key", "change_seq", "hash_id")


@query(_C0 + " SELECT key, change_seq FROM c0 WHERE key IS NOT NULL AND year(created) BETWEEN 1990 AND 2099")
def hist_filter_plausible(spark, d):
    return hi.plausible(_h0(spark, d), key="key").select("key", "change_seq")


@query(_C2 + " SELECT key, change_seq, seq_id FROM c2")
def hist_sequence(spark, d):
    return _h2(spark, d).select("key", "change_seq", "seq_id")


@query(_C3 + " SELECT key, seq_id, change_time, add_op FROM c3")
def hist_gap_classify(spark, d):
    return _h3(spark, d).select("key", "seq_id", "change_time", "add_op")


@query(_C4 + " SELECT key, seq_id, change_type, change_time, hash_id FROM c4")
def hist_gap_fill(spark, d):
    return _h4(spark, d).select("key", "seq_id", "change_type", "change_time", "hash_id")


@query(_C5 + " SELECT key, seq_id, change_type, change_time FROM c5")
def hist_last_per_day(spark, d):
    return _h5(spark, d).select("key", "seq_id", "change_type", "change_time")


@query(_C6 + " SELECT key, seq_id, changed FROM c6")
def hist_debounce(spark, d):
    return _h6(spark, d).select("key", "seq_id", "changed")


@query(_C7 + " SELECT key, seq_id, storno, storno_switch FROM c7")
def hist_storno_switch(spark, d):
    return _h7(spark, d).select("key", "seq_id", "storno", "storno_switch")


@query(_C8 + " SELECT key, seq_id, valid_from, valid_to, deleted, deleted_at, is_storno, storno_at, last_on_date FROM c8")
def hist_valid_intervals(spark, d):
    return _h8(spark, d).select("key", "seq_id", "valid_from", "valid_to", "deleted", "deleted_at", "is_storno", "storno_at", "last_on_date")


@query(_C8 + " SELECT key, md5(CAST(key AS VARCHAR)) AS key_id, min(valid_from) AS created_at, max(valid_from) AS updated_at FROM c8 GROUP BY key")
def hist_surrogate_key(spark, d):
    return hi.surrogate_keys(_h8(spark, d), ["key"])


@query(_C9 + " SELECT * FROM c9")
def hist_final(spark, d):
    return _h9(spark, d)


_ISL = _C9 + ", i1 AS (SELECT *, CASE WHEN lag(payload) OVER w = payload AND lag(valid_to) OVER w + INTERVAL 1 SECOND = valid_from THEN 0 ELSE 1 END AS nw FROM c9 WINDOW w AS (PARTITION BY key ORDER BY valid_from)), i2 AS (SELECT *, sum(nw) OVER (PARTITION BY key ORDER BY valid_from ROWS UNBOUNDED PRECEDING) AS i FROM i1), isl AS (SELECT key, payload, min(valid_from) AS valid_from, max(valid_to) AS valid_to, count(*) AS n FROM i2 GROUP BY key, payload, i)"


@query(_ISL + " SELECT * FROM isl")
def hist_hash_islands(spark, d):
    return hi.islands(_h9(spark, d), ["key"], value="payload")


@query(_C9 + ", n AS (SELECT key, payload + 100 AS payload, valid_from, valid_to FROM c9 WHERE payload = 1 AND version = 1) SELECT key, payload, valid_from, valid_to FROM c9 WHERE key NOT IN (SELECT key FROM n) UNION ALL SELECT * FROM n")
def hist_delta_merge(spark, d):
    v = _h9(spark, d).select("key", "payload", "valid_from", "valid_to", "version")
    new = v.where("payload = 1 and version = 1").withColumn("payload", F.col("payload") + 100).drop("version")
    return hi.delta_merge(v.drop("version"), new, ["key"])


@query(_C9 + " SELECT key, seq_id, valid_from FROM c9 WHERE CAST(valid_from AS DATE) >= DATE '2024-01-28' - 7")
def hist_delta_view(spark, d):
    return hi.delta_view(_h9(spark, d), today="2024-01-28", days=7).select("key", "seq_id", "valid_from")


@query(_C9 + " SELECT key, payload, version FROM c9 WHERE TIMESTAMP '2024-01-15 12:00:00' BETWEEN valid_from AND valid_to")
def hist_as_of(spark, d):
    return hi.as_of(_h9(spark, d), "2024-01-15 12:00:00").select("key", "payload", "version")


# temporal joins ----------------------------------------------------------------------------------------


def _versions(spark, d, name: str, column, later: int):
    """Versions per customer from all orders, one per day; each attribute becomes known some days after the order."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.date_add(F.to_date("o_orderdate"), later).alias("valid_from"), F.col("o_orderkey"), column.alias(name))
    one = o.groupBy("key", "valid_from").agg(F.max_by(name, "o_orderkey").alias(name), F.max("o_orderkey").alias(f"{name}_row"))
    return tj.rank_versions(one, "key").drop("version")


def _v_sql(alias: str, name: str, expr: str, later: int) -> str:
    return f"""{alias}0 AS (SELECT o_custkey AS key, CAST(o_orderdate AS DATE) + {later} AS valid_from, max_by({expr}, o_orderkey) AS {name}, max(o_orderkey) AS {name}_row FROM orders GROUP BY 1, 2),
{alias} AS (SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from) - 1, DATE '2099-12-31') AS valid_to FROM {alias}0)"""


def _fd(spark, d):
    return _versions(spark, d, "status", F.col("o_orderstatus"), 0), _versions(spark, d, "priority", F.col("o_orderpriority"), 9), _versions(spark, d, "band", F.floor(F.col("o_totalprice") / 100000).cast("long"), 30)


_V = "WITH " + _v_sql("f", "status", "o_orderstatus", 0) + ", " + _v_sql("d1", "priority", "o_orderpriority", 9) + ", " + _v_sql("d2", "band", "CAST(floor(o_totalprice / 100000) AS BIGINT)", 30)


def _join_sql(out: str, cur: str, dim: str, have: str, attr: str) -> str:
    return f""", {out}b AS (SELECT DISTINCT key, start FROM (SELECT key, valid_from AS start FROM {cur} UNION ALL SELECT key, valid_to + 1 FROM {cur} UNION ALL SELECT key, valid_from FROM {dim} UNION ALL SELECT key, valid_to + 1 FROM {dim}) WHERE year(start) BETWEEN 1990 AND 2098),
{out}s AS (SELECT key, start, coalesce(lead(start) OVER (PARTITION BY key ORDER BY start) - 1, DATE '2099-12-31') AS ende FROM {out}b),
{out} AS (SELECT s.key, s.start AS valid_from, s.ende AS valid_to, {', '.join('c.' + x for x in have.split())}, x.{attr} FROM {out}s s JOIN {cur} c ON s.key = c.key AND s.start BETWEEN c.valid_from AND c.valid_to LEFT JOIN {dim} x ON s.key = x.key AND s.start BETWEEN x.valid_from AND x.valid_to)"""


_J1, _J2 = _join_sql("j1", "f", "d1", "status", "priority"), _join_sql("j2", "j1", "d2", "status priority", "band")


@query(_V + " SELECT f.key, status, priority, greatest(f.valid_from, d1.valid_from) AS overlap_from, least(f.valid_to, d1.valid_to) AS overlap_to FROM f LEFT JOIN d1 ON f.key = d1.key AND f.valid_from <= d1.valid_to AND d1.valid_from <= f.valid_to")
def tj_overlap_join(spark, d):
    f, d1, _ = _fd(spark, d)
    return tj.overlap_join(f, d1, "key").select("key", "status", "priority", "overlap_from", "overlap_to")


@query(_V + " SELECT f.key, md5(coalesce(CAST(status_row AS VARCHAR), '~') || '|' || coalesce(CAST(priority_row AS VARCHAR), '~')) AS pair_id FROM f LEFT JOIN d1 ON f.key = d1.key AND f.valid_from <= d1.valid_to AND d1.valid_from <= f.valid_to")
def tj_rekey(spark, d):
    f, d1, _ = _fd(spark, d)
    return tj.rekey(tj.overlap_join(f, d1, "key"), "status_row", "priority_row").select("key", "pair_id")


@query(_V + _J1 + " SELECT key, start FROM j1b")
def tj_boundaries(spark, d):
    f, d1, _ = _fd(spark, d)
    return tj.boundaries([f, d1], "key")


@query(_V + _J1 + " SELECT key, valid_from, valid_to, status, priority FROM j1")
def tj_elementary_slices(spark, d):
    f, d1, _ = _fd(spark, d)
    return tj.temporal_join(f, ["status"], [tj.Dim(d1, ["priority"])], "key")


@query(_V + _J1 + _J2 + " SELECT key, valid_from, valid_to, status, priority, band FROM j2")
def tj_multiway(spark, d):
    f, d1, d2 = _fd(spark, d)
    return tj.temporal_sweep(f, ["status"], [tj.Dim(d1, ["priority"]), tj.Dim(d2, ["band"])], "key")


def _seconds(spark, d):
    """Versions by the second from all events of a user: its type, its value's band a little later, and logins for ten minutes each, which leave gaps."""
    e = table(spark, d, "events").select(F.col("user_id").alias("key"), F.date_trunc("second", "ts").cast("timestamp").alias("at"), "event_id", "event_type", F.floor(F.col("value") / 50).cast("long").alias("band"))

    def versions(name, later, most=None):
        one = e.groupBy("key", F.timestamp_add("SECOND", F.lit(later), F.col("at")).alias("valid_from")).agg(F.max_by(name, "event_id").alias(name))
        end = F.coalesce(F.timestamp_add("SECOND", F.lit(-1), F.lead("valid_from").over(Window.partitionBy("key").orderBy("valid_from"))), F.lit(hi.END).cast("timestamp"))
        return one.withColumn("valid_to", end if most is None else F.least(end, F.timestamp_add("SECOND", F.lit(most), F.col("valid_from"))))

    return versions("event_type", 0), versions("band", 90), versions("event_id", 0, 600)


_SEC = "WITH e AS (SELECT user_id AS key, CAST(date_trunc('second', ts) AS TIMESTAMP) AS tick, event_id, event_type, CAST(floor(value / 50) AS BIGINT) AS band FROM events)" + "".join(
    f", {t}0 AS (SELECT key, tick + INTERVAL {later} SECOND AS valid_from, max_by({name}, event_id) AS {name} FROM e GROUP BY 1, 2), {t} AS (SELECT *, least(coalesce(lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from) - INTERVAL 1 SECOND, TIMESTAMP '2099-12-31 23:59:59'), {most}) AS valid_to FROM {t}0)"
    for t, name, later, most in (("f", "event_type", 0, "TIMESTAMP '2099-12-31 23:59:59'"), ("d1", "band", 90, "TIMESTAMP '2099-12-31 23:59:59'"), ("d2", "event_id", 0, "valid_from + INTERVAL 600 SECOND"))
)
_SEC += """, b AS (SELECT DISTINCT key, tick FROM (SELECT key, unnest([valid_from, valid_to + INTERVAL 1 SECOND]) AS tick FROM f UNION ALL SELECT key, unnest([valid_from, valid_to + INTERVAL 1 SECOND]) FROM d1 UNION ALL SELECT key, unnest([valid_from, valid_to + INTERVAL 1 SECOND]) FROM d2) WHERE year(tick) BETWEEN 1990 AND 2098),
s AS (SELECT key, tick, coalesce(lead(tick) OVER (PARTITION BY key ORDER BY tick) - INTERVAL 1 SECOND, TIMESTAMP '2099-12-31 23:59:59') AS ende FROM b)
SELECT s.key, s.tick AS valid_from, s.ende AS valid_to, f.event_type, d1.band, d2.event_id FROM s JOIN f ON s.key = f.key AND s.tick BETWEEN f.valid_from AND f.valid_to LEFT JOIN d1 ON s.key = d1.key AND s.tick BETWEEN d1.valid_from AND d1.valid_to LEFT JOIN d2 ON s.key = d2.key AND s.tick BETWEEN d2.valid_from AND d2.valid_to"""


@query(_SEC)
def tj_multiway_seconds(spark, d):
    f, d1, d2 = _seconds(spark, d)
    return tj.temporal_sweep(f, ["event_type"], [tj.Dim(d1, ["band"]), tj.Dim(d2, ["event_id"])], "key", grain="second")


_CO = _V + _J1 + _J2 + ", k1 AS (SELECT *, CASE WHEN lag((status, priority, band)) OVER w IS NOT DISTINCT FROM (status, priority, band) AND lag(valid_to) OVER w + 1 = valid_from THEN 0 ELSE 1 END AS nw FROM j2 WINDOW w AS (PARTITION BY key ORDER BY valid_from)), k2 AS (SELECT *, sum(nw) OVER (PARTITION BY key ORDER BY valid_from ROWS UNBOUNDED PRECEDING) AS i FROM k1), co AS (SELECT key, min(valid_from) AS valid_from, max(valid_to) AS valid_to, status, priority, band FROM k2 GROUP BY key, status, priority, band, i)"


def _co(spark, d):
    f, d1, d2 = _fd(spark, d)
    return tj.coalesce_versions(tj.temporal_sweep(f, ["status"], [tj.Dim(d1, ["priority"]), tj.Dim(d2, ["band"])], "key"), "key", ["status", "priority", "band"])


@query(_CO + " SELECT * FROM co")
def tj_coalesce(spark, d):
    return _co(spark, d)


@query(_CO + " SELECT key, status, priority, band, valid_from, CAST(dense_rank() OVER (PARTITION BY key ORDER BY valid_from DESC) AS INTEGER) AS version, coalesce(lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from) - 1, DATE '2099-12-31') AS valid_to FROM co")
def tj_rank_versions(spark, d):
    return tj.rank_versions(_co(spark, d), "key")


@query("WITH e AS (SELECT user_id AS key, event_type, CAST(date_trunc('second', ts) AS TIMESTAMP) AS valid_from, event_id FROM events), v AS (SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from, event_id) - INTERVAL 1 SECOND, TIMESTAMP '2099-12-31 23:59:59') AS valid_to FROM e), g AS (SELECT key, event_type, event_id, CAST(valid_from AS DATE) AS valid_from, CASE WHEN strftime(valid_to, '%H:%M:%S') = '23:59:59' THEN CAST(valid_to AS DATE) ELSE CAST(valid_to AS DATE) - 1 END AS valid_to FROM v) SELECT * FROM g WHERE valid_from <= valid_to")
def tj_granularity(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("key"), "event_type", F.date_trunc("second", "ts").cast("timestamp").alias("valid_from"), "event_id")
    nxt = F.lead("valid_from").over(Window.partitionBy("key").orderBy("valid_from", "event_id"))
    return tj.to_day_grain(e.withColumn("valid_to", F.coalesce(F.timestamp_add("SECOND", F.lit(-1), nxt), F.lit(hi.END).cast("timestamp"))))
