"""Validity history (SCD type 2) from change events.

Events have the key columns and change_seq, change_type (I, U, D, B before
image, O snapshot), change_time, hash_id, storno (0 or 1), storno_date,
created.  All steps are windows over the key, so one exchange serves a chain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "2099-12-31 23:59:59"


def _end() -> Column:
    return F.lit(END).cast("timestamp")


def _seconds(a: Column, b: Column) -> Column:
    return F.unix_timestamp(b) - F.unix_timestamp(a)


def collect_changes(snapshot: DataFrame, changes: list[DataFrame], *, at, zone: str = "Europe/Berlin") -> DataFrame:
    """Snapshot as type O with the last sequence, and all changes in local time, up to the snapshot's time."""
    top = snapshot.withColumns({"change_seq": F.lit("9" * 35), "change_type": F.lit("O"), "change_time": F.lit(at).cast("timestamp")})
    rest = [c.withColumn("change_time", F.from_utc_timestamp("change_time", zone)).where(F.col("change_time") <= F.lit(at).cast("timestamp")) for c in changes]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [top, *rest])


def row_hash(*columns: str) -> Column:
    """SHA-1 over the columns' texts; null and empty differ."""
    return F.sha1(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in columns]))


def plausible(df: DataFrame, *, key: str) -> DataFrame:
    """Non-empty key, created between 1990 and 2099."""
    return df.where((F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "") & F.year("created").between(1990, 2099))


def sequence(df: DataFrame, key: list[str], *, step: int = 2) -> DataFrame:
    """seq_id: position within the key by (sequence, type), in steps that leave room for inserted events."""
    return df.withColumn("seq_id", (F.row_number().over(Window.partitionBy(*key).orderBy("change_seq", "change_type")) * step).cast("long"))


def gap_classify(df: DataFrame, key: list[str]) -> DataFrame:
    """add_op: which event is missing beside each event, by its neighbours; a first insert takes the creation time if that is earlier."""
    w = Window.partitionBy(*key).orderBy("seq_id")
    pt, ph, nh, t, h = F.lag("change_type").over(w), F.lag("hash_id").over(w), F.lead("hash_id").over(w), F.col("change_type"), F.col("hash_id")
    add = (
        F.when(nh.isNull() & ~t.isin("O", "D"), 1)
        .when((t == "O") & (pt == "D"), 2)
        .when((t == "O") & (pt != "D") & (h != ph), 22)
        .when(ph.isNull() & (t != "I"), 3)
        .when((t == "D") & (pt == "D"), 4)
        .when((t == "D") & pt.isin("I", "U") & (h != ph), 5)
        .when((t == "I") & pt.isin("I", "U"), 6)
        .when((t == "B") & (pt == "D"), 7)
        .when((t == "B") & pt.isin("I", "U") & (h != ph), 8)
        .otherwise(0)
    )
    time = F.when(ph.isNull() & (t == "I") & (F.col("created") < F.col("change_time")), F.col("created")).otherwise(F.col("change_time"))
    return df.select("*", add.alias("add_op"), F.lag("change_time").over(w).alias("prev_time"), ph.alias("prev_hash"), time.alias("_time")).withColumn("change_time", F.col("_time")).drop("_time")


def gap_fill(df: DataFrame, *, delete_after: int = 1, insert_before: int = 1, update_before: int = 1, delete_before: int = 1) -> DataFrame:
    """The classified events and the missing ones beside them, minutes off, never before the predecessor."""
    op, at, prev = F.col("add_op"), F.col("change_time"), F.coalesce("prev_time", F.lit("1900-01-01 12:00:00").cast("timestamp"))
    minus = lambda n: F.timestamp_add("MINUTE", F.lit(-n), at)
    time = (
        F.when(op == 1, F.timestamp_add("MINUTE", F.lit(delete_after), at))
        .when((op == 3) & (minus(insert_before) > F.col("created")), F.col("created"))
        .when(op.isin(2, 3, 4, 7) & (minus(insert_before) > prev), minus(insert_before))
        .when(op.isin(5, 8, 22) & (minus(update_before) > prev), minus(update_before))
        .when((op == 6) & (minus(delete_before) > prev), minus(delete_before))
        .otherwise(F.timestamp_add("SECOND", F.lit(1), F.col("prev_time")))
    )
    kind = F.when(op.isin(2, 3, 4, 7), "I").when(op.isin(5, 8, 22), "U").otherwise("D")
    new = df.where("add_op > 0").withColumns({"seq_id": F.col("seq_id") + F.when(op == 1, 1).otherwise(-1), "change_type": kind, "change_time": time, "hash_id": F.when(op == 6, F.col("prev_hash")).otherwise(F.col("hash_id"))})
    return df.unionByName(new)


def last_per_day(df: DataFrame, key: list[str], *, last_on_date: bool = True) -> DataFrame:
    """The last event per key and day; or all but before images."""
    if not last_on_date:
        return df.where("change_type <> 'B'")
    w = Window.partitionBy(*key, F.to_date("change_time")).orderBy(F.desc("seq_id"))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def debounce(df: DataFrame, key: list[str], *, seconds: int = 0) -> DataFrame:
    """changed: 0 for events that change nothing or are undone within ``seconds``; storno_switch: the flag turns from 0 to 1."""
    w = Window.partitionBy(*key).orderBy("seq_id")
    t, h, at = F.col("change_type"), F.col("hash_id"), F.col("change_time")
    pt, ph, pa = (F.lag(c).over(w) for c in ("change_type", "hash_id", "change_time"))
    nt, na = F.lead("change_type").over(w), F.coalesce(F.lead("change_time").over(w), _end())
    soon, after = _seconds(at, na) < seconds, _seconds(F.coalesce(pa, F.lit("1900-01-01").cast("timestamp")), at) < seconds
    idle = (
        (t.isin("I", "U") & soon)
        | (t.isin("I", "U", "O") & pt.isin("I", "U") & (h == ph))
        | (t.isin("I", "U", "O") & (pt == "D") & after & (h == ph))
        | ((t == "D") & nt.isin("I", "U", "O") & soon)
        | ((t == "D") & (pt == "I") & after)
        | ((t == "D") & (pt == "D"))
    )
    switch = (F.col("storno") == 1) & (F.coalesce(F.lag("storno").over(w), F.lit(1)) == 0)
    return df.select("*", F.when(F.coalesce(idle, F.lit(False)), 0).otherwise(1).alias("changed"), F.coalesce(switch, F.lit(False)).cast("int").alias("storno_switch"))


def storno_filter(df: DataFrame) -> DataFrame:
    """Events that change something and are not cancelled, or turn cancelled."""
    return df.where("changed = 1 and (storno = 0 or storno_switch = 1)")


def valid_intervals(df: DataFrame, key: list[str], *, to_storno: bool = True) -> DataFrame:
    """valid_from and inclusive valid_to, delete and cancellation marks from the next event, whether it is the day's last."""
    w = Window.partitionBy(*key).orderBy("seq_id")
    nt, na, nd = F.lead("change_type").over(w), F.lead("change_time").over(w), F.lead("storno_date").over(w)
    switch = (F.coalesce(F.lead("storno_switch").over(w), F.lit(0)) == 1) & F.lit(to_storno)
    back = F.timestamp_add("SECOND", F.lit(-1), na)
    to = F.when(switch & (F.coalesce(nd, _end()) <= F.coalesce(na, _end())), F.coalesce(F.timestamp_add("SECOND", F.lit(-1), nd), _end())).otherwise(F.coalesce(back, _end()))
    gone = F.coalesce(nt == "D", F.lit(False))
    return df.select(
        "*", F.col("change_time").alias("valid_from"), to.alias("valid_to"), gone.cast("int").alias("deleted"), F.when(gone, na).otherwise(_end()).alias("deleted_at"),
        F.when(switch, 1).otherwise(F.col("storno")).alias("is_storno"), F.when(switch, nd).otherwise(F.col("storno_date")).alias("storno_at"), F.when(F.to_date("change_time") == F.to_date(na), 0).otherwise(1).alias("last_on_date"),
    )


def surrogate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key id (128 bits of the key's hash as text, so it needs no global order), created and updated per business key."""
    name = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    return df.groupBy(*key).agg(F.min("valid_from").alias("created_at"), F.max("valid_from").alias("updated_at")).withColumn("key_id", F.md5(name))


def final_versions(df: DataFrame, key: list[str], *, grain: str = "second") -> DataFrame:
    """Versions (types I, U, O) that are no storno events, ranked newest first; by day they end at 23:59:59 of a day."""
    out = df.where("change_type in ('I', 'U', 'O') and storno_switch = 0")
    if grain == "day":
        nxt = F.lead("valid_from").over(Window.partitionBy(*key).orderBy("valid_from"))
        out = out.where("last_on_date = 1").withColumn("valid_from", F.to_date("valid_from").cast("timestamp"))
        out = out.withColumn("valid_to", F.coalesce(F.timestamp_add("SECOND", F.lit(-1), nxt), _end()))
    return out.withColumn("version", F.rank().over(Window.partitionBy(*key).orderBy(F.desc("valid_from"))).cast("int"))


def islands(df: DataFrame, key: list[str], *, value: str, start: str = "valid_from", end: str = "valid_to", unit: str = "SECOND") -> DataFrame:
    """Adjacent versions of equal value as one: key, value, start, end, n."""
    w = Window.partitionBy(*key).orderBy(start)
    joined = F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.timestamp_add(unit, F.lit(1), F.lag(end).over(w).cast("timestamp")) == F.col(start).cast("timestamp"))
    marked = df.withColumn("_new", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1))
    marked = marked.withColumn("_i", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*key, value, "_i").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_i")


def delta_merge(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """All versions of changed keys replaced."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def delta_view(df: DataFrame, *, today, days: int, start: str = "valid_from") -> DataFrame:
    return df.where(F.to_date(start) >= F.date_sub(F.lit(today).cast("date"), days))


def as_of(df: DataFrame, at, *, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """The state at a time."""
    return df.where(F.lit(at).cast("timestamp").between(F.col(start), F.col(end)))
