"""Change feeds: reading, normalising, watermarks, retention, extraction state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPS = {"INSERT": "I", "UPDATE": "U", "DELETE": "D", "I": "I", "U": "U", "D": "D"}


def change_rows(changes: DataFrame, since: str, *, seq: str = "_seq") -> DataFrame:
    """Rows behind the watermark; the sequence column, not the order of rows, says which comes first."""
    return changes.where(F.col(seq) > F.lit(since))


def normalize_op(op: Column) -> Column:
    """I, U or D; unknown operations count as U."""
    up = F.upper(F.coalesce(op.cast("string"), F.lit("U")))
    out = F.lit("U")
    for k, v in OPS.items():
        out = F.when(up == k, v).otherwise(out)
    return out


def normalize_changes(raw: DataFrame, *, op: str = "header__change_oper", seq: str = "header__change_seq", columns: list[str] | None = None) -> DataFrame:
    """Bronze form of a change table: payload columns, _op and _seq; header columns go."""
    keep = columns or [c for c in raw.columns if not c.startswith("header__")]
    return raw.select(*keep, normalize_op(F.col(op)).alias("_op"), F.coalesce(F.col(seq).cast("string"), F.lit("")).alias("_seq"))


def watermark_changes(df: DataFrame, column: str, last, *, overlap_days: int = 1) -> DataFrame:
    """Rows from one day before the last watermark on, as updates in order of the column; the key removes repeats later."""
    if last is not None:
        df = df.where(F.col(column).cast("date") >= F.date_sub(F.lit(last).cast("date"), overlap_days))
    return df.withColumns({"_op": F.lit("U"), "_seq": F.coalesce(F.col(column).cast("string"), F.lit(""))})


def retention_gaps(changes: DataFrame, state: DataFrame, *, table: str = "table_name", seq: str = "_seq") -> DataFrame:
    """Per table its watermark, the oldest sequence still there, and whether changes between are lost."""
    oldest = changes.groupBy(table).agg(F.min(seq).alias("oldest"))
    return state.join(oldest, table, "left").select(table, "watermark", "oldest", F.coalesce(F.col("oldest") > F.col("watermark"), F.lit(False)).alias("gap"))


def latest_state(log: DataFrame, key: list[str], *, ts: str, values: list[str], rows: str) -> DataFrame:
    """Last non-null value of each column by time (of equal times the larger value), rows summed, time of the last run."""
    last = [F.max_by(v, F.when(F.col(v).isNotNull(), F.struct(ts, v))).alias(v) for v in values]
    return log.groupBy(*key).agg(*last, F.sum(rows).alias("rows_total"), F.max(ts).alias("last_run"))
