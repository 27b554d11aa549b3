"""Temporal joins of tables with validity, inclusive ends, by days or seconds.

``temporal_sweep`` joins any number of tables in one pass: the starts and ends of
all versions become one tagged union, a single exchange deals it by key, and
along a key's time each table's latest start or end is carried on.  It needs
versions of one table not to overlap, as validity history gives them.
``temporal_join`` folds over the dimensions (boundaries, elementary slices,
attributes attached by equi-join and range) and takes overlapping versions too.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .history import islands

OPEN = "2099-12-31"


@dataclass
class Dim:
    """A dimension: key, valid_from, valid_to and its attributes; ``how`` left or inner; ``extra`` a further condition on fact and dim columns."""

    df: DataFrame
    attrs: list[str]
    how: str = "left"
    extra: object = None


def overlap_join(fact: DataFrame, dim: DataFrame, key: str, *, how: str = "left") -> DataFrame:
    """Fact rows with the dimension rows of equal key and overlapping validity, and the overlap."""
    if how not in ("left", "inner"):
        raise ValueError("how is left or inner")
    d = dim.withColumnsRenamed({"valid_from": "_df", "valid_to": "_dt"})
    hit = (fact[key] == d[key]) & (fact["valid_from"] <= d["_dt"]) & (d["_df"] <= fact["valid_to"])
    out = fact.join(d, hit, how).drop(d[key])
    return out.withColumns({"overlap_from": F.greatest("valid_from", "_df"), "overlap_to": F.least("valid_to", "_dt")}).drop("_df", "_dt")


def rekey(df: DataFrame, *ids: str) -> DataFrame:
    """pair_id: an id of the combination of row ids, from the ids themselves."""
    return df.withColumn("pair_id", F.md5(F.concat_ws("|", *[F.coalesce(F.col(i).cast("string"), F.lit("~")) for i in ids])))


def boundaries(frames: list[DataFrame], key: str) -> DataFrame:
    """(key, start): every start and every day after an end, years 1990 to 2098."""
    parts = [p for df in frames for p in (df.select(key, F.col("valid_from").alias("start")), df.select(key, F.date_add("valid_to", 1).alias("start")))]
    return reduce(DataFrame.unionByName, parts).where(F.year("start").between(1990, 2098)).distinct()


def slices(frames: list[DataFrame], key: str) -> DataFrame:
    """(key, start, end): elementary slices between the boundaries; the last is open."""
    nxt = F.lead("start").over(Window.partitionBy(key).orderBy("start"))
    return boundaries(frames, key).withColumn("end", F.coalesce(F.date_sub(nxt, 1), F.lit(OPEN).cast("date")))


def attach(cut: DataFrame, df: DataFrame, key: str, attrs: list[str], how: str) -> DataFrame:
    d = df.select(F.col(key).alias("_k"), F.col("valid_from").alias("_f"), F.col("valid_to").alias("_t"), *attrs)
    return cut.join(d, (F.col(key) == F.col("_k")) & F.col("start").between(F.col("_f"), F.col("_t")), how).drop("_k", "_f", "_t")


def temporal_join(fact: DataFrame, attrs: list[str], dims: list[Dim], key: str) -> DataFrame:
    """(key, valid_from, valid_to, attributes): the fact's time cut wherever any attribute changes.

    The fold's order matters to no attribute of the result after ``coalesce_versions``.
    """
    now, have = fact.select(key, "valid_from", "valid_to", *attrs), list(attrs)
    for dim in dims:
        cut = attach(slices([now, dim.df], key), now, key, have, "inner")
        cut = attach(cut, dim.df, key, dim.attrs, dim.how)
        if dim.extra is not None:
            cut = cut.where(dim.extra) if dim.how == "inner" else cut.withColumns({a: F.when(dim.extra, F.col(a)) for a in dim.attrs})
        have = [*have, *dim.attrs]
        now = cut.select(key, F.col("start").alias("valid_from"), F.col("end").alias("valid_to"), *have)
    return now


#: Last end of each grain, and the step from an end to the next start.
GRAINS = {"day": ("2099-12-31", "date", "DAY"), "second": ("2099-12-31 23:59:59", "timestamp", "SECOND")}


def temporal_sweep(fact: DataFrame, attrs: list[str], dims: list[Dim], key: str, *, grain: str = "day") -> DataFrame:
    """(key, valid_from, valid_to, attributes) as ``temporal_join`` gives them, with one exchange whatever the number of dimensions.

    Versions of one table must not overlap within a key; of several that begin
    at the same time one counts, the largest by its attributes.  Rows of a null
    key, start or end are left out.  Slices begin in the years 1990 to 2098, the last
    one is open; attributes are null where a left dimension has no version.
    """
    last, kind, unit = GRAINS[grain]
    step = lambda c, n: F.timestamp_add(unit, F.lit(n), F.col(c)).cast(kind)
    sides = [(fact, attrs), *[(d.df, d.attrs) for d in dims]]
    parts = []
    for n, (df, names) in enumerate(sides):
        mark = lambda i, live: F.struct(F.lit(live).alias("live"), *[F.col(a) if live else F.lit(None).cast(df.schema[a].dataType).alias(a) for a in names]) if i == n else F.lit(None)  # noqa: B023, E731
        rows = df.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull() & F.col("valid_to").isNotNull())
        own = [F.array(*[F.struct(at.cast(kind).alias("at"), mark(n, live).alias("state")) for at, live in ((F.col("valid_from"), True), (step("valid_to", 1), False))])]
        rows = rows.select(key, F.explode(own[0]).alias("_e"))
        none = [F.lit(None).cast(f"struct<live:boolean{''.join(f',`{a}`:{o.schema[a].dataType.simpleString()}' for a in names2)}>").alias(f"_s{i}") for i, (o, names2) in enumerate(sides)]
        parts.append(rows.select(key, F.col("_e.at").alias("at"), *[F.col("_e.state").alias(f"_s{n}") if i == n else none[i] for i in range(len(sides))]))
    states = [f"_s{i}" for i in range(len(sides))]
    # dealt by key once: the grouping by (key, at) and the windows by key need no other exchange
    events = reduce(DataFrame.unionByName, parts).repartition(key).groupBy(key, "at").agg(*[F.max(s).alias(s) for s in states])
    along = Window.partitionBy(key).orderBy("at")
    carried = events.select(key, "at", F.lead("at").over(along).alias("_next"), *[F.last(s, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)).alias(s) for s in states])
    live = [F.coalesce(F.col(f"{s}.live"), F.lit(False)) for s in states]
    here = F.year("at").between(1990, 2098) & live[0]
    for dim, x in zip(dims, live[1:]):
        here = here & x if dim.how == "inner" and dim.extra is None else here
    end = F.when(F.year("_next") <= 2098, step("_next", -1)).otherwise(F.lit(last).cast(kind))
    out = carried.where(here).select(key, F.col("at").alias("valid_from"), end.alias("valid_to"), *[F.when(x, F.col(f"{s}.{a}")).alias(a) for s, x, (_, names) in zip(states, live, sides) for a in names], *[x.alias(f"_live{i}") for i, x in enumerate(live)])
    for i, dim in enumerate(dims, 1):
        if dim.extra is not None:
            out = out.where(F.col(f"_live{i}") & dim.extra) if dim.how == "inner" else out.withColumns({a: F.when(dim.extra, F.col(a)) for a in dim.attrs})
    return out.drop(*[f"_live{i}" for i in range(len(sides))])


def coalesce_versions(df: DataFrame, key: str, attrs: list[str], *, grain: str = "day") -> DataFrame:
    """Neighbouring versions with equal attributes as one."""
    h = df.withColumn("_h", F.struct(*attrs))
    out = islands(h, [key], value="_h", unit=GRAINS[grain][2])
    return out.select(key, "valid_from", "valid_to", *[F.col(f"_h.{a}") for a in attrs])


def rank_versions(df: DataFrame, key: str) -> DataFrame:
    """version 1 is the newest; ends recomputed from the next start."""
    w = Window.partitionBy(key).orderBy(F.desc("valid_from"))
    nxt = F.lag("valid_from").over(w)
    return df.withColumns({"version": F.dense_rank().over(w).cast("int"), "valid_to": F.coalesce(F.date_sub(nxt, 1), F.lit(OPEN).cast("date"))})


def to_day_grain(df: DataFrame, *, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Second-grain validity as days: the day of the start; a version that ends before midnight's last second ends the day before."""
    whole = F.date_format(end, "HH:mm:ss") == "23:59:59"
    out = df.withColumns({start: F.to_date(start), end: F.when(whole, F.to_date(end)).otherwise(F.date_sub(F.to_date(end), 1))})
    return out.where(F.col(start) <= F.col(end))
