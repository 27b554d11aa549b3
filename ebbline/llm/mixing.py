"""Mixing sources to target weights, by temperature.

The token share of each source is raised to an exponent, found by bisection so
that the normalised weights meet a target entropy or a repetition limit.  The
weights times the budget are realised as block permutations: per source and
epoch the rows are dealt into blocks by a keyed hash, the blocks are put in a
keyed order, and rows are taken in that order until the source's budget is
used.  Only DataFrame functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .carried import named
from .storage import cut, scratch

#: Rows of one block on average; a block is ordered by one task.
BLOCK_ROWS = 500
STEPS = 40


def n_tokens(text: str = "text") -> Column:
    """Number of runs of non-blank characters; 0 for null."""
    t = F.coalesce(F.col(text), F.lit(""))
    # a run starts where a non-blank follows a blank: cheaper than splitting
    return F.regexp_count(t, F.lit(r"\S+")).cast("long")


def weights_of(totals: DataFrame, exponent: float) -> DataFrame:
    """totals with share and weight = share^exponent, normalised; a source without tokens has weight 0."""
    whole = totals.agg(F.sum("tokens").alias("_all"))
    raw = totals.crossJoin(F.broadcast(whole)).withColumn("share", F.when(F.col("_all") > 0, F.col("tokens") / F.col("_all")).otherwise(0.0))
    raw = raw.withColumn("_p", F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent))).otherwise(0.0))
    z = raw.agg(F.sum("_p").alias("_z"))
    return raw.crossJoin(F.broadcast(z)).select("source", "tokens", "docs", "share", F.when(F.col("_z") > 0, F.col("_p") / F.col("_z")).otherwise(0.0).alias("weight"))


def _figures(totals: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float, float]]:
    """Entropy in bits, the largest repetition and the budget, for each exponent, in one pass over the totals.

    A budget of None is the least one that draws each source whole.

    With p = share^a and z its sum, the entropy is log2 z - a * sum(p log2 share) / z.
    """
    whole = totals.agg(F.sum("tokens").alias("_all"))
    x = totals.where("tokens > 0").crossJoin(F.broadcast(whole)).select("tokens", F.log2(F.col("tokens") / F.col("_all")).alias("_l"))
    sums = []
    for i, a in enumerate(exponents):
        p = F.pow(F.lit(2.0), F.col("_l") * a)
        sums += [F.sum(p).alias(f"z{i}"), F.sum(p * F.col("_l")).alias(f"e{i}"), F.max(p / F.col("tokens")).alias(f"r{i}"), F.min(p / F.col("tokens")).alias(f"c{i}")]
    r = x.agg(*sums).first()
    out = []
    for i, a in enumerate(exponents):
        z = r[f"z{i}"]
        own = (budget if budget is not None else z / r[f"c{i}"]) if z else 0.0
        out.append((math.log2(z) - a * r[f"e{i}"] / z, r[f"r{i}"] / z * own, own) if z else (0.0, 0.0, 0.0))
    return out


def find_exponent(totals: DataFrame, *, budget: float | None, entropy: float | None = None, repetition: float | None = None) -> float:
    """Exponent that meets the target, by bisection with 16 probes a pass.

    The entropy falls as the exponent grows and, under a fixed budget, the largest
    repetition falls as it grows to 1.  ``entropy`` (bits): the exponent at which
    it is reached, above 1 (64 at most) where the sources' own shares have more; the
    nearest end if none reaches it.  ``repetition``: the least
    exponent whose weights repeat no source more often; 1 if none does.
    """
    if (entropy is None) == (repetition is None):
        raise ValueError("give either entropy or repetition")
    lo, hi, parts = 0.0, 1.0, 16
    while entropy is not None and hi < 64 and _figures(totals, [hi], budget)[0][0] > entropy:
        hi *= 2
    for _ in range(math.ceil(STEPS / math.log2(parts))):
        probes = [lo + (hi - lo) * k / parts for k in range(parts + 1)]
        found = _figures(totals, probes, budget)
        good = [(e <= entropy) if entropy is not None else (r <= repetition) for e, r, _ in found]
        k = next((k for k, g in enumerate(good) if g), parts)
        if k == 0:
            return lo
        lo, hi = probes[k - 1], probes[k]
    return hi


def _unit(*parts: Column) -> Column:
    """A keyed number of 60 bits from the MD5 of the parts' texts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


#: A plan of more sources than this is joined by shuffle, not broadcast.
BROADCAST_SOURCES = 100_000


def _with_plan(rows: DataFrame, plan: DataFrame, sources: int) -> DataFrame:
    return rows.join(F.broadcast(plan) if sources <= BROADCAST_SOURCES else plan, "_source")


def _block(seed: int, epoch: Column) -> Column:
    return _unit(F.lit(str(seed)), epoch.cast("string"), F.lit("block"), F.col("_id")) % F.col("_blocks")


def _block_key(seed: int, epoch: Column, block: Column) -> Column:
    return _unit(F.lit(str(seed)), epoch.cast("string"), F.lit("order"), F.col("_source"), block.cast("string"))


def _row_key(seed: int, epoch: Column) -> Column:
    return _unit(F.lit(str(seed)), epoch.cast("string"), F.lit("row"), F.col("_id"))


def mix_sources(
    docs: DataFrame, *, budget: int | str | None = None, entropy: float | None = None, repetition: float | None = None, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", columns: bool = False
) -> DataFrame:
    """The sample: a row per drawn copy, doc_id, source, epoch, block, block_key, row_key, tokens.

    With ``columns`` the rows of ``docs`` come back instead, as often as drawn.
    ``budget`` is in tokens (all tokens of ``docs`` if None; with "cover" the
    least budget that draws every row once or more).  Each source gets
    floor(weight * budget) tokens: whole epochs of all its rows, then a last
    epoch of rows in the order (block_key, block, row_key) as long as the tokens
    before a row are fewer than what is left; a source exceeds its budget by
    less than one row's tokens (rows of equal id are drawn together).
    A source without tokens (null and empty texts only) is drawn once.  Null
    sources are the source '', null ids count as ''.  An empty table gives no
    rows; other columns take no part.

    Rows are never shuffled by source: the draw of a row follows from its id and
    a few figures of its source, which come from sums by source and block.
    """
    if entropy is None and repetition is None:
        repetition = 4.0
    with scratch(docs.sparkSession) as keep:
        return _mixed(docs, budget, entropy, repetition, seed, id_col, source_col, text_col, columns, keep)


def _mixed(docs, budget, entropy, repetition, seed, id_col, source_col, text_col, columns, keep) -> DataFrame:
    narrow = cut(docs.select(F.coalesce(F.col(source_col), F.lit("")).alias("_source"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.col(id_col).alias("doc_id"), n_tokens(text_col).alias("_tokens")), "tokens")
    totals = narrow.groupBy(F.col("_source").alias("source")).agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs"))
    totals = cut(totals, "totals")
    size = totals.agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).first()
    cover = budget == "cover"
    whole = budget if budget is not None and not cover else int(size["t"] or 0)
    exponent = find_exponent(totals, budget=None if cover else float(whole), entropy=entropy, repetition=repetition)
    if cover:
        whole = math.ceil(_figures(totals, [exponent], None)[0][2])
    some = F.col("tokens") > 0
    plan = weights_of(totals, exponent).select("source", "tokens", "docs", F.greatest(F.floor(F.col("weight") * F.lit(float(whole))).cast("long"), F.col("tokens") * int(cover)).alias("_budget"))
    plan = plan.select(
        F.col("source").alias("_source"),
        F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK_ROWS)).cast("long").alias("_blocks"),
        F.when(some, F.expr("_budget div tokens")).otherwise(F.lit(1)).cast("long").alias("_epochs"),
        F.when(some, F.expr("_budget % tokens")).otherwise(F.lit(0)).cast("long").alias("_left"),
    )
    plan = cut(plan, "plan")
    last = F.col("_epochs")
    keyed = _with_plan(narrow, plan, size["n"]).where("_left > 0").withColumn("_b", _block(seed, last))
    sums = keyed.groupBy("_source", "_b", "_epochs", "_left").agg(F.sum("_tokens").alias("_sum")).withColumn("_key", _block_key(seed, last, F.col("_b")))
    order = Window.partitionBy("_source").orderBy("_key", "_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(order), F.lit(0)))
    # the block in which the budget ends; blocks before it are drawn whole
    ends = sums.where("_before < _left and _before + _sum >= _left").select("_source", F.col("_b").alias("_end_b"), F.col("_key").alias("_end_key"), "_before")
    within = _with_plan(keyed, ends, size["n"]).where("_b = _end_b").withColumn("_row", _row_key(seed, last))
    by_key = within.groupBy("_source", "_end_b", "_end_key", "_left", "_before", "_row").agg(F.sum("_tokens").alias("_t"))
    inner = Window.partitionBy("_source").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    by_key = by_key.withColumn("_sofar", F.col("_before") + F.coalesce(F.sum("_t").over(inner), F.lit(0))).where("_sofar < _left")
    ends = by_key.groupBy("_source", "_end_b", "_end_key").agg(F.max("_row").alias("_end_row"))
    plan = keep(cut(plan.join(ends, "_source", "left"), "draw"))

    if columns:
        base = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("_doc"), F.coalesce(F.col(source_col), F.lit("")).alias("_source"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"))
    else:
        base = keep(narrow)
    rows = _with_plan(base, plan, size["n"]).withColumn("_b", _block(seed, last))
    key = _block_key(seed, last, F.col("_b"))
    before_end = (key < F.col("_end_key")) | ((key == F.col("_end_key")) & (F.col("_b") < F.col("_end_b")))
    drawn = F.coalesce((F.col("_left") > 0) & (before_end | ((F.col("_b") == F.col("_end_b")) & (_row_key(seed, last) <= F.col("_end_row")))), F.lit(False))
    copies = F.col("_epochs") + drawn.cast("long")
    rows = rows.withColumn("_copies", copies).where("_copies > 0")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("epoch"))
    if columns:
        return rows.select("_doc.*")
    block = _block(seed, F.col("epoch"))
    rows = rows.withColumn("block", block)
    return rows.select("doc_id", F.col("_source").alias("source"), "epoch", "block", _block_key(seed, F.col("epoch"), F.col("block")).alias("block_key"), _row_key(seed, F.col("epoch")).alias("row_key"), F.col("_tokens").alias("tokens"))


def oracle(*, repetition: float = 4.0, seed: int = 0) -> str:
    """mix_sources over ``documents`` in DuckDB's SQL, with its default budget."""

    def unit(*parts: str) -> str:
        return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15) AS BIGINT)"

    s = f"'{seed}'"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS tokens FROM documents),
t AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS docs FROM d GROUP BY 1),
w AS (SELECT CAST(sum(tokens) AS DOUBLE) AS whole FROM t),
l AS (SELECT list(tokens) AS toks, list(tokens / whole) AS shares FROM t, w WHERE tokens > 0),
f AS (SELECT toks, shares, whole FROM l, w),
b(step, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CASE WHEN list_max(list_transform(range(1, len(toks) + 1), lambda i: 1.0 / toks[i])) / len(toks) * whole <= {repetition} THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END FROM f
  UNION ALL
  SELECT step + 1, CASE WHEN good THEN lo ELSE mid END, CASE WHEN good THEN mid ELSE hi END FROM (
    SELECT step, lo, hi, (lo + hi) / 2 AS mid,
      list_max(list_transform(range(1, len(toks) + 1), lambda i: pow(shares[i], (lo + hi) / 2) / toks[i])) / list_sum(list_transform(shares, lambda x: pow(x, (lo + hi) / 2))) * whole <= {repetition} AS good
    FROM b, f WHERE step < 40)),
a AS (SELECT hi AS a FROM b ORDER BY step DESC LIMIT 1),
z AS (SELECT sum(pow(tokens / whole, a)) AS z FROM t, w, a WHERE tokens > 0),
p AS (SELECT source, tokens, CAST(greatest(1, ceil(docs / 500.0)) AS BIGINT) AS blocks,
    CASE WHEN tokens > 0 THEN CAST(floor(pow(tokens / whole, a) / z * whole) AS BIGINT) END AS budget FROM t, w, a, z),
q AS (SELECT source, blocks, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS epochs, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM p),
k AS (SELECT d.*, q.*, {unit(s, 'CAST(epochs AS VARCHAR)', "'block'", 'id')} % blocks AS b FROM d JOIN q USING (source)),
k2 AS (SELECT *, {unit(s, 'CAST(epochs AS VARCHAR)', "'order'", 'source', 'CAST(b AS VARCHAR)')} AS bk, {unit(s, 'CAST(epochs AS VARCHAR)', "'row'", 'id')} AS rk FROM k),
o AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY bk, b, rk RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - sum(tokens) OVER (PARTITION BY source, bk, b, rk) AS before FROM k2),
c AS (SELECT doc_id, source, id, blocks, tokens, epochs + CASE WHEN rest > 0 AND before < rest THEN 1 ELSE 0 END AS copies FROM o),
e AS (SELECT *, unnest(range(copies)) AS epoch FROM c WHERE copies > 0),
g AS (SELECT *, {unit(s, 'CAST(epoch AS VARCHAR)', "'block'", 'id')} % blocks AS block FROM e)
SELECT doc_id, source, epoch, block, {unit(s, 'CAST(epoch AS VARCHAR)', "'order'", 'source', 'CAST(block AS VARCHAR)')} AS block_key,
  {unit(s, 'CAST(epoch AS VARCHAR)', "'row'", 'id')} AS row_key, tokens FROM g"""
