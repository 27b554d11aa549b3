"""WARC fixity audit with Merkle trees over records and their offset ranges.

Pages become WARC records, dealt to files of about a thousand by their digests.
A manifest has each record's offset range.  What replicas hold at the ranges is
hashed where the records are read, so record bodies are never shuffled, only
digests and lengths.  The records' hashes are the leaves of a tree per file and
replica, and every node hashes up to sixteen children with their ranges.
Replicas are compared from the roots down, following mismatching nodes only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import cut, scratch

FILE_RECORDS, FANOUT = 1000, 16
DATE = "2024-01-01T00:00:00Z"
#: Mismatching files whose numbers are pushed into the scan of the next level; beyond, the join alone picks the nodes.
PUSHED_FILES = 1000


def keyed(column: Column, salt: str) -> Column:
    """32 bits of the MD5 of the column's text."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(column.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("long")


def to_records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """(record_id, record): the WARC record of every row as bytes; null ids, URLs and bodies count as empty."""
    rid = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    body = F.coalesce(F.col(body_col), F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:md5:"), F.md5(rid), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.col(url_col), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return pages.select(F.col(id_col).alias("record_id"), F.encode(F.concat(head, body, F.lit("\r\n\r\n")), "UTF-8").alias("record"))


def digest_of(record: str) -> Column:
    return F.sha2(record, 256)


def manifest_of(records: DataFrame, *, replicas: dict[str, str] | None = None, count: int | None = None) -> DataFrame:
    """(record_id, file, seq, offset, length, digest) of the records, in files of about FILE_RECORDS by digest, ordered by id and digest.

    Rows that repeat an id and its contents are one record.  ``replicas`` names
    further columns of record bodies: name -> column; of each come out
    ``name_hash`` (null where the body is) and ``name_held``, its length.  Many
    records of one id, or of null ids, are spread over the files as others are.
    """
    files = F.greatest(F.lit(1), F.ceil(F.lit(records.select("record_id").count() if count is None else count) / FILE_RECORDS)).cast("long")
    own = [x for name, c in (replicas or {}).items() for x in (digest_of(c).alias(f"{name}_hash"), F.octet_length(c).cast("long").alias(f"{name}_held"))]
    rows = records.select("record_id", F.octet_length("record").cast("long").alias("length"), digest_of("record").alias("digest"), *own).dropDuplicates(["record_id", "digest"])
    rows = rows.withColumn("file", (F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % files).cast("int"))
    order = Window.partitionBy("file").orderBy(F.col("record_id").asc_nulls_first(), "digest")
    extra = [c for c in rows.columns if c not in ("record_id", "file", "length", "digest")]
    return rows.select("record_id", "file", (F.row_number().over(order) - 1).alias("seq"), (F.sum("length").over(order) - F.col("length")).alias("offset"), "length", "digest", *extra)


def holdings(replica: DataFrame, name: str) -> DataFrame:
    """(file, seq, name_hash, name_held) of what a replica (file, seq, record) holds at a manifest's ranges."""
    return replica.select("file", "seq", digest_of("record").alias(f"{name}_hash"), F.octet_length("record").cast("long").alias(f"{name}_held"))


def trees_of(leaves: DataFrame) -> list[DataFrame]:
    """Levels of both replicas' trees, leaves first, each a table (file, node, offset, length, one, two) ordered by file.

    Both trees stand over the manifest's ranges and so have the same nodes; a node's
    range spans its children's.
    """
    levels = [cut(leaves.repartitionByRange("file").sortWithinPartitions("file", "node"), "tree-0")]
    while levels[-1].where("node > 0").limit(1).count():
        child = F.struct("node", *[F.concat_ws(":", "offset", "length", c).alias(c) for c in ("one", "two")])
        up = levels[-1].groupBy("file", F.expr(f"node div {FANOUT}").alias("up")).agg(F.min("offset").alias("offset"), F.sum("length").alias("length"), F.array_sort(F.collect_list(child)).alias("c"))
        up = up.select("file", F.col("up").alias("node"), "offset", "length", *[F.sha2(F.array_join(F.col(f"c.{c}"), ","), 256).alias(c) for c in ("one", "two")])
        levels.append(cut(up.sortWithinPartitions("file", "node"), f"tree-{len(levels)}"))
    return levels


def descend(levels: list[DataFrame]) -> DataFrame:
    """(file, node) of the leaves that differ, found from the roots down."""
    differ = "one <> two"
    front = cut(levels[-1].where(differ).select("file", "node"), "front")
    for level in reversed(levels[:-1]):
        few = [r["file"] for r in front.select("file").distinct().limit(PUSHED_FILES + 1).collect()]
        nodes = level.where(F.col("file").isin(few)) if len(few) <= PUSHED_FILES else level
        parents = front.select("file", F.col("node").alias("_up"))
        nodes = nodes.where(differ).withColumn("_up", F.expr(f"node div {FANOUT}"))
        front = cut(nodes.join(parents, ["file", "_up"], "left_semi").select("file", "node"), "front")
    return front


def audit(manifest: DataFrame) -> DataFrame:
    """The manifest's rows with status: ok, or changed, short, long or missing where replica ``two`` differs from ``one``.

    ``manifest`` has both replicas' holdings (one_hash, one_held, two_hash,
    two_held; null where a replica holds nothing).  If ``one`` lacks a record that
    ``two`` holds, the status is "extra".  Further columns stay.  Without rows
    there is no result.
    """
    with scratch(manifest.sparkSession) as keep:
        whole = keep(cut(manifest, "manifest"))
        leaves = whole.select("file", F.col("seq").cast("long").alias("node"), "offset", "length", *[F.coalesce(f"{c}_hash", F.lit("")).alias(c) for c in ("one", "two")])
        bad = keep(descend(trees_of(leaves)))
    kind = F.when(F.col("one_hash").isNull(), "extra").when(F.col("two_hash").isNull(), "missing").when(F.col("two_held") < F.col("one_held"), "short").when(F.col("two_held") > F.col("one_held"), "long").otherwise("changed")
    found = whole.join(bad.select("file", F.col("node").cast("int").alias("seq"), F.lit(True).alias("_bad")), ["file", "seq"], "left")
    return found.withColumn("status", F.when(F.col("_bad"), kind).otherwise("ok")).select(*[c for c in manifest.columns if c not in ("one_hash", "one_held", "two_hash", "two_held")], "status")


def damaged(record_id: str, record: str) -> Column:
    """A replica's record with planted damage, by the MD5 of the id: 1 in 100 a changed byte, 1 in 200 cut short, 1 in 300 gone."""
    k = keyed(F.col(record_id), "damage")
    middle = F.expr(f"cast(octet_length({record}) div 2 as int)")
    head = F.substring(record, F.lit(1), middle)
    changed = F.concat(head, F.when(F.substring(record, middle + 1, F.lit(1)) == F.lit(b"#"), F.lit(b"$")).otherwise(F.lit(b"#")), F.substring(record, middle + 2, F.octet_length(record)))
    return F.when(k % 300 == 2, F.lit(None).cast("binary")).when(k % 200 == 1, head).when(k % 100 == 0, changed).otherwise(F.col(record))


def oracle() -> str:
    """The audit of damaged() against the records of ``pages`` in DuckDB's SQL."""
    key = "CAST('0x' || substr(md5('damage' || coalesce(CAST(page_id AS VARCHAR), '')), 1, 8) AS BIGINT)"
    return f"""
WITH n AS (SELECT CAST(greatest(1, ceil(count(*) / {FILE_RECORDS}.0)) AS BIGINT) AS files FROM pages),
r AS (SELECT page_id AS record_id, files, {key} AS k,
  'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Date: {DATE}' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:md5:' || md5(coalesce(CAST(page_id AS VARCHAR), '')) || '>' || chr(13) || chr(10)
  || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
  || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM pages, n),
d AS (SELECT DISTINCT record_id, files, k, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS digest FROM r),
f AS (SELECT *, CAST(CAST('0x' || substr(digest, 1, 8) AS BIGINT) % files AS INTEGER) AS file FROM d)
SELECT record_id, file, CAST(row_number() OVER w - 1 AS INTEGER) AS seq, CAST(sum(length) OVER w - length AS BIGINT) AS "offset", length, digest,
  CASE WHEN k % 300 = 2 THEN 'missing' WHEN k % 200 = 1 THEN 'short' WHEN k % 100 = 0 THEN 'changed' ELSE 'ok' END AS status
FROM f WINDOW w AS (PARTITION BY file ORDER BY record_id NULLS FIRST, digest)"""
