"""Queries of the change feeds on small tables."""

import datetime

import duckdb
import pytest

from ebbline.plans import ingest


def cases_of(spark, folder, rows):
    rows = [(key, 7, datetime.date(year, 6, 1) if year else None, status, "1-URGENT", 1.0) for key, (year, status) in enumerate(rows, 1)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate date, o_orderstatus string, o_orderpriority string, o_totalprice double").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([(1993, "O"), (1994, "F"), (1995, "P"), (1998, "O"), (1999, "F")], {"1993", "1995", "1998"}),
        ([(1993, "O"), (1994, "F"), (1995, "P"), (None, "O"), (1999, "F")], {"unknown", "1993", "1994", "1995", "1999"}),
        ([(1994, "F"), (1999, "F"), (None, "F")], set()),
    ],
    ids=["changes of old years", "an undated change", "no change"],
)
def test_affected_partitions_are_those_of_all_changes(spark, tmp_path, rows, want):
    d = cases_of(spark, tmp_path, rows)
    assert {r.jahr for r in ingest.affected_partitions(spark, d).collect()} == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{d}/orders.parquet/*.parquet'")
    assert {r[0] for r in con.execute(ingest.SQL["affected_partitions"]).fetchall()} == want
