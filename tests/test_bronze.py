"""Compaction and backfill that stop anywhere and go on."""

import time

import pytest
from pyspark.sql import functions as F

from ebbline.operators.current_state import current_state
from ebbline.sources import bronze as br
from ebbline.sources import registry as rg
from ebbline.sources.shared import new_path

SPEC = rg.TableSpec("t", ("a", "b"), partition_date="day")


def rows_of(df):
    return sorted((tuple(r) for r in df.select("k", "v", "day", "jahr").collect()), key=repr)


@pytest.fixture
def table(spark):
    root = new_path(spark, "bronze")
    base = spark.createDataFrame([(i, i, f"{1990 + i % 5}-01-01" if i % 7 else None) for i in range(60)], "k int, v int, day string")
    br.write_years(base, f"{root}/t", "day", key=["k"], parts=2)
    delta = spark.createDataFrame(
        [(1, 100, "1991-01-01", "U", "1"), (1, 101, "1991-01-01", "U", "2"), (6, 0, "1991-05-05", "D", "1"), (900, 9, "1992-02-02", "I", "1"), (901, 9, "2001-02-02", "I", "1"), (901, 9, "2001-02-02", "D", "2"), (902, 8, "2003-02-02", "I", "1")],
        "k int, v int, day string, _op string, _seq string",
    )
    delta.repartition(2).write.parquet(f"{root}/_delta/t")
    years = F.coalesce(rg.year_partition(F.col("day")), F.lit("unknown"))
    return root, rows_of(current_state(base, delta, key=["k"]).withColumn("jahr", years))


def files_of(spark, root, year):
    return br.Files(spark, root).parquet(f"{root}/t/jahr={year}")


def test_compaction_rewrites_only_affected_years(spark, table):
    root, want = table
    kept, changed = files_of(spark, root, 1993), files_of(spark, root, 1991)
    assert br.compact_table(spark, root, "t", key=["k"], date="day") == 2
    assert rows_of(br.read_years(spark, f"{root}/t")) == want
    assert files_of(spark, root, 1993) == kept and files_of(spark, root, 1991) != changed and files_of(spark, root, 2001) == []
    assert br.Files(spark, root).parquet(f"{root}/_delta/t") == [] and len(br.Files(spark, root).parquet(f"{root}/_delta_archive/t")) == 2
    assert br.compact_table(spark, root, "t", key=["k"], date="day") == 0 and rows_of(br.read_years(spark, f"{root}/t")) == want
    now = int(time.time() * 1000)
    assert br.prune_archive(spark, root, "t", now_ms=now) == 0 and br.prune_archive(spark, root, "t", now_ms=now + 91 * 86_400_000) == 2


@pytest.mark.parametrize("step", ["stage", "plan", "swap", "half swap", "archive", "half archive"])
def test_compaction_stopped_anywhere_gives_the_same_table(spark, table, step, monkeypatch):
    root, want = table
    files = br.Files(spark, root)

    class Stop(Exception):
        pass

    def fail(*_, **__):
        raise Stop

    if step in ("stage", "plan"):
        br.stage_compaction(spark, root, "t", key=["k"], date="day")
        files.remove(f"{root}/_compact/t/plan/_SUCCESS" if step == "plan" else f"{root}/_compact/t/plan")
    else:
        with monkeypatch.context() as m:
            if step == "half archive":
                move = br.Files.move
                seen = []
                m.setattr(br.Files, "move", lambda self, *a: fail() if seen else (seen.append(1), move(self, *a)))
            elif step == "half swap":
                m.setattr(br.Files, "remove", lambda self, name: fail() if "/t/jahr=" in name else self.fs.delete(self.path(name), True))
            else:
                m.setattr(br, {"swap": "swap_compaction", "archive": "archive_deltas"}[step], fail)
            if step == "half swap":  # a year whose every row goes, removed after the overwrite
                spark.createDataFrame([(k, 0, "1993-09-09", "D", "9") for k in range(60) if k % 5 == 3], "k int, v int, day string, _op string, _seq string").write.mode("append").parquet(f"{root}/_delta/t")
                want = [r for r in want if not (r[0] < 60 and r[0] % 5 == 3)]  # 28 of them without a date
            with pytest.raises(Stop):
                br.compact_table(spark, root, "t", key=["k"], date="day")
    late = [(77, 7, "1999-09-09", "I", "1")]  # arrives in between
    spark.createDataFrame(late, "k int, v int, day string, _op string, _seq string").write.mode("append").parquet(f"{root}/_delta/t")
    done = br.compact_table(spark, root, "t", key=["k"], date="day")
    done += br.compact_table(spark, root, "t", key=["k"], date="day")
    assert done >= 2 and rows_of(br.read_years(spark, f"{root}/t")) == sorted([*want, (77, 7, "1999-09-09", "1999")], key=repr)
    assert not files.exists(f"{root}/_compact/t") and files.parquet(f"{root}/_delta/t") == []


def test_undated_table_and_undated_change(spark):
    root = new_path(spark, "bronze")
    br.write_years(spark.range(5).selectExpr("id as k", "id as v", "cast(null as string) as day"), f"{root}/t", None, key=["k"])
    spark.createDataFrame([(3, 0, None, "D", "1")], "k long, v long, day string, _op string, _seq string").coalesce(1).write.parquet(f"{root}/_delta/t")
    assert br.compact_table(spark, root, "t", key=["k"], date="day") == 1
    assert [r[0] for r in rows_of(br.read_years(spark, f"{root}/t"))] == [0, 1, 2, 4]


def test_a_change_moves_its_row_to_another_year(spark, table):
    root, want = table
    spark.createDataFrame([(2, 5, "1994-04-04", "U", "9")], "k int, v int, day string, _op string, _seq string").write.mode("append").parquet(f"{root}/_delta/t")
    br.compact_table(spark, root, "t", key=["k"], date="day")
    assert rows_of(br.read_years(spark, f"{root}/t")) == sorted([*[r for r in want if r[0] != 2], (2, 5, "1994-04-04", "1994")], key=repr)


def test_backfill_goes_on_without_lost_or_doubled_rows(spark, monkeypatch):
    root = new_path(spark, "backfill")
    rows = [(i % 40 if i % 13 else None, f"k'{i % 7}" if i % 11 else None, i, f"{2000 + i % 3}-01-01" if i % 5 else "x") for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b string, v int, day string").repartition(4)
    assert br.backfill_table(df, root, SPEC, rows_per_slice=90, most_slices=2) == 2
    first = br.backfill_state(spark, root, "t").first().rows_total
    assert 0 < first < 400 and br.read_backfill(spark, root, "t").count() == first
    read = br.read_slice

    def stop(spark, path, columns):
        if path.endswith("slice=2"):
            raise KeyError("stopped")
        return read(spark, path, columns)

    monkeypatch.setattr(br, "read_slice", stop)
    with pytest.raises(KeyError):  # rows of the slice are written, its entry is not
        br.backfill_table(df, root, SPEC, rows_per_slice=90)
    monkeypatch.undo()
    assert br.read_backfill(spark, root, "t").count() == first
    assert br.backfill_table(df, root, SPEC, rows_per_slice=90) >= 2 and br.backfill_table(df, root, SPEC) == 0
    got = br.read_backfill(spark, root, "t")
    assert sorted((tuple(r) for r in got.select("a", "b", "v", "day").collect()), key=repr) == sorted(rows, key=repr)
    assert {r.jahr for r in got.select("jahr").distinct().collect()} == {"2000", "2001", "2002", "unknown"}
    state = br.backfill_state(spark, root, "t").first()
    assert (state.rows_total, state.cursor) == (400, "{\"a\":39,\"b\":\"k'6\"}")


def test_backfill_of_nothing(spark):
    root = new_path(spark, "backfill")
    assert br.backfill_table(spark.createDataFrame([], "a int, b string, v int, day string"), root, SPEC) == 1
    assert br.backfill_table(spark.createDataFrame([], "a int, b string, v int, day string"), root, SPEC) == 0


def test_key_predicates():
    assert rg.key_predicates("k", [(None, 5), (5, 9), (9, None)]) == ['("k" < 5 OR "k" IS NULL)', '"k" >= 5 AND "k" < 9', '"k" >= 9']
    assert rg.key_predicates('k"x', [("a'; DROP", None), (None, None)]) == ["\"k\"\"x\" >= 'a''; DROP'", '("k""x" IS NOT NULL OR "k""x" IS NULL)']
