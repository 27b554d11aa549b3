"""Tables in the shared folder."""

import threading

from ebbline.sources.shared import cut, scratch


def exists(spark, df):
    where = spark._jvm.org.apache.hadoop.fs.Path(df._ebbline_path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def test_scratch_removes_what_is_not_kept(spark):
    with scratch(spark) as keep:
        with scratch(spark) as inner:
            gone, kept = cut(spark.range(3)), inner(cut(spark.range(4)))
        assert not exists(spark, gone) and exists(spark, kept)
        last = keep(cut(spark.range(5)))
    assert not exists(spark, kept) and last.count() == 5


def test_scratches_of_two_threads_do_not_meet(spark):
    first, second, found = threading.Event(), threading.Event(), {}

    def one():
        with scratch(spark):
            first.set()
            second.wait(60)
            mine = cut(spark.range(7))
            found["one"] = mine.count()

    def two():
        first.wait(60)
        with scratch(spark) as keep:
            mine = keep(cut(spark.range(8)))
            second.set()
            threads[0].join(60)
            found["two"] = mine.count()
        found["after"] = mine.count()

    threads = [threading.Thread(target=one), threading.Thread(target=two)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert found == {"one": 7, "two": 8, "after": 8}
