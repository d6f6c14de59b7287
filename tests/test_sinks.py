"""Quick-look order and resumable pages."""

import pytest
from pyspark.sql import functions as F

from tablewatch import Cols
from tablewatch.sources.sinks import fetch_page, fetch_pages, quicklook, stage_pages, staged


def sample(spark, n=1000):
    return (spark.range(n).withColumn("a", F.when(F.col("id") % 7 > 0, F.col("id") % 5)).withColumn("b.c", F.col("id") % 3)
            .repartition(6, "id"))


@pytest.mark.parametrize("rows", [1, 300, 1000, 5000])
def test_pages_joined_are_the_whole(spark, tmp, rows):
    df = sample(spark, 12 if rows == 1 else 1000)
    stage_pages(df, f"{tmp}/r", ["a", "b.c", "id"])
    want = [tuple(r) for r in df.orderBy(F.col("a").asc_nulls_first(), "`b.c`", "id").collect()]
    got, cursors = [], []
    for page, at in fetch_pages(spark, f"{tmp}/r", 0, rows):
        assert page.columns == df.columns
        got.append([tuple(r) for r in page.collect()])
        cursors.append(at)
    assert [len(p) for p in got[:-1]] == [rows] * (len(got) - 1) and cursors[-1] is None
    assert sum(got, []) == want
    # a client that comes back with a cursor goes on from there
    if len(cursors) > 1:
        assert [tuple(r) for r in fetch_page(spark, f"{tmp}/r", cursors[0], rows)[0].collect()] == got[1]


def test_pages_are_computed_once_and_after_a_crash(spark, tmp):
    path = f"{tmp}/r"
    sample(spark, 10).write.parquet(f"{path}/rows")  # rows without their counts: a run that died
    assert not staged(spark, path)
    stage_pages(sample(spark), path, ["id"])
    stage_pages(sample(spark, 3), path, ["id"])  # no effect
    assert [r["id"] for r in fetch_page(spark, path, 990, 100)[0].collect()] == list(range(990, 1000))
    page, at = fetch_page(spark, path, 2000, 10)
    assert page.count() == 0 and at is None


def test_pages_of_nothing(spark, tmp):
    stage_pages(sample(spark).limit(0), f"{tmp}/r", ["id"])
    page, at = fetch_page(spark, f"{tmp}/r")
    assert page.count() == 0 and page.columns == ["id", "a", "b.c"] and at is None


def test_page_reads_one_interval(spark, tmp):
    stage_pages(sample(spark), f"{tmp}/r", ["id"])
    plan = fetch_page(spark, f"{tmp}/r", 100, 50)[0]._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(__at," in plan and "LessThanOrEqual(__at," in plan


def test_quicklook_order_is_total(spark):
    cols = Cols("s", "t", "x", ("e",))
    df = spark.createDataFrame([(s, t, 1.0, e, 2.0) for s in (2, 1) for t in (3, 1) for e in (9, 4)],
                               "s int, t int, x double, e int, abs_z double")
    got = quicklook({"temp_outliers_zscore": df}, cols, limit=5)["zscore_top"].collect()
    assert [(r.s, r.t, r.e) for r in got] == [(1, 1, 4), (1, 1, 9), (1, 3, 4), (1, 3, 9), (2, 1, 4)]
