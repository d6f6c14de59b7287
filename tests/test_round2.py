"""Answers that must not depend on sizes or knobs, name collisions, and
sanitiser safety."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from tablewatch.operators import iqr_bounds, knn_lsh
from tablewatch.operators import iqr as iqr_module
from tablewatch.operators import zscore
from tablewatch.params import Scale
from tablewatch.plans.catalog import run_sql
from tablewatch.sources.footers import schema_census
from tablewatch.sources.ingest import register_folders
from tablewatch.sources.sanitize import sanitize


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_split_rows_does_not_change_quartiles(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plain = rows(iqr_bounds(ev, E.EV))
    assert rows(iqr_bounds(ev, E.EV, scale=Scale(split_rows=20, max_splits=8))) == plain


def test_bounds_without_broadcast_equal_the_broadcast_plan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plain = rows(iqr_bounds(ev, E.EV))
    assert rows(iqr_bounds(ev, E.EV, scale=Scale(broadcast_bytes=1))) == plain
    assert iqr_module.SALTS > 1


def test_split_rows_does_not_change_grid_neighbours(spark):
    s = zscore(spark.read.parquet(f"{SF_SMALL}/events.parquet"), E.EV)
    assert rows(knn_lsh(s, E.EV)) == rows(knn_lsh(s, E.EV, scale=Scale(split_rows=20, max_splits=8)))


def write(path, **columns):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path)


def test_folders_that_share_a_name_come_and_go(spark, tmp):
    root, ns = f"{tmp}/data", "tw_collide"
    write(f"{root}/foo/a.parquet", event_id=[1, 2], user_id=[10, 20])
    write(f"{root}/foo__part0/a.parquet", event_id=[7], user_id=[70])  # a folder of a generated name's form
    assert {r["status"] for r in register_folders(spark, root, ns).collect()} == {"created"}
    write(f"{root}/Foo/b.parquet", user_id=[30], event_id=[3])  # other column order
    got = {r["folder"]: r["status"] for r in register_folders(spark, root, ns).collect()}
    assert "error" not in got.values()
    assert rows(spark.sql(f"SELECT event_id, user_id FROM {ns}.foo")) == [(1, 10), (2, 20), (3, 30)]
    assert rows(spark.sql(f"SELECT event_id FROM {ns}.foo__part0")) == [(7,)]
    import shutil
    shutil.rmtree(f"{root}/Foo")
    register_folders(spark, root, ns).collect()
    assert rows(spark.sql(f"SELECT event_id, user_id FROM {ns}.foo")) == [(1, 10), (2, 20)]
    assert {t.name for t in spark.catalog.listTables(ns)} == {"foo", "foo__part0"}
    spark.sql(f"DROP DATABASE {ns} CASCADE")


def test_hidden_and_empty_folders_are_reported(spark, tmp):
    root = f"{tmp}/data"
    write(f"{root}/ok/a.parquet", x=[1])
    os.makedirs(f"{root}/empty")
    write(f"{root}/_hidden/a.parquet", x=[1])
    got = {r["folder"]: r["status"] for r in register_folders(spark, root, "tw_hidden").collect()}
    assert got["ok"] == "created" and got.get("_hidden", "skipped") == "skipped" and got.get("empty", "skipped") == "skipped"
    spark.sql("DROP DATABASE tw_hidden CASCADE")


@pytest.mark.parametrize("out", ["data", "data/inner", ""])
def test_sanitiser_never_writes_over_its_input(spark, tmp, out):
    write(f"{tmp}/data/a.parquet", timestamp=pa.array([1_700_000_000_000_000], pa.uint64()))
    with pytest.raises(ValueError, match="overlaps"):
        sanitize(spark, f"{tmp}/data", f"{tmp}/{out}", overwrite=True)
    assert pq.read_table(f"{tmp}/data/a.parquet").num_rows == 1


def test_sanitised_timestamps_are_microseconds(spark, tmp):
    write(f"{tmp}/in/a.parquet", timestamp=pa.array([1_700_000_000_000_000], pa.uint64()))
    write(f"{tmp}/in/b.parquet", timestamp=pa.array([1_700_000_000_000_000], pa.uint64()), extra=pa.array([3], pa.uint64()))
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    sanitize(spark, f"{tmp}/in", f"{tmp}/out").count()
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == before
    got = schema_census(spark, f"{tmp}/out").filter("column = 'timestamp'")
    assert {r["arrow_type"] for r in got.collect()} == {"timestamp[us, tz=UTC]"}
    files = [f for f in os.listdir(f"{tmp}/out") if f.endswith(".parquet")]
    assert len(files) == 2  # both schemas in the folder they came from
    for f in files:
        kind = pq.ParquetFile(f"{tmp}/out/{f}").schema.column(0).physical_type
        assert kind == "INT64"


def test_run_sql_leaves_the_session_where_it_was(spark, tmp):
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_here")
    before = spark.catalog.currentDatabase()
    assert run_sql(spark, "SELECT 1 AS x", namespace="tw_here").collect()[0]["x"] == 1
    assert spark.catalog.currentDatabase() == before
    with pytest.raises(Exception):
        run_sql(spark, "SELECT * FROM nothing_here", namespace="tw_here").collect()
    assert spark.catalog.currentDatabase() == before
    spark.sql("DROP DATABASE tw_here CASCADE")


def test_stream_ingest_keeps_nulls_and_counts_every_batch(spark, tmp):
    from tablewatch.streaming.incremental import ingest_new_files
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet") \
        .withColumn("event_type", F.when(F.col("event_id") % 10 != 0, F.col("event_type")))
    src = f"{tmp}/src"
    ev.repartition(6).write.parquet(src)
    n = ingest_new_files(spark, src, f"{tmp}/sink", f"{tmp}/ckpt", schema=ev.schema, max_files_per_trigger=1)
    assert n == ev.count() == spark.read.parquet(f"{tmp}/sink").count()
    assert ingest_new_files(spark, src, f"{tmp}/sink", f"{tmp}/ckpt", schema=ev.schema) == 0
