"""Tables over mixed files and appends by manifest."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from tablewatch.sources.append import append_new_files, appended, commit, manifest_of, stage
from tablewatch.sources.ingest import register_folders
from tablewatch.sources.widen import common_type


def put(path, **columns):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path)


@pytest.mark.parametrize("a,b,want", [
    (T.IntegerType(), T.LongType(), T.LongType()), (T.LongType(), T.DecimalType(20, 0), T.DecimalType(20, 0)),
    (T.IntegerType(), T.DecimalType(9, 2), T.DecimalType(12, 2)), (T.FloatType(), T.DoubleType(), T.DoubleType()),
    (T.IntegerType(), T.FloatType(), T.DoubleType()), (T.LongType(), T.DoubleType(), None),
    (T.DecimalType(38, 0), T.DecimalType(38, 10), None), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
    (T.StringType(), T.IntegerType(), None), (T.ArrayType(T.LongType()), T.ArrayType(T.LongType()), T.ArrayType(T.LongType()))])
def test_common_type(a, b, want):
    assert common_type(a, b) == common_type(b, a) == want


def test_mixed_folder_is_one_table(spark, tmp):
    root = f"{tmp}/data"
    put(f"{root}/T/a.parquet", id=pa.array([1, 2], pa.int32()), x=pa.array([1.5, 2.5], pa.float32()))
    put(f"{root}/T/b.parquet", id=pa.array([2**64 - 1], pa.uint64()), late=pa.array(["only here"]))
    put(f"{root}/T/sub/c.PRQ", ID=pa.array([-7], pa.int64()), x=pa.array([0.1], pa.float64()))
    got = register_folders(spark, root, "tw_mixed_a").collect()
    assert [(r["table"], r["n_files"], r["n_rows"], r["status"]) for r in got] == [("t", 3, 4, "created")]
    df = spark.table("tw_mixed_a.t")
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("id", "decimal(20,0)"), ("x", "double"), ("late", "string")]
    assert sorted((int(r["id"]), r["x"], r["late"]) for r in df.collect()) == [
        (-7, 0.1, None), (1, 1.5, None), (2, 2.5, None), (2**64 - 1, None, "only here")]
    # A file that widens the table further makes it anew; nothing else changes.
    put(f"{root}/T/d.parquet", id=pa.array([5], pa.int8()), more=pa.array([True]))
    assert register_folders(spark, root, "tw_mixed_a").first()["status"] == "created"
    assert spark.table("tw_mixed_a.t").count() == 5 and "more" in spark.table("tw_mixed_a.t").columns
    assert register_folders(spark, root, "tw_mixed_a").first()["status"] == "refreshed"
    spark.sql("DROP DATABASE tw_mixed_a CASCADE")


def test_types_without_a_common_one_are_reported(spark, tmp):
    root = f"{tmp}/data"
    put(f"{root}/bad/a.parquet", v=pa.array([1], pa.int64()))
    put(f"{root}/bad/b.parquet", v=pa.array(["x"]))
    put(f"{root}/unsigned/a.parquet", v=pa.array([4_000_000_000], pa.uint32()))
    put(f"{root}/unsigned/b.parquet", v=pa.array([1], pa.uint64()))  # the reader would give negative numbers
    put(f"{root}/good/a.parquet", v=pa.array([1], pa.int64()))
    got = {r["folder"]: r for r in register_folders(spark, root, "tw_mixed_b").collect()}
    assert got["good"]["status"] == "created"
    assert "no common type for v: int64, string" in got["bad"]["error"]
    assert "uint32, uint64" in got["unsigned"]["error"]
    spark.sql("DROP DATABASE tw_mixed_b CASCADE")


def test_append_takes_every_file_once(spark, tmp):
    src, sink = f"{tmp}/src", f"{tmp}/sink"
    put(f"{src}/a.parquet", v=pa.array([1, 2]))
    assert append_new_files(spark, src, sink) == 2
    assert append_new_files(spark, src, sink) == 0
    put(f"{src}/deep/b.prq", v=pa.array([3]))
    staged = stage(spark, src, sink)  # written, but the run dies
    assert sorted(r["v"] for r in appended(spark, sink).collect()) == [1, 2]
    assert append_new_files(spark, src, sink) == 1  # the repetition
    assert sorted(r["v"] for r in appended(spark, sink).collect()) == [1, 2, 3]
    assert staged[2] == 1 and manifest_of(spark, sink).count() == 2
    put(f"{src}/deep/b.prq", v=pa.array([3, 4, 5]))  # written anew
    assert commit(stage(spark, src, sink), sink) == 3
    assert sorted(r["v"] for r in appended(spark, sink).collect()) == [1, 2, 3, 3, 4, 5]


def test_append_refuses_unreadable_files(spark, tmp):
    src, sink = f"{tmp}/src", f"{tmp}/sink"
    put(f"{src}/a.parquet", v=pa.array([1]))
    with open(f"{src}/b.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(ValueError, match="b.parquet"):
        append_new_files(spark, src, sink)
    with pytest.raises(ValueError, match="no committed batch"):
        appended(spark, sink)
