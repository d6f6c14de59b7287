"""Command-line/env parameters and exactly-once incremental ingest."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tablewatch.params import Params
from tablewatch.streaming import ingest_new_files


def test_params_defaults_match_reference_job():
    p = Params.from_cli([], env={})
    assert (p.input_path, p.feature, p.ts_col, p.sys_col, p.out_dir) == (
        "./data/stats_test/*.prq", "temperature", "timestamp", "system_id", "preds")
    assert (p.z_thresh, p.min_points, p.topk, p.kmeans_k, p.km_pr_cutoff) == (2.0, 20, 50, 2, 0.99)
    assert (p.knn_mode, p.knn_k, p.knn_pr_cutoff, p.lsh_bucket, p.lsh_thresh) == (
        "time", 5, 0.99, 1.0, 1.5)
    assert (p.max_group_rows, p.rank_digits, p.print_limit, p.iqr_mult) == (None, None, 100, 1.5)


def test_params_flags_and_env():
    p = Params.from_cli(["-i", "x/*.parquet", "-f", "cpu_temp", "--timestamp-col", "ts",
                         "--system-col", "device", "-o", "out", "--tie-break", "a,b"],
                        env={"Z_THRESH": "3", "KNN_MODE": "LSH", "MAX_GROUP_ROWS": "10",
                             "SPLIT_ROWS": "99", "RANK_DIGITS": "4"})
    assert p.cols.key == ["device", "ts", "cpu_temp", "a", "b"]
    assert p.z_thresh == 3.0 and p.knn_mode == "LSH" and p.max_group_rows == 10
    assert p.scale.split_rows == 99 and p.rank_digits == 4 and p.out_dir == "out"


def test_ingest_new_files_is_exactly_once(spark, tmp):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src, sink, ckpt = f"{tmp}/src", f"{tmp}/sink", f"{tmp}/ckpt"
    ev.filter(F.col("event_type") == "click").write.parquet(f"{src}/a")
    n1 = ingest_new_files(spark, src, sink, ckpt, schema=ev.schema)
    assert n1 == ev.filter(F.col("event_type") == "click").count()
    assert ingest_new_files(spark, src, sink, ckpt, schema=ev.schema) == 0   # rerun: nothing new
    ev.filter(F.col("event_type") != "click").write.parquet(f"{src}/b")
    n2 = ingest_new_files(spark, src, sink, ckpt, schema=ev.schema)
    assert n1 + n2 == ev.count()
    assert spark.read.parquet(sink).count() == ev.count()


def test_cols_reject_repeated_roles():
    import pytest
    from tablewatch.params import Cols
    with pytest.raises(ValueError):
        Cols("s", "t", "x", ("s",))
    assert Cols("s", "t", "x", ["a"]).tie_break == ("a",)
