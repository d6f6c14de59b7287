"""The whole job, brute-force checks and plan shape."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from tablewatch.operators import kmeans_scores, knn_exact_scores, knn_time_scores, zscore
from tablewatch.params import Params
from tablewatch.plans.detect import detect_all
from tablewatch.sources.sinks import RESULT_NAMES, quicklook

F6 = {
    "temp_outliers_zscore": ["user_id", "ts", "value", "event_id", "z", "abs_z"],
    "temp_suspects_topk": ["user_id", "ts", "value", "event_id", "z", "abs_z"],
    "temp_outliers_iqr": ["user_id", "ts", "value", "event_id"],
    "temp_outliers_kmeans": ["user_id", "ts", "value", "event_id", "z", "cluster", "km_dist",
                             "km_pr"],
    "temp_outliers_knn": ["user_id", "ts", "value", "event_id", "z", "knn_dist", "knn_pr"],
    "iqr_bounds": ["user_id", "q1", "q3", "iqr", "low", "high", "n", "n_outliers"],
    "iqr_outliers_detailed": ["user_id", "ts", "value", "event_id", "q1", "q3", "iqr", "low",
                              "high", "where", "dist_from_bound"],
}


@pytest.mark.parametrize("mode", ["time", "lsh"])
def test_detect_all_writes_seven_outputs(spark, tmp, mode):
    p = Params(input_path=f"{SF_SMALL}/events.parquet", feature="value", ts_col="ts",
               sys_col="user_id", tie_break=("event_id",), knn_mode=mode)
    res = detect_all(spark, p)
    assert tuple(res) == RESULT_NAMES
    from tablewatch.plans.detect import write_results
    paths = write_results(spark, res, tmp, p.cols)
    assert spark.read.parquet(paths["temp_outliers_iqr"]).count() == \
        res["temp_outliers_iqr"].count()
    for name, cols in F6.items():
        back = spark.read.parquet(paths[name])
        assert back.columns == cols, name
    assert set(quicklook(res, p.cols)) >= {"knn_top", "iqr_bounds", "zscore_top"}


def test_knn_exact_equals_brute_force(spark):
    s = zscore(spark.read.parquet(f"{SF_SMALL}/events.parquet"), E.EV)
    got = {r["event_id"]: r["knn_dist"] for r in knn_exact_scores(s, E.EV, 5).collect()}
    pdf = s.select("user_id", "event_id", "z").toPandas()
    for _, g in pdf.groupby("user_id"):
        z = g["z"].to_numpy()
        for i, eid in enumerate(g["event_id"]):
            d = sorted(abs(z[i] - z[j]) for j in range(len(z)) if j != i)[:5]
            want = sum(d) / len(d) if d else None
            assert got[eid] == pytest.approx(want, abs=1e-12)


def test_kmeans_distance_is_to_nearest_centre(spark):
    s = zscore(spark.read.parquet(f"{SF_SMALL}/events.parquet"), E.EV)
    km = kmeans_scores(s, E.EV, k=3)
    assert km.count() == s.count()
    assert km.filter(F.col("km_dist") < 0).count() == 0
    assert {r["cluster"] for r in km.select("cluster").distinct().collect()} <= {0, 1, 2}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_zscore_plan_has_no_window_and_broadcasts_stats(spark):
    plan = _plan(E.queries()["zscore_outliers"](spark, SF_SMALL))
    assert "Window" not in plan and "BroadcastHashJoin" in plan


def test_anomaly_plans_have_no_python_udf(spark):
    for name in ("zscore_outliers", "knn_time_outliers", "knn_lsh_outliers", "iqr_bounds",
                 "knn_exact_outliers"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def _shuffles(df):
    return _plan(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize("name,expected", [
    ("zscore_outliers", 0),          # stats aggregate is checkpointed, joined by broadcast
    ("iqr_outliers_detailed", 0),    # quartiles likewise
    ("knn_time_outliers", 1),        # lead/lag and percent_rank share one partitioning
    ("knn_exact_outliers", 1),
    ("knn_lsh_outliers", 1),         # one grid for systems of every size
])
def test_row_shuffles_per_plan(spark, name, expected):
    assert _shuffles(E.queries()[name](spark, SF_SMALL)) == expected


def test_topk_is_take_ordered(spark):
    plan = _plan(E.queries()["suspects_topk"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def _lloyd(f, k):
    """Plain Lloyd iteration from the quantile starts of the operator."""
    import math
    f = sorted(f)
    centers = sorted({round(f[max(1, math.ceil((2 * i + 1) / (2 * k) * len(f))) - 1], 9) for i in range(k)})
    for _ in range(50):
        parts = {}
        for x in f:
            d = [(x - c) ** 2 for c in centers]
            parts.setdefault(d.index(min(d)), []).append(x)
        new = sorted({round(sum(parts[i]) / len(parts[i]), 9) if i in parts else c for i, c in enumerate(centers)})
        if new == centers:
            break
        centers = new
    return centers


@pytest.mark.parametrize("k,parts", [(2, 1), (2, 5), (4, 3)])
def test_kmeans_equals_plain_lloyd_however_partitioned(spark, k, parts):
    import statistics
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(parts)
    s = zscore(ev, E.EV)
    z = {r["event_id"]: r["z"] for r in s.collect()}
    mean, std = statistics.fmean(z.values()), statistics.stdev(z.values())
    f = {i: (v - mean) / std for i, v in z.items()}
    centers = _lloyd(f.values(), k)
    for r in kmeans_scores(s, E.EV, k=k).collect():
        d = [abs(f[r["event_id"]] - c) for c in centers]
        assert r["km_dist"] == pytest.approx(min(d), abs=1e-6)
        assert d[r["cluster"]] == pytest.approx(min(d), abs=1e-6)


def test_command_line_job(tmp):
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=root, PRINT_LIMIT="2", KNN_MODE="lsh",
               MAX_GROUP_ROWS="65")
    out = subprocess.run(
        [sys.executable, "-m", "tablewatch.plans.detect", "-i", f"{SF_SMALL}/events.parquet",
         "-f", "value", "--timestamp-col", "ts", "--system-col", "user_id",
         "--tie-break", "event_id", "-o", f"{tmp}/preds"],
        env=env, capture_output=True, text=True, timeout=600, cwd=tmp)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "1000 rows in 15 systems" in out.stdout and "kmeans_top" in out.stdout
    assert sorted(os.listdir(f"{tmp}/preds")) == sorted(RESULT_NAMES)


def test_split_plan_has_one_window(spark):
    """Copies near the range borders feed the same window as the rows: one
    (system, range) exchange, one sort and one Window."""
    s, sizes = E._scored_sizes(spark, SF_SMALL, "lineitem", E.LR, E.SPLIT_HOT)
    from tablewatch.params import Scale
    scale = Scale(split_rows=500, max_splits=64)
    df = knn_time_scores(s, E.LR, 5, scale, sizes)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = final.splitlines()
    assert "isFinalPlan=true" in final
    assert sum("+- Window " in ln or "- Window [" in ln for ln in lines) == 1
    assert len([ln for ln in lines if "Exchange hashpartitioning" in ln and "_tw_split" in ln]) == 1


def test_ingest_then_sql_then_detect(spark, tmp):
    """Folder -> table -> SQL -> anomaly job, end to end on derived data."""
    from tablewatch.plans.catalog import run_sql
    from tablewatch.sources.derived import write_folders
    from tablewatch.sources.ingest import register_folders
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    write_folders({"Stats_Table": ev}, f"{tmp}/data")
    summary = register_folders(spark, f"{tmp}/data", "nyc_e2e").first()
    assert summary["table"] == "stats_table" and summary["n_rows"] == ev.count()
    busy = run_sql(spark, "SELECT user_id FROM stats_table GROUP BY user_id "
                          "HAVING count(*) >= 20", "nyc_e2e").count()
    assert busy > 0
    p = Params(feature="value", ts_col="ts", sys_col="user_id", tie_break=("event_id",))
    res = detect_all(spark, p, spark.table("nyc_e2e.stats_table"))
    direct = detect_all(spark, p, ev)
    for name in ("temp_outliers_zscore", "iqr_bounds", "temp_outliers_knn"):
        assert res[name].count() == direct[name].count()


def test_shuffle_join_fallback_matches_broadcast(spark):
    """Beyond the measured broadcast limit the stats join is a shuffle join
    (null-safe); results must not change."""
    from tablewatch.params import Scale
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    no_bc = Scale(broadcast_bytes=0)
    a = {r["event_id"]: (r["z"], r["n"]) for r in zscore(ev, E.EV).collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # no planner broadcast either
    try:
        df = zscore(ev, E.EV, no_bc)
        assert "BroadcastHashJoin" not in _plan(df.select("z"))
        b = {r["event_id"]: (r["z"], r["n"]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a.keys() == b.keys()
    assert all(a[k][1] == b[k][1] and abs(a[k][0] - b[k][0]) < 1e-12 for k in a)


@pytest.mark.parametrize("mode", ["time", "exact", "lsh"])
def test_detect_all_on_awkward_input(spark, mode):
    """NULL system, NaN and NULL features, a one-row system, a constant
    system, string timestamps with junk: every output still computes."""
    rows = []
    for i in range(40):
        rows.append(("busy", f"2024-01-01 00:{i:02d}:00", float(i % 9) if i != 7 else None, i))
    rows += [("const", f"2024-01-02 00:{i:02d}:00", 5.0, 100 + i) for i in range(25)]
    rows += [("one", "2024-01-03 00:00:00", 1.0, 200), (None, "2024-01-04 00:00:00", 2.0, 201),
             (None, "junk", 3.0, 202), ("busy", "2024-01-05 00:00:00", float("nan"), 203)]
    df = spark.createDataFrame(rows, "system_id string, timestamp string, temperature double, rid long")
    p = Params(tie_break=("rid",), knn_mode=mode, max_group_rows=30, nan_as_null=True)
    res = detect_all(spark, p, df)
    counts = {k: v.count() for k, v in res.items()}
    assert df.count() == 69
    assert counts["iqr_bounds"] == 4          # busy, const, one and the NULL system
    assert counts["temp_suspects_topk"] == 50
