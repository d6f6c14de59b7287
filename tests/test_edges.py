"""Edge cases of the anomaly operators on hand-made frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tablewatch.operators import (input_profile, iqr_bounds, iqr_outliers_detailed, knn_lsh_scores,
                                  knn_time_scores, prepare, suspects_topk, zscore, zscore_outliers)
from tablewatch.params import Cols

C = Cols("system_id", "timestamp", "temperature", ("rid",))
T0 = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "system_id string, timestamp timestamp, temperature double, rid long")


def ts(i):
    return T0 + dt.timedelta(minutes=i)


def by_rid(df, col):
    return {r["rid"]: r[col] for r in df.collect()}


def test_single_row_and_constant_systems_get_zero(spark):
    rows = [("one", ts(0), 5.0, 0)] + [("const", ts(i), 3.0, 10 + i) for i in range(5)]
    z = by_rid(zscore(frame(spark, rows), C), "z")
    assert all(v == 0.0 for v in z.values())


def test_null_feature_and_null_system(spark):
    rows = [("a", ts(i), float(i), i) for i in range(4)] + [("a", ts(9), None, 9)]
    rows += [(None, ts(20 + i), float(i), 20 + i) for i in range(3)]
    s = zscore(frame(spark, rows), C)
    z = by_rid(s, "z")
    n = by_rid(s, "n")
    assert z[9] is None and n[9] == 5          # NULL x: z NULL, row counted
    assert n[20] == 3 and z[21] == 0.0         # NULL system is one group
    assert input_profile(frame(spark, rows), C).first()["systems"] == 2


def test_nan_poisons_system_unless_nan_as_null(spark):
    rows = [("a", ts(i), float(i), i) for i in range(25)] + [("a", ts(30), float("nan"), 30)]
    raw = zscore(prepare(frame(spark, rows), C), C)
    assert zscore_outliers(raw, C).count() == 26  # NaN > 2 is true in Spark
    clean = zscore(prepare(frame(spark, rows), C, nan_as_null=True), C)
    assert zscore_outliers(clean, C).count() == 0


def test_min_points_boundary(spark):
    for n, expect in ((19, 0), (20, 1), (21, 1)):
        rows = [("a", ts(i), 0.0, i) for i in range(n - 1)] + [("a", ts(n), 100.0, n)]
        got = zscore_outliers(zscore(frame(spark, rows), C), C).count()
        assert got == expect, n


def test_prepare_parses_strings_and_rejects_missing(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00", "1.5"), ("a", "junk", "x")],
                               "system_id string, timestamp string, temperature string")
    out = prepare(df, C).collect()
    assert out[0]["timestamp"] is not None and out[0]["temperature"] == 1.5
    assert out[1]["timestamp"] is None and out[1]["temperature"] is None
    with pytest.raises(ValueError):
        prepare(df.drop("temperature"), C)


def test_prepare_numeric_epochs(spark):
    df = spark.createDataFrame([("a", 1_700_000_000, 1.0)],
                               "system_id string, timestamp long, temperature double")
    assert prepare(df, C).first()["timestamp"].year == 2023
    us = spark.createDataFrame([("a", 1_700_000_000_000_000, 1.0)],
                               "system_id string, timestamp long, temperature double")
    assert prepare(us, C, ts_unit="us").first()["timestamp"].year == 2023


def test_column_name_with_space(spark):
    df = spark.createDataFrame([("a", ts(i), float(i)) for i in range(30)],
                               "`sys id` string, `time stamp` timestamp, `temp c` double")
    c = Cols("sys id", "time stamp", "temp c")
    s = zscore(prepare(df, c), c)
    assert s.count() == 30
    assert iqr_bounds(s, c).count() == 1


def test_knn_time_fewer_than_k_and_single_row(spark):
    rows = [("a", ts(0), 1.0, 0), ("a", ts(1), 2.0, 1), ("b", ts(0), 5.0, 2)]
    s = zscore(frame(spark, rows), C)
    d = by_rid(knn_time_scores(s, C, k=5), "knn_dist")
    assert d[2] is None                         # no neighbour at all
    assert d[0] == pytest.approx(d[1])          # one neighbour each


def test_tied_timestamps_use_tie_break(spark):
    rows = [("a", ts(0), float(v), i) for i, v in enumerate([1, 5, 2, 8, 3])]
    s = zscore(frame(spark, rows), C)
    a = by_rid(knn_time_scores(s, C, k=1), "knn_dist")
    b = by_rid(knn_time_scores(s, C, k=1), "knn_dist")
    assert a == b


def test_lsh_isolated_point_scores_zero(spark):
    rows = [("a", ts(i), 0.0 + i * 0.001, i) for i in range(30)] + [("a", ts(40), 100.0, 40)]
    s = zscore(frame(spark, rows), C)
    d = by_rid(knn_lsh_scores(s, C, k=5), "knn_dist")
    assert d[40] == 0.0
    d2 = by_rid(knn_lsh_scores(s, C, k=5, isolated=None), "knn_dist")
    assert d2[40] is None


def test_iqr_null_system_gets_null_bounds(spark):
    rows = [("a", ts(i), float(i), i) for i in range(10)] + [(None, ts(50), 1.0, 50)]
    b = {r["system_id"]: r for r in iqr_bounds(frame(spark, rows), C).collect()}
    assert b[None]["q1"] is None and b[None]["n"] == 1 and b[None]["n_outliers"] == 0
    assert b["a"]["n"] == 10


def test_iqr_detailed_side_and_distance(spark):
    rows = [("a", ts(i), float(i % 5), i) for i in range(40)] + [("a", ts(99), 50.0, 99)]
    out = iqr_outliers_detailed(frame(spark, rows), C).collect()
    assert len(out) == 1 and out[0]["where"] == "above_high"
    assert out[0]["dist_from_bound"] == pytest.approx(50.0 - out[0]["high"])


def test_topk_is_global_and_ordered(spark):
    rows = [("a", ts(i), float(i), i) for i in range(30)] + [("b", ts(i), float(i * i), 100 + i)
                                                            for i in range(30)]
    top = suspects_topk(zscore(frame(spark, rows), C), C, k=5).collect()
    assert len(top) == 5
    vals = [r["abs_z"] for r in top]
    assert vals == sorted(vals, reverse=True) and not any(math.isnan(v) for v in vals)


def test_required_columns_are_case_sensitive(spark):
    df = spark.createDataFrame([("a", ts(0), 1.0)],
                               "system_id string, timestamp timestamp, Temperature double")
    with pytest.raises(ValueError):
        prepare(df, C)


def test_lsh_z_on_cell_edge_goes_to_upper_cell(spark):
    """floor(z / bucket): a z exactly on an edge belongs to the cell above it
    (deterministic; a random -1 projection could put it below)."""
    from tablewatch.operators import knn_lsh_scores
    # Build scored rows directly with chosen z values.
    rows = [("a", ts(i), 0.0, i, z) for i, z in enumerate([0.2, 0.9, 1.0, 1.05, 1.9])]
    s = spark.createDataFrame(rows, "system_id string, timestamp timestamp, temperature double, "
                                    "rid long, z double")
    d = by_rid(knn_lsh_scores(s, C, k=1), "knn_dist")
    assert d[2] == pytest.approx(0.05)     # z=1.0 sits with 1.05 in cell [1, 2)
    assert d[1] == pytest.approx(0.7)      # z=0.9 only sees 0.2 in cell [0, 1)


def test_kmeans_on_constant_feature(spark):
    """Every system constant: z is 0 everywhere, the global spread is 0, and
    the job still assigns clusters and distances without failing."""
    from tablewatch.operators import kmeans_anomalies, kmeans_scores
    rows = [(f"s{i % 3}", ts(i), 7.0, i) for i in range(60)]
    s = zscore(frame(spark, rows), C)
    km = kmeans_scores(s, C, k=2).collect()
    assert len(km) == 60 and all(r["km_dist"] == 0.0 for r in km)
    # all distances tie: percent_rank 0 everywhere, nothing reaches 0.99
    assert kmeans_anomalies(s, C, k=2).count() == 0
