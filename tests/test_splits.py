"""The range-split (hot group) plans must equal the single-window plans."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewatch.operators import neighbor_diffs, percent_rank_at_least
from tablewatch.params import Scale

SPLIT = Scale(split_rows=15, max_splits=16)
NO_SPLIT = Scale(split_rows=10**9)


def data(spark, seed, n_groups=3, n=120, ties=False, nulls=False):
    rnd = random.Random(seed)
    rows = []
    rid = 0
    for g in range(n_groups):
        size = n if g == 0 else rnd.randint(1, 40)    # one hot group, some small
        for i in range(size):
            v = float(rnd.randint(0, 10)) if ties else rnd.gauss(0, 1)
            if nulls and rnd.random() < 0.05:
                v = None
            rows.append((f"g{g}" if g < n_groups - 1 or not nulls else None, rnd.randint(0, 50),
                         rid, v))
            rid += 1
    return spark.createDataFrame(rows, "g string, t int, rid long, v double")


@pytest.mark.parametrize("seed,ties,nulls", [(1, False, False), (2, True, False), (3, True, True)])
def test_neighbor_diffs_split_equals_plain(spark, seed, ties, nulls):
    df = data(spark, seed, ties=ties, nulls=nulls)
    a = neighbor_diffs(df, ["g"], ["t", "rid"], "v", 3, "d", NO_SPLIT)
    b = neighbor_diffs(df, ["g"], ["t", "rid"], "v", 3, "d", SPLIT)
    got = {r["rid"]: r["d"] for r in b.collect()}
    want = {r["rid"]: r["d"] for r in a.collect()}
    assert got == want


def test_neighbor_diffs_by_value_order(spark):
    df = data(spark, 7, ties=True)
    a = neighbor_diffs(df, ["g"], ["v", "rid"], "v", 2, "d", NO_SPLIT)
    b = neighbor_diffs(df, ["g"], ["v", "rid"], "v", 2, "d", SPLIT)
    assert sorted(map(tuple, a.select("rid", "d").collect())) == \
        sorted(map(tuple, b.select("rid", "d").collect()))


@pytest.mark.parametrize("cutoff", [0.0, 0.3, 0.75, 0.99, 1.0])
@pytest.mark.parametrize("ties,nulls", [(False, False), (True, False), (True, True)])
def test_percent_rank_split_equals_window(spark, cutoff, ties, nulls):
    df = data(spark, 11, ties=ties, nulls=nulls)
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first())
    want = {r["rid"]: r["pr"] for r in
            df.withColumn("pr", F.percent_rank().over(w)).filter(F.col("pr") >= cutoff).collect()}
    got = {r["rid"]: r["pr"] for r in
           percent_rank_at_least(df, ["g"], "v", cutoff, "pr", SPLIT).collect()}
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


@pytest.mark.parametrize("ties,accuracy", [(False, 10_000), (True, 10_000), (True, 50),
                                           (False, 50)])
def test_radix_quantiles_equal_percentile_disc(spark, ties, accuracy):
    from tablewatch.operators.quantiles import radix_quantiles
    df = data(spark, 21, n_groups=4, n=300, ties=ties, nulls=True)
    scale = Scale(split_rows=25, max_splits=16, quantile_accuracy=accuracy)
    got = {r["g"]: (r["q1"], r["q3"]) for r in
           radix_quantiles(df, ["g"], "v", [0.25, 0.75], ["q1", "q3"], scale).collect()}
    want = {r["g"]: (r["q1"], r["q3"]) for r in df.groupBy("g").agg(
        F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY v)").alias("q1"),
        F.expr("percentile_disc(0.75) WITHIN GROUP (ORDER BY v)").alias("q3")).collect()}
    assert got == want


@pytest.mark.parametrize("cutoff", [0.5, 0.9, 0.99])
def test_percent_rank_exact_when_sampled_threshold_misses(spark, monkeypatch, cutoff):
    """Zero margin and a tiny sample make thresholds land above the cut; the
    check must catch it and rank those groups over all rows."""
    from tablewatch.operators import splits
    monkeypatch.setattr(splits, "_margin", lambda p, scale: 0.0)
    df = data(spark, 31, n_groups=4, n=200, ties=True)
    scale = Scale(split_rows=15, max_splits=16, sample_rows=5, quantile_accuracy=100)
    w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first())
    want = {r["rid"]: r["pr"] for r in
            df.withColumn("pr", F.percent_rank().over(w)).filter(F.col("pr") >= cutoff).collect()}
    got = {r["rid"]: r["pr"] for r in
           splits.percent_rank_at_least(df, ["g"], "v", cutoff, "pr", scale).collect()}
    assert set(got) == set(want)


def test_radix_quantiles_refine_every_digit(spark):
    """Open buckets of a single value only: all four digits are counted."""
    from tablewatch.operators.quantiles import radix_quantiles
    rows = [("a", 1.0 + k * 2.0 ** -50) for k in range(40)] + [("a", -5e-324), ("a", float("nan")), ("b", None), ("b", None),
            (None, 3.0), (None, float("-inf")), ("c", -0.0), ("c", 0.0), ("d", 1e308), ("d", -1e308), ("d", 1e-310)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {tuple(r) for r in radix_quantiles(df, ["g"], "v", [0.25, 0.5, 1.0], ["a", "m", "z"], Scale(split_rows=1))
           .selectExpr("g", "string(a)", "string(m)", "string(z)").collect()}
    want = {tuple(r) for r in df.groupBy("g").agg(*[
        F.expr(f"string(percentile_disc({p}) WITHIN GROUP (ORDER BY v))") for p in (0.25, 0.5, 1.0)]).collect()}
    assert {tuple("0.0" if x == "-0.0" else x for x in r) for r in got} == \
        {tuple("0.0" if x == "-0.0" else x for x in r) for r in want}


def test_order_bits_sort_as_doubles(spark):
    import struct
    from tablewatch.operators.quantiles import order_bits
    rnd = random.Random(4)
    xs = [struct.unpack("d", struct.pack("Q", rnd.getrandbits(64)))[0] for _ in range(500)]
    xs = [x for x in xs if x == x] + [0.0, 1.0, -1.0, 5e-324, -5e-324, 1e308, float("inf"), float("-inf")]
    got = [r["v"] for r in spark.createDataFrame([(x,) for x in set(xs)], "v double").orderBy(order_bits(F.col("v"))).collect()]
    assert got == sorted(set(xs))


def test_neighbor_diffs_with_sampled_bounds(spark):
    df = data(spark, 51, n=400)
    scale = Scale(split_rows=30, max_splits=32, sample_rows=5)
    a = neighbor_diffs(df, ["g"], ["t", "rid"], "v", 3, "d", NO_SPLIT)
    b = neighbor_diffs(df, ["g"], ["t", "rid"], "v", 3, "d", scale)
    assert {r["rid"]: r["d"] for r in a.collect()} == {r["rid"]: r["d"] for r in b.collect()}


def test_approx_quartiles_big_groups_are_exact(spark):
    from tablewatch.operators.iqr import quartiles
    from tablewatch.params import Cols
    df = data(spark, 61, n_groups=3, n=200, nulls=True)
    c = Cols("g", "t", "v")
    got = {r["g"]: (r["q1"], r["q3"]) for r in
           quartiles(df, c, scale=Scale(split_rows=50)).collect()}
    want = {r["g"]: (r["q1"], r["q3"]) for r in df.groupBy("g").agg(
        F.expr("percentile_disc(0.25) WITHIN GROUP (ORDER BY v)").alias("q1"),
        F.expr("percentile_disc(0.75) WITHIN GROUP (ORDER BY v)").alias("q3")).collect()}
    assert got == want


def test_range_index_binary_search(spark):
    from tablewatch.operators.splits import with_range_index
    import random
    rnd = random.Random(3)
    bounds = sorted(rnd.choice([rnd.uniform(-5, 5), 1.0]) for _ in range(100))
    keys = [rnd.uniform(-6, 6) for _ in range(200)] + [1.0, bounds[0], bounds[-1], None]
    df = spark.createDataFrame([(k,) for k in keys], "k double").withColumn(
        "b", F.array(*[F.lit(b) for b in bounds]))
    want = [0 if k is None else sum(b <= k for b in bounds) for k in keys]
    got = [r["i"] for r in with_range_index(df, F.col("b"), F.col("k"), 100, "i").collect()]
    assert got == want
    for short in (1, 3, 7):   # short arrays: fewer steps, same answer
        b2 = bounds[:short]
        d2 = df.withColumn("b", F.array(*[F.lit(b) for b in b2]))
        w2 = [0 if k is None else sum(b <= k for b in b2) for k in keys]
        assert [r["i"] for r in with_range_index(d2, F.col("b"), F.col("k"), short, "i")
                .collect()] == w2


def test_constant_hot_group_splits_evenly(spark):
    """A hot group that is constant in its first order column still splits
    (boundaries use the whole order key) and gives the single-window answer."""
    from tablewatch.operators.splits import range_splits, group_sizes
    rows = ([("hot", 0.0, i, float(i % 7)) for i in range(600)]
            + [("cold", float(i), i + 1000, float(i)) for i in range(20)])
    df = spark.createDataFrame(rows, "g string, z double, rid long, v double")
    scale = Scale(split_rows=50, max_splits=64)
    sdf, split = range_splits(df, ["g"], ["z", "rid"], group_sizes(df, ["g"], scale), scale)
    assert split
    per = [r["c"] for r in sdf.filter("g = 'hot'").groupBy("_tw_split").count()
           .withColumnRenamed("count", "c").collect()]
    assert len(per) >= 8 and max(per) <= 3 * 600 / len(per)
    a = neighbor_diffs(df, ["g"], ["z", "rid"], "v", 3, "d", NO_SPLIT)
    b = neighbor_diffs(df, ["g"], ["z", "rid"], "v", 3, "d", scale)
    assert {r["rid"]: r["d"] for r in a.collect()} == {r["rid"]: r["d"] for r in b.collect()}


def test_percent_rank_property_random(spark):
    """Hypothesis: random group sizes, value ranges (ties), NULLs, cutoffs and
    split sizes; the split plan always equals Spark's percent_rank window."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None,
              suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(sizes=st.lists(st.integers(1, 120), min_size=1, max_size=3),
           span=st.integers(1, 50), cutoff=st.sampled_from([0.0, 0.5, 0.9, 0.99]),
           split=st.integers(5, 40), seed=st.integers(0, 10_000))
    def check(sizes, span, cutoff, split, seed):
        rnd = random.Random(seed)
        rows, rid = [], 0
        for g, n in enumerate(sizes):
            for _ in range(n):
                v = None if rnd.random() < 0.05 else float(rnd.randint(0, span))
                rows.append((f"g{g}", rid, v))
                rid += 1
        df = spark.createDataFrame(rows, "g string, rid long, v double")
        w = Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first())
        want = {r["rid"] for r in df.withColumn("pr", F.percent_rank().over(w))
                .filter(F.col("pr") >= cutoff).collect()}
        scale = Scale(split_rows=split, max_splits=16, sample_rows=max(3, split // 2))
        got = {r["rid"] for r in percent_rank_at_least(df, ["g"], "v", cutoff, "pr", scale)
               .collect()}
        assert got == want

    check()


def test_neighbor_diffs_property_random(spark):
    """Hypothesis: random sizes, k, tie density and split size; the split
    neighbour window always equals the single window."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None,
              suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(sizes=st.lists(st.integers(1, 150), min_size=1, max_size=3),
           k=st.integers(1, 4), span=st.integers(1, 30), split=st.integers(4, 40),
           seed=st.integers(0, 10_000))
    def check(sizes, k, span, split, seed):
        rnd = random.Random(seed)
        rows, rid = [], 0
        for g, n in enumerate(sizes):
            for _ in range(n):
                rows.append((f"g{g}", rnd.randint(0, span), rid, rnd.random()))
                rid += 1
        df = spark.createDataFrame(rows, "g string, t int, rid long, v double")
        a = neighbor_diffs(df, ["g"], ["t", "rid"], "v", k, "d", NO_SPLIT)
        b = neighbor_diffs(df, ["g"], ["t", "rid"], "v", k, "d",
                           Scale(split_rows=split, max_splits=32))
        assert {r["rid"]: r["d"] for r in a.collect()} == {r["rid"]: r["d"] for r in b.collect()}

    check()


def test_radix_quantiles_property_random(spark):
    """Hypothesis: random sizes, tie density, NULLs, probabilities and sample
    sizes (small ones make brackets miss); always equal to percentile_disc."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st
    from tablewatch.operators.quantiles import radix_quantiles

    @settings(max_examples=6, deadline=None,
              suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(sizes=st.lists(st.integers(1, 120), min_size=1, max_size=3),
           span=st.integers(1, 60), p=st.sampled_from([0.01, 0.25, 0.5, 0.75, 0.99]),
           sample=st.integers(2, 200), seed=st.integers(0, 10_000))
    def check(sizes, span, p, sample, seed):
        rnd = random.Random(seed)
        rows = [(f"g{g}", None if rnd.random() < 0.05 else float(rnd.randint(0, span)))
                for g, n in enumerate(sizes) for _ in range(n)]
        df = spark.createDataFrame(rows, "g string, v double")
        scale = Scale(split_rows=20, max_splits=16, sample_rows=sample)
        got = {r["g"]: r["q"] for r in radix_quantiles(df, ["g"], "v", [p], ["q"], scale).collect()}
        want = {r["g"]: r["q"] for r in df.groupBy("g").agg(
            F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY v)").alias("q")).collect()
            if r["q"] is not None}
        assert got == want

    check()


@pytest.mark.parametrize("groups", [["a", "b"], ["a", "b", "few"]])
def test_rank_cut_scores_rows_once(spark, groups):
    """Big and small groups are ranked from one kept copy of the scored rows."""
    from tablewatch.operators.splits import neighbor_diffs, percent_rank_at_least
    from tablewatch.params import Scale
    rows = [(g, i, float((i * 7919) % 1009)) for g in groups for i in range(8 if g == "few" else 400)]
    df = spark.createDataFrame(rows, "g string, i long, v double")
    scale = Scale(split_rows=50, max_splits=8)
    scored = neighbor_diffs(df, ["g"], ["i"], "v", 1, "near", scale).withColumn("key", F.get("near", F.lit(1)))
    got = percent_rank_at_least(scored.drop("near"), ["g"], "key", 0.9, "pr", scale)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "lag(" not in plan and ("LeftAnti" in plan) == ("few" in groups)
    w = Window.partitionBy("g")
    want = df.withColumn("key", F.abs(F.col("v") - F.lag("v").over(w.orderBy("i")))) \
        .withColumn("pr", F.percent_rank().over(w.orderBy("key"))).filter("pr >= 0.9")
    assert got.columns == ["g", "i", "v", "key", "pr"]
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
