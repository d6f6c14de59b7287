"""Skew-safe per-group windows and quantiles.

The reference computes every per-system statistic with a window partitioned
by the system alone, so one system holding a third of all rows becomes one
task.  The helpers here keep exact results while cutting such a group into
ordered ranges:

* ``neighbor_diffs``: |v - lead/lag(v, 1..k)| in a given order.  Rows of a big
  group get a range index (binary search over boundaries taken from a sorted
  sample of the whole order key).  Rows near a boundary are copied into the
  neighbouring range (a halo that holds k rows at least), one window runs per
  (group, range), and the copies are dropped after it.
* ``percent_rank_at_least``: ``percent_rank() >= cutoff`` per group.  Small
  groups use the plain window.  For a big group the rank of a row is the
  count of smaller values: a threshold from a bounded sample discards rows
  below the cut, the survivors are ranked by distinct value (split into
  ranges with running offsets), and a threshold that was too high is
  detected from exact counts and the group re-ranked over all its rows.

Sketches only ever see bounded samples, so no reducer merges one partial
sketch per map task.  Groups up to ``Scale.split_rows`` rows take the
single-window plan, which is exactly the plan the reference runs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident
from tablewatch.operators.joins import attach_small, materialize, materialize_observed
from tablewatch.session import scratch_path
from tablewatch.params import Scale

N = "_tw_n"
SPLIT = "_tw_split"
HALO = "_tw_halo"
OWN = "_tw_own"
FROM, TO = "_tw_from", "_tw_to"
BOUNDS = "_tw_bounds"


def _c(name: str) -> Column:
    return F.col(quote_ident(name))


@dataclass(frozen=True)
class Sizes:
    """Rows per group (``df``: part..., _tw_n, checkpointed) with the summary
    the plans branch on, observed while the table was written."""

    df: DataFrame
    groups: int
    big: int
    max_big: int
    split_rows: int

    def filter(self, cond: Column) -> DataFrame:
        return self.df.filter(cond)


def _observe_sizes(table: DataFrame, scale: Scale) -> Sizes:
    n = F.col(N)
    df, m = materialize_observed(table, groups=F.count(F.lit(1)),
                                 big=F.count_if(n > scale.split_rows),
                                 max_big=F.max(F.when(n > scale.split_rows, n)))
    return Sizes(df, int(m["groups"] or 0), int(m["big"] or 0), int(m["max_big"] or 0),
                 scale.split_rows)


def group_sizes(df: DataFrame, part: list[str], scale: Scale = Scale()) -> Sizes:
    """Row count per group; partial counts are combined map-side."""
    return _observe_sizes(df.groupBy(*[_c(p) for p in part]).agg(F.count(F.lit(1)).alias(N)),
                          scale)


def as_sizes(sizes, scale: Scale) -> Sizes:
    """Accept a ``Sizes`` or a (part..., _tw_n) frame."""
    if isinstance(sizes, Sizes):
        if sizes.split_rows == scale.split_rows:
            return sizes
        sizes = sizes.df
    return _observe_sizes(sizes, scale)


def _sizes_df(sizes) -> DataFrame:
    return sizes.df if isinstance(sizes, Sizes) else sizes


def _big_groups(sizes, scale: Scale) -> tuple[DataFrame, int, int]:
    s = as_sizes(sizes, scale)
    return s.df.filter(F.col(N) > scale.split_rows), s.big, s.max_big


def sample_quantiles(df: DataFrame, part: list[str], key: str, fractions: list[float],
                     sizes: DataFrame, per_group: Column, accuracy: int, out: str,
                     scale: Scale = Scale(), seed: int = 17,
                     n_groups: int | None = None) -> DataFrame:
    """Per-group quantiles of ``key`` estimated from a Bernoulli sample of
    about ``per_group`` rows (an expression of the group size ``_tw_n``;
    groups no larger than that are taken whole).  ``sizes`` (part..., _tw_n)
    restricts the groups.  A quantile sketch over every row of a hot group
    would make one reducer merge a partial sketch from every map task; the
    sample keeps that merge to ``per_group`` rows.  Sampling only positions
    the quantiles; callers check whatever correctness depends on."""
    rows = attach_small(df.select(*[_c(p) for p in part], _c(key)), sizes, part, "inner",
                        scale=scale, n_rows=n_groups)
    frac = F.least(F.lit(1.0), per_group / F.col(N))
    sample = rows.filter((frac >= 1.0) | (F.rand(seed) < frac))
    return sample.groupBy(*[_c(p) for p in part]).agg(
        F.first(N).alias(N), F.percentile_approx(_c(key), fractions, accuracy).alias(out))


PER_RANGE = 256  # sampled rows of a range


def range_splits(df: DataFrame, part: list[str], keys, sizes, scale: Scale, seed: int = 23,
                 halo: int = 0) -> tuple[DataFrame, bool]:
    """Add ``_tw_split`` (range index in the order of ``keys``, 0 for small
    groups).  Returns (frame, any_group_split).

    Boundaries are values of the whole order key (a struct of the columns),
    regular members of a sorted per-group sample of ``PER_RANGE`` rows a
    range.  With a unique order key no two rows tie, so even a group that is
    constant in its first order column splits evenly; rows with equal keys
    always share a range.  NULLs sort first, as in the windows.

    ``halo``: a row less than that many rows away from a boundary (and some
    around it) is also copied into the neighbouring range, with ``_tw_halo``
    true.  How far a range reaches beyond a boundary is read off the sample:
    the stretch between the boundary and the ``halo``-th sampled row before or
    after it holds at least that many rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    big, g, max_n = _big_groups(sizes, scale)
    if g == 0:
        return df.withColumns({SPLIT: F.lit(0), HALO: F.lit(False)}), False
    m = max(2, min(scale.max_splits, math.ceil(max_n / scale.split_rows)))
    key = F.struct(*[_c(k) for k in keys])
    rows = attach_small(df.select(*[_c(p) for p in part], key.alias("_tw_key")), big, part,
                        "inner", scale=scale, n_rows=g)
    want = F.least(F.lit(m), F.ceil(F.col(N) / F.lit(scale.split_rows))).cast("int")
    frac = F.least(F.lit(1.0), F.lit(PER_RANGE) * want / F.col(N))
    sample = rows.filter((frac >= 1.0) | (F.rand(seed) < frac))
    # Distinct keys, so that members of the sample count rows strictly before.
    srt = sample.groupBy(*[_c(p) for p in part]).agg(
        F.array_sort(F.collect_set("_tw_key")).alias("_tw_s"), F.first(want).alias("_tw_w"))
    # Every range holds as many sampled rows as the halo at least, so a halo
    # ends inside the next range.
    n_s = F.size("_tw_s")
    w = F.greatest(F.lit(1), F.least(F.col("_tw_w"), F.floor(n_s / max(halo, 1)).cast("int")))
    srt = srt.select(*[_c(p) for p in part], "_tw_s", n_s.alias("_tw_ns"), w.alias("_tw_w")).filter("_tw_w > 1")
    at = F.transform(F.sequence(F.lit(1), F.col("_tw_w") - 1), lambda j: F.floor(j * F.col("_tw_ns") / F.col("_tw_w")).cast("int") + 1)

    def member(i):
        return F.when((i >= 1) & (i <= F.col("_tw_ns")), F.get("_tw_s", i - 1))

    bounds, m_obs = materialize_observed(
        srt.withColumn("_tw_i", at).select(
            *[_c(p) for p in part], F.transform("_tw_i", member).alias(BOUNDS),
            # NULL: too few sampled rows on that side, all of them are near.
            F.transform("_tw_i", lambda i: member(i - halo)).alias(FROM),
            F.transform("_tw_i", lambda i: member(i + halo - 1)).alias(TO)),
        total=F.sum(F.size(BOUNDS)))
    total = m_obs["total"] or 0
    side = bounds if halo else bounds.select(*[_c(p) for p in part], BOUNDS)
    with_b = attach_small(df, side, part, "left", scale=scale, n_rows=g,
                          row_bytes=64 + (3 if halo else 1) * (24 * len(keys) + 16) * (int(total) // max(g, 1) + 1))
    out = with_range_index(with_b, F.col(BOUNDS), key, m - 1, OWN)
    if not halo:
        return out.withColumnRenamed(OWN, SPLIT).withColumn(HALO, F.lit(False)).drop(BOUNDS), True
    own, cuts = F.col(OWN), F.coalesce(F.size(BOUNDS), F.lit(0))
    after = F.when((own < cuts) & F.coalesce(F.get(FROM, own) <= key, F.lit(True)), 1).otherwise(0)
    before = F.when((own > 0) & F.coalesce(F.get(TO, own - 1) >= key, F.lit(True)), 1).otherwise(0)
    out = out.select(*[_c(c) for c in df.columns], OWN, F.explode(F.sequence(own - before, own + after)).alias(SPLIT))
    return out.withColumn(HALO, F.col(SPLIT) != own).drop(OWN), True


def with_range_index(df: DataFrame, bounds: Column, key: Column, max_len: int,
                     out: str) -> DataFrame:
    """Add ``out`` = number of entries of the ascending array ``bounds``
    (at most ``max_len`` long) that are <= key; 0 for a NULL key or NULL
    bounds.  A binary search unrolled into one projection per step
    (log2 steps), each step plain column arithmetic and ``element_at``, so it
    stays inside whole-stage code generation; a higher-order-function
    version is interpreted row by row and several times slower."""
    steps = max(1, math.ceil(math.log2(max_len + 1)))
    lo_c, hi_c = "_tw_lo", "_tw_hi"
    df = df.withColumns({lo_c: F.lit(0), hi_c: F.coalesce(F.size(bounds), F.lit(0))})
    for _ in range(steps):
        lo, hi = F.col(lo_c), F.col(hi_c)
        mid = ((lo + hi + 1) / 2).cast("int")
        fits = (lo < hi) & F.coalesce(
            F.element_at(bounds, F.greatest(mid, F.lit(1))) <= key, F.lit(False))
        df = df.withColumns({lo_c: F.when(fits, mid).otherwise(lo),
                             hi_c: F.when(fits | (lo >= hi), hi).otherwise(mid - 1)})
    return df.withColumnRenamed(lo_c, out).drop(hi_c)


def _margin(p: float, scale: Scale) -> float:
    """Rank slack around a sampled quantile: sketch error plus 8 standard
    deviations of the sample quantile's rank."""
    return 3.0 / scale.quantile_accuracy + 8.0 * math.sqrt(max(p * (1 - p), 1e-4)
                                                           / scale.sample_rows)


def neighbor_diffs(df: DataFrame, part: list[str], order: list[str], value: str, k: int,
                   out: str, scale: Scale, sizes=None,
                   same: str | None = None) -> DataFrame:
    """Add ``out`` = array(|v - lead(v, i)| for i in 1..k, |v - lag(v, i)| for
    i in 1..k), neighbours taken within ``part`` in ``order`` (NULL where
    absent), exactly as one window per group would, without one task per
    group.  ``same``: a neighbour only counts when it has the same value in
    this column (used for grid cells that are contiguous in ``order``)."""
    if sizes is None:
        sizes = group_sizes(df, part, scale)
    sdf, _ = range_splits(df, part, order, sizes, scale, halo=k)
    v = _c(value)
    w = Window.partitionBy(*[_c(p) for p in part], F.col(SPLIT)).orderBy(*[_c(o) for o in order])
    near = [(F.lead(v, i).over(w), F.lead(_c(same), i).over(w) if same else None) for i in range(1, k + 1)]
    near += [(F.lag(v, i).over(w), F.lag(_c(same), i).over(w) if same else None) for i in range(1, k + 1)]
    diffs = F.array(*[F.abs(v - nv) if same is None else F.when(ns == _c(same), F.abs(v - nv)) for nv, ns in near])
    return sdf.withColumn(out, diffs).filter(~F.col(HALO)).drop(SPLIT, HALO)


def _plain_percent_rank(df: DataFrame, part: list[str], key: str, cutoff: float,
                        out: str) -> DataFrame:
    w = Window.partitionBy(*[_c(p) for p in part]).orderBy(_c(key).asc_nulls_first())
    return df.withColumn(out, F.percent_rank().over(w)).filter(F.col(out) >= F.lit(cutoff))


def percent_rank_at_least(df: DataFrame, part: list[str], key: str, cutoff: float, out: str,
                          scale: Scale, sizes=None) -> DataFrame:
    """Rows whose ``percent_rank()`` over (partition by part order by key asc
    nulls first) is >= cutoff, with that rank in ``out``."""
    if sizes is None:
        sizes = group_sizes(df, part, scale)
    sizes = as_sizes(sizes, scale)
    big, g, _ = _big_groups(sizes, scale)
    if g == 0:
        return _plain_percent_rank(df, part, key, cutoff, out)
    # The split plan reads the rows several times and the plain window once
    # more: they are computed once and kept as Parquet in the shared scratch
    # folder.
    path = scratch_path(df.sparkSession, "ranked")
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    big_rows = attach_small(kept, big, part, "inner", scale=scale, n_rows=g)

    frac = cutoff - _margin(cutoff, scale)
    thresholds = None
    if frac > 0:
        thresholds = materialize(sample_quantiles(
            big_rows, part, key, [frac], big, F.lit(scale.sample_rows),
            scale.quantile_accuracy, "_tw_t", scale, n_groups=g).select(
                *part, F.element_at("_tw_t", 1).alias("_tw_t")))
    ranked_big, missed = _rank_candidates(big_rows, part, key, cutoff, out, scale, thresholds, g)
    if missed is not None:
        # A sampled threshold that landed above the cut (checked, not
        # assumed): rank those groups over all their rows.
        redo_rows = attach_small(big_rows, missed, part, "left_semi", scale=scale)
        redo, _ = _rank_candidates(redo_rows, part, key, cutoff, out, scale, None, g)
        ranked_big = attach_small(ranked_big, missed, part, "left_anti", scale=scale).unionByName(
            redo)
    ranked_big = ranked_big.select(*[_c(c) for c in [*df.columns, out]])
    if g == sizes.groups:
        return ranked_big
    small_rows = attach_small(kept, big.select(*[_c(p) for p in part]), part, "left_anti", scale=scale, n_rows=g)
    return _plain_percent_rank(small_rows, part, key, cutoff, out).unionByName(ranked_big)


def _rank_candidates(big_rows: DataFrame, part: list[str], key: str, cutoff: float, out: str,
                     scale: Scale, thresholds: DataFrame | None,
                     g: int) -> tuple[DataFrame, DataFrame | None]:
    """Rank the rows at or above a per-group threshold (all rows without
    one).  ``big_rows`` carries the group size ``_tw_n``.  Returns the ranked
    rows and the groups whose threshold was too high (None when there are
    none).  Counts needed for the decisions are observed while the small
    tables are written, so they cost no extra pass."""
    C, NC, BELOW = "_tw_c", "_tw_ncand", "_tw_below"
    cand = big_rows
    if thresholds is not None:
        with_t = attach_small(big_rows, thresholds, part, "left", scale=scale, n_rows=g)
        # The survivors (about 1 - cutoff of the rows) are read twice below;
        # keep them rather than rescanning every row.
        cand = materialize(with_t.filter(F.col("_tw_t").isNull() | (_c(key) >= F.col("_tw_t")))
                           .drop("_tw_t"))
    # Ties collapse into one row per distinct value before any ordering.
    dv = materialize(cand.groupBy(*[_c(p) for p in part], _c(key))
                     .agg(F.count(F.lit(1)).alias(C), F.first(N).alias(N)))
    nd = F.col("_tw_nd")
    # The largest excluded row has at most n - ncand - 1 smaller rows; if
    # that could reach the cut, the group's threshold was too high.
    too_high = (F.col(N) - F.col(NC) > 0) & (
        (F.col(N) - F.col(NC) - 1) >= F.lit(cutoff) * (F.col(N) - 1))
    dsizes, dm = materialize_observed(
        dv.groupBy(*[_c(p) for p in part]).agg(F.count(F.lit(1)).alias("_tw_nd"),
                                              F.sum(C).alias(NC), F.first(N).alias(N)),
        groups=F.count(F.lit(1)), big=F.count_if(nd > scale.split_rows),
        max_big=F.max(F.when(nd > scale.split_rows, nd)), missed=F.count_if(too_high))
    dsz = Sizes(dsizes.select(*part, nd.alias(N)), int(dm["groups"] or 0), int(dm["big"] or 0),
                int(dm["max_big"] or 0), scale.split_rows)
    dvs = running_below(dv, part, key, C, BELOW, scale, dsz)
    dvs = attach_small(dvs, dsizes.select(*part, NC), part, "left", scale=scale,
                       n_rows=dsz.groups)
    # Rows below the threshold are all smaller than every candidate.
    below = F.col(BELOW) + F.col(N) - F.col(NC)
    pr = F.when(F.col(N) > 1, below / (F.col(N) - 1)).otherwise(F.lit(0.0))
    kept, km = materialize_observed(
        dvs.select(*[_c(p) for p in part], _c(key), pr.alias(out)).filter(F.col(out) >= cutoff),
        rows=F.count(F.lit(1)))
    ranked = attach_small(cand.drop(N), kept, [*part, key], "inner", scale=scale,
                          n_rows=int(km["rows"]))
    if thresholds is None or (int(dm["missed"] or 0) == 0 and dsz.groups == g):
        return ranked, None
    missed = dsizes.filter(too_high).select(*part)
    # Groups with no candidate at all have no row in dsizes.
    none = attach_small(thresholds.select(*part), dsizes.select(*part), part, "left_anti",
                        scale=scale, n_rows=dsz.groups)
    return ranked, materialize(missed.unionByName(none))


def running_below(dv: DataFrame, part: list[str], key: str, count_col: str, out: str,
                  scale: Scale, sizes=None) -> DataFrame:
    """On a table of distinct (part, key) with row counts, add ``out`` = the
    number of rows of the group with a strictly smaller key (NULL keys sort
    first).  Big groups are split into key ranges; each range adds the totals
    of the ranges before it (a running sum over at most max_splits rows)."""
    if sizes is None:
        sizes = group_sizes(dv, part, scale)
    dvs, split = range_splits(dv, part, [key], sizes, scale)
    w = (Window.partitionBy(*[_c(p) for p in part], F.col(SPLIT))
         .orderBy(_c(key).asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, -1))
    dvs = dvs.withColumn(out, F.coalesce(F.sum(count_col).over(w), F.lit(0)))
    if split:
        per = dvs.groupBy(*[_c(p) for p in part], F.col(SPLIT)).agg(
            F.sum(count_col).alias("_tw_sc"))
        wo = (Window.partitionBy(*[_c(p) for p in part]).orderBy(SPLIT)
              .rowsBetween(Window.unboundedPreceding, -1))
        offsets, om = materialize_observed(
            per.select(*[_c(p) for p in part], F.col(SPLIT),
                       F.coalesce(F.sum("_tw_sc").over(wo), F.lit(0)).alias("_tw_off")),
            rows=F.count(F.lit(1)))
        dvs = attach_small(dvs, offsets, [*part, SPLIT], "left", scale=scale,
                           n_rows=int(om["rows"]))
        dvs = dvs.withColumn(out, F.col(out) + F.col("_tw_off")).drop("_tw_off")
    return dvs.drop(SPLIT, HALO)
