"""K4-K6: nearest-neighbour distances on the z-score, per system.

* ``knn_time``   neighbours = the k rows before and after in time.
* ``knn_exact``  the k nearest by value.  In one dimension they lie among the
                 k rows before and after in value order, so the same linear
                 window gives the exact answer (no pairwise join).
* ``knn_lsh``    the reference's LSH self-join.  With one feature a bucketed
                 random projection hashes z to floor(+-z / bucket), so two rows
                 collide when they share a grid cell.  The k nearest inside a
                 cell are again the k before/after in value order within the
                 cell, and cells are contiguous in value order: the value-
                 ordered window over the system, counting only neighbours of
                 the same cell, replaces the self-join.  It is linear, so it
                 serves systems of every size; ``max_group_rows`` (off by
                 default) sends larger systems to ``knn_time``, the switch
                 that guards a pairwise join.

Every window goes through ``neighbor_diffs`` (hot groups are split into
ranges) and every cut through ``percent_rank_at_least``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.exprs import mean_k_smallest, quote_ident, rank_key
from tablewatch.operators.joins import attach_small
from tablewatch.operators.splits import (N, _sizes_df, group_sizes, neighbor_diffs,
                                         percent_rank_at_least)
from tablewatch.params import Cols, Scale

D = "_tw_d"
RK = "_tw_rk"
CELL = "_tw_cell"
TIE = "_tw_tie"


def _base(scored: DataFrame, cols: Cols) -> DataFrame:
    return scored.select(*[F.col(quote_ident(c)) for c in
                           [cols.sys, cols.ts, cols.x, *cols.tie_break, "z"]])


def _in_order(base: DataFrame, cols: Cols, *first: str) -> tuple[DataFrame, list[str]]:
    """Rows with a total order: without tie-break columns, rows that tie are
    ordered by a hash of the whole row, so that a large group of ties can
    still be split and reruns agree."""
    order = [*first, cols.ts, *cols.tie_break]
    if cols.tie_break:
        return base, order
    row = F.xxhash64(*[F.col(quote_ident(c)) for c in base.columns])
    return base.withColumn(TIE, row), [*order, TIE]


def _out_cols(cols: Cols) -> list[str]:
    return [cols.sys, cols.ts, cols.x, *cols.tie_break, "z", "knn_dist"]


def knn_time_scores(scored: DataFrame, cols: Cols, k: int = 5, scale: Scale = Scale(),
                    sizes=None) -> DataFrame:
    """Every row with knn_dist = mean of the k smallest |z - z'| among the k
    previous and k next rows of its system in time (NULL if none)."""
    base, order = _in_order(_base(scored, cols), cols)
    nd = neighbor_diffs(base, [cols.sys], order, "z", k, D, scale, sizes=sizes)
    return nd.withColumn("knn_dist", mean_k_smallest(F.col(D), k)).select(*_out_cols(cols))


def knn_exact_scores(scored: DataFrame, cols: Cols, k: int = 5, scale: Scale = Scale(),
                     sizes=None) -> DataFrame:
    """knn_dist = mean distance to the k nearest rows of the system by z."""
    base, order = _in_order(_base(scored, cols), cols, "z")
    nd = neighbor_diffs(base, [cols.sys], order, "z", k, D, scale, sizes=sizes)
    return nd.withColumn("knn_dist", mean_k_smallest(F.col(D), k)).select(*_out_cols(cols))


def knn_lsh_scores(scored: DataFrame, cols: Cols, k: int = 5, bucket: float = 1.0,
                   dist_thresh: float = 1.5, max_group_rows: int | None = None,
                   isolated: float | None = 0.0, scale: Scale = Scale(),
                   sizes=None) -> DataFrame:
    """Rows of non-NULL systems with knn_dist: k nearest within the same grid
    cell and closer than ``dist_thresh``; a row with no such neighbour gets
    ``isolated`` (0.0 in the reference).  Systems above ``max_group_rows``, if
    given: time-adjacent distances."""
    base = _base(scored, cols)
    if sizes is None:
        sizes = group_sizes(base, [cols.sys], scale)
    sizes = _sizes_df(sizes).filter(F.col(quote_ident(cols.sys)).isNotNull())
    if max_group_rows is None:
        small_rows, small_sizes = base.filter(F.col(quote_ident(cols.sys)).isNotNull()), sizes
    else:
        small = sizes.filter(F.col(N) <= max_group_rows).select(cols.sys)
        big = sizes.filter(F.col(N) > max_group_rows)
        small_rows = attach_small(base, small, [cols.sys], "left_semi", scale=scale,
                                  null_safe=False)
        small_sizes = attach_small(sizes, small, [cols.sys], "left_semi", scale=scale)
        big_rows = attach_small(base, big.select(cols.sys), [cols.sys], "left_semi", scale=scale,
                                null_safe=False)

    z = F.col("z")
    cell = F.when(z.isNull() | F.isnan(z), F.lit(None)).otherwise(F.floor(z / F.lit(bucket)))
    # Cells are contiguous in z order, so the window over the system in z
    # order, counting only neighbours of the same cell, is the per-cell
    # window; it shares the system partitioning with the rank cut.
    ordered, order = _in_order(small_rows, cols, "z")
    nd = neighbor_diffs(ordered.withColumn(CELL, cell), [cols.sys], order, "z", k, D, scale,
                        sizes=small_sizes, same=CELL)
    near = F.filter(F.col(D), lambda d: d < F.lit(dist_thresh))
    dist = mean_k_smallest(near, k)
    if isolated is not None:
        dist = F.coalesce(dist, F.lit(float(isolated)))
    small_scores = nd.withColumn("knn_dist", dist).select(*_out_cols(cols))
    if max_group_rows is None:
        return small_scores
    big_scores = knn_time_scores(big_rows, cols, k, scale, sizes=big)
    return small_scores.unionByName(big_scores)


def knn_rank_cut(scores: DataFrame, cols: Cols, pr_cutoff: float = 0.99,
                 scale: Scale = Scale(), sizes=None, rank_digits: int | None = None) -> DataFrame:
    """Keep rows whose percent_rank of knn_dist within the system is >=
    ``pr_cutoff`` (see ``rank_key`` for ``rank_digits``).  ``sizes`` are
    the per-system row counts of ``scores`` if already known."""
    ranked = percent_rank_at_least(scores.withColumn(RK, rank_key(F.col("knn_dist"), rank_digits)),
                                   [cols.sys], RK, pr_cutoff, "knn_pr", scale, sizes=sizes)
    return ranked.select(*_out_cols(cols), "knn_pr")


def knn_time(scored: DataFrame, cols: Cols, k: int = 5, pr_cutoff: float = 0.99,
             scale: Scale = Scale(), sizes=None, rank_digits: int | None = None) -> DataFrame:
    """Time-adjacent KNN outliers.  ``sizes``: rows per system if known (e.g.
    ``sizes_from_stats`` of the z-score statistics), saving a counting pass."""
    if sizes is None:
        sizes = group_sizes(_base(scored, cols), [cols.sys], scale)
    return knn_rank_cut(knn_time_scores(scored, cols, k, scale, sizes), cols, pr_cutoff, scale,
                        sizes, rank_digits)


def knn_exact(scored: DataFrame, cols: Cols, k: int = 5, pr_cutoff: float = 0.99,
              scale: Scale = Scale(), sizes=None, rank_digits: int | None = None) -> DataFrame:
    """Exact (value-ordered) KNN outliers; ``sizes`` as in ``knn_time``."""
    if sizes is None:
        sizes = group_sizes(_base(scored, cols), [cols.sys], scale)
    return knn_rank_cut(knn_exact_scores(scored, cols, k, scale, sizes), cols, pr_cutoff, scale,
                        sizes, rank_digits)


def knn_lsh(scored: DataFrame, cols: Cols, k: int = 5, pr_cutoff: float = 0.99,
            bucket: float = 1.0, dist_thresh: float = 1.5, max_group_rows: int | None = None,
            isolated: float | None = 0.0, scale: Scale = Scale(), sizes=None,
            engine: str = "grid", rank_digits: int | None = None) -> DataFrame:
    """Grid-cell (LSH) KNN outliers; ``sizes`` as in ``knn_time``.

    ``engine``: only "grid" (the exact cell window).  MLlib's
    ``approxSimilarityJoin`` would emit every pair inside a bucket, which a
    hot bucket turns into a quadratic join, so it is not offered."""
    if engine != "grid":
        raise ValueError("knn_lsh supports engine='grid' only (exact, linear); a pairwise "
                         "similarity join is quadratic in a hot bucket")
    if sizes is None:
        sizes = group_sizes(_base(scored, cols), [cols.sys], scale)
    scores = knn_lsh_scores(scored, cols, k, bucket, dist_thresh, max_group_rows, isolated, scale,
                            sizes)
    # NULL systems drop out of both branches (inner joins in the reference).
    return knn_rank_cut(scores, cols, pr_cutoff, scale,
                        _sizes_df(sizes).filter(F.col(quote_ident(cols.sys)).isNotNull()),
                        rank_digits)


def knn(scored: DataFrame, cols: Cols, mode: str = "time", **kw) -> DataFrame:
    """The reference's switch: "time" (any case) -> time-adjacent, "exact" ->
    exact 1-D neighbours, anything else -> the LSH plan."""
    m = mode.lower()
    if m == "time":
        kw = {k: v for k, v in kw.items() if k in ("k", "pr_cutoff", "scale", "rank_digits")}
        return knn_time(scored, cols, **kw)
    if m == "exact":
        kw = {k: v for k, v in kw.items() if k in ("k", "pr_cutoff", "scale", "rank_digits")}
        return knn_exact(scored, cols, **kw)
    return knn_lsh(scored, cols, **kw)
