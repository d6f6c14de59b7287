"""K1: per-system z-scores, threshold outliers and the global top-k.

The reference uses three whole-partition windows over the system column,
which sends every row of a system to one task.  Here the statistics are an
aggregate (partial counts/sums combined map-side), joined back onto the rows
with a measured broadcast, so rows are never shuffled by system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident, rank_key, zscore_expr
from tablewatch.operators.joins import attach_small, materialize_observed
from tablewatch.params import Cols, Scale

SCORE_COLS = ["n", "mean_feat", "std_feat", "z", "abs_z"]


def system_stats(df: DataFrame, cols: Cols) -> DataFrame:
    x = F.col(quote_ident(cols.x))
    return df.groupBy(F.col(quote_ident(cols.sys))).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("mean_feat"),
        F.stddev_samp(x).alias("std_feat"),
    )


def zscore_with_stats(df: DataFrame, cols: Cols,
                      scale: Scale = Scale()) -> tuple[DataFrame, DataFrame]:
    """(scored rows, per-system stats table).  The stats table (sys, n,
    mean_feat, std_feat) is checkpointed; its ``n`` doubles as the group sizes
    the split plans need, so callers can skip a recount."""
    stats, m = materialize_observed(system_stats(df, cols), rows=F.count(F.lit(1)))
    scored = attach_small(df, stats, [cols.sys], "left", scale=scale, null_safe=True,
                          n_rows=m["rows"])
    z = zscore_expr(F.col(quote_ident(cols.x)), F.col("mean_feat"), F.col("std_feat"))
    return scored.withColumn("z", z).withColumn("abs_z", F.abs(F.col("z"))), stats


def zscore(df: DataFrame, cols: Cols, scale: Scale = Scale()) -> DataFrame:
    """Input columns + n, mean_feat, std_feat, z, abs_z.  NULL systems form
    one group, as in a window partition."""
    return zscore_with_stats(df, cols, scale)[0]


def sizes_from_stats(stats: DataFrame, cols: Cols) -> DataFrame:
    """Group sizes in the layout of ``splits.group_sizes``."""
    return stats.select(F.col(quote_ident(cols.sys)), F.col("n").alias("_tw_n"))


def _out(cols: Cols, *extra: str) -> list:
    return [F.col(quote_ident(c)) for c in [cols.sys, cols.ts, cols.x, *cols.tie_break, *extra]]


def zscore_outliers(scored: DataFrame, cols: Cols, z_thresh: float = 2.0,
                    min_points: int = 20) -> DataFrame:
    """n >= min_points (inclusive) and abs_z > z_thresh (strict)."""
    return (scored.filter((F.col("n") >= min_points) & (F.col("abs_z") > F.lit(z_thresh)))
            .select(*_out(cols, "z", "abs_z")))


def suspects_topk(scored: DataFrame, cols: Cols, k: int = 50,
                  rank_digits: int | None = None) -> DataFrame:
    """Global top-k by abs_z regardless of thresholds.  Planned as
    TakeOrderedAndProject: each task keeps its own k best, no global sort.
    Ties are broken by system, time and the tie-break columns."""
    order = [rank_key(F.col("abs_z"), rank_digits).desc_nulls_last()] + [
        F.col(quote_ident(c)).asc_nulls_first() for c in [cols.sys, cols.ts, *cols.tie_break]]
    return scored.orderBy(*order).limit(k).select(*_out(cols, "z", "abs_z"))
