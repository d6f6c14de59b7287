"""K2: per-system quartile bounds and the rows outside them.

Quartiles have one definition at every size: ``percentile_disc``, the smallest
value with at least the asked share of the non-NULL values at or below it, and
one plan: radix selection (``quantiles``) for all systems at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident
from tablewatch.operators.joins import (attach_small, estimate_row_bytes, materialize_observed,
                                        should_broadcast)
from tablewatch.operators.quantiles import radix_quantiles
from tablewatch.params import Cols, Scale

PROBS = {"q1": 0.25, "q3": 0.75}
# Parts a system's rows are dealt to where the quartile table is too large to
# broadcast and rows have to be shuffled to it.
SALTS = 64


def quartiles(df: DataFrame, cols: Cols, scale: Scale = Scale(), sizes=None) -> DataFrame:
    """q1 and q3 per system (NULL where a system has no value).  ``sizes`` is
    accepted for symmetry with the neighbour operators; it is not needed."""
    return radix_quantiles(df, [cols.sys], cols.x, list(PROBS.values()), list(PROBS), scale)


def quartile_table(df: DataFrame, cols: Cols, scale: Scale = Scale(),
                   sizes=None) -> tuple[DataFrame, int]:
    """Checkpointed quartiles and their row count (observed, no extra job)."""
    q, m = materialize_observed(quartiles(df, cols, scale, sizes), rows=F.count(F.lit(1)))
    return q, int(m["rows"])


def _bounds(mult: float) -> dict[str, Column]:
    spread = F.col("q3") - F.col("q1")
    return {"iqr": spread, "low": F.col("q1") - mult * spread, "high": F.col("q3") + mult * spread}


def _outside(cols: Cols) -> Column:
    x = F.col(quote_ident(cols.x))
    return (x < F.col("low")) | (x > F.col("high"))


def with_bounds(df: DataFrame, cols: Cols, mult: float = 1.5, scale: Scale = Scale(),
                null_safe: bool = False, q: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Rows + q1, q3, iqr, low, high.  As in an equi-join, a NULL system
    matches nothing (NULL bounds) unless ``null_safe``.  ``q`` may be a
    ``quartile_table`` computed once and shared by several outputs."""
    table, n = q or quartile_table(df, cols, scale)
    return attach_small(df, table.withColumns(_bounds(mult)), [cols.sys], "left", scale=scale,
                        null_safe=null_safe, n_rows=n)


def _salted(df: DataFrame, table: DataFrame, cols: Cols) -> DataFrame:
    """Rows with their system's bounds by a shuffle that deals every system's
    rows to ``SALTS`` tasks."""
    salt = F.pmod(F.xxhash64(*[F.col(quote_ident(c)) for c in df.columns]), F.lit(SALTS))
    side = table.withColumn("_tw_salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))) \
        .withColumnRenamed(cols.sys, "_tw_sys2")
    rows = df.withColumn("_tw_salt", salt)
    return rows.join(side, (F.col("_tw_salt") == F.col("_tw_salt2"))
                     & (F.col(quote_ident(cols.sys)) == F.col("_tw_sys2")), "left")


def iqr_bounds(df: DataFrame, cols: Cols, mult: float = 1.5, scale: Scale = Scale(),
               q: tuple[DataFrame, int] | None = None) -> DataFrame:
    """One row per system: q1, q3, iqr, low, high, n (all rows), n_outliers.

    Rows and outliers are counted first; the counts then meet the bounds."""
    df = df.select(F.col(quote_ident(cols.sys)), F.col(quote_ident(cols.x)))
    table, n = q or quartile_table(df, cols, scale)
    bounds = table.withColumns(_bounds(mult))
    fits = should_broadcast(n, estimate_row_bytes(bounds), scale)
    rows = attach_small(df, bounds, [cols.sys], "left", scale=scale, null_safe=False, n_rows=n) \
        if fits else _salted(df, bounds, cols)
    counts = rows.groupBy(F.col(quote_ident(cols.sys))).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_outside(cols)).alias("n_outliers"))
    # The NULL system has rows but, matching nothing, no bounds.
    return attach_small(counts, bounds, [cols.sys], "left", scale=scale, null_safe=False, n_rows=n) \
        .select(F.col(quote_ident(cols.sys)), *PROBS, "iqr", "low", "high", "n", "n_outliers")


def iqr_outliers_detailed(df: DataFrame, cols: Cols, mult: float = 1.5, scale: Scale = Scale(),
                          q: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Every row outside [low, high] with the violated side ("where") and how
    far beyond that bound it lies."""
    x, low, high = F.col(quote_ident(cols.x)), F.col("low"), F.col("high")
    side = F.when(x < low, F.struct(F.lit("below_low").alias("name"), (low - x).alias("by"))) \
        .when(x > high, F.struct(F.lit("above_high").alias("name"), (x - high).alias("by")))
    rows = with_bounds(df, cols, mult, scale, q=q).withColumn("_tw_side", side)
    return rows.filter(F.col("_tw_side").isNotNull()).select(
        *[F.col(quote_ident(c)) for c in cols.key], *PROBS, "iqr", "low", "high",
        F.col("_tw_side.name").alias("where"), F.col("_tw_side.by").alias("dist_from_bound"))


def iqr_outliers(df: DataFrame, cols: Cols, mult: float = 1.5, scale: Scale = Scale(),
                 q: tuple[DataFrame, int] | None = None) -> DataFrame:
    return iqr_outliers_detailed(df, cols, mult, scale, q).select(
        *[F.col(quote_ident(c)) for c in cols.key])


def iqr_all(df: DataFrame, cols: Cols, mult: float = 1.5, scale: Scale = Scale(),
            sizes=None) -> dict[str, DataFrame]:
    """The three IQR outputs from one quartile pass."""
    q = quartile_table(df, cols, scale, sizes)
    return {
        "iqr_bounds": iqr_bounds(df, cols, mult, scale, q),
        "iqr_outliers_detailed": iqr_outliers_detailed(df, cols, mult, scale, q),
        "iqr_outliers": iqr_outliers(df, cols, mult, scale, q),
    }
