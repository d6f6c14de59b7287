"""Exact discrete quantiles of many groups at once, by radix selection.

A double's order-preserving 64-bit form (``order_bits``) is cut into four digits
of 16 bits.  One aggregate counts every group's values by their leading digit,
running counts point to the digit that holds each asked rank, and only rows of
such a digit are counted again, by their next digit or, once the open digits
are small, by value.  Partial counts are combined before each shuffle; a group
keeps at most 65,536 counters a round whatever its size; nothing is sampled and
no group's rows meet in one task.  The answer is the smallest value v with
count(x <= v) >= max(1, ceil(p * n)) over the n non-NULL values, that is
``percentile_disc``, at every size and by one plan.  NaN counts as the largest
value; -0.0 equals 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident
from tablewatch.operators.joins import attach_small, materialize_observed
from tablewatch.params import Scale

DIGIT = 16
KEY, D, C, RANK, PROB = "_tw_key", "_tw_digit", "_tw_c", "_tw_want", "_tw_p"


def order_bits(x: Column) -> Column:
    """A bigint that sorts as the double does: its IEEE 754 bits, the
    magnitude's negated for negative values (all NaN alike, -0.0 as 0.0); NULL stays."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(x + F.lit(0.0), F.lit(0.0))).cast("bigint")
    return F.when(x.isNull(), F.lit(None).cast("bigint")).when(F.isnan(x), F.lit(2 ** 63 - 1)).when(x < 0, -bits.bitwiseAND(F.lit(2 ** 63 - 1))).otherwise(bits)


def _c(name: str) -> Column:
    return F.col(quote_ident(name))


def _digit(shift: int) -> Column:
    return F.shiftright(F.col(KEY), shift)


def _running(part: list[Column], by: str) -> Column:
    return F.sum(C).over(Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, 0))


def _found(counts: DataFrame, part: list[str], by: str) -> DataFrame:
    """The entry of ``counts`` (per group and quantile, in the order of ``by``)
    in which the wanted rank falls, with the rank that is left inside it."""
    below = F.col("_tw_run") - F.col(C)
    return counts.withColumn("_tw_run", _running([*[_c(p) for p in part], F.col(PROB)], by)) \
        .filter((below < F.col(RANK)) & (F.col("_tw_run") >= F.col(RANK))).withColumn(RANK, F.col(RANK) - below).drop("_tw_run")


def radix_quantiles(df: DataFrame, part: list[str], x: str, probs: list[float], names: list[str],
                    scale: Scale = Scale()) -> DataFrame:
    """One row per group of ``part`` (NULL keys are a group): a column per
    quantile, NULL where the group has no value."""
    value = _c(x).cast("double")
    keys = [_c(p) for p in part]
    first = df.select(*keys, F.shiftright(order_bits(value), 64 - DIGIT).alias(D)) \
        .groupBy(*keys, D).agg(F.count(F.lit(1)).alias(C))
    # One sorted pass over a group's counters: its total and running counts
    # (NULL values come first and count for nothing).
    some = F.when(F.col(D).isNotNull(), F.col(C)).otherwise(F.lit(0))
    counted = first.withColumn(C, some).withColumns({"_tw_run": _running(keys, D), "_tw_n": F.sum(C).over(Window.partitionBy(*keys))})
    below = F.col("_tw_run") - F.col(C)
    wanted = [F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col("_tw_n"))).cast("bigint") for p in probs]
    hits = [F.when((below < r) & (r <= F.col("_tw_run")), F.struct(F.lit(i).alias(PROB), (r - below).alias(RANK)))
            for i, r in enumerate(wanted)]
    nothing = F.struct(F.lit(-1).alias(PROB), F.lit(0).cast("bigint").alias(RANK))
    hits = F.when(F.col("_tw_n") == 0, F.array(nothing)).otherwise(F.array_compact(F.array(*hits)))
    state, m = materialize_observed(
        counted.select(*keys, D, C, F.explode(hits).alias("_tw_h")).select(*keys, D, C, "_tw_h.*"),
        rows=F.count(F.lit(1)), most=F.max(C))
    rows = df.select(*keys, value.alias("_tw_x"), order_bits(value).alias(KEY)).filter(value.isNotNull())
    shift, open_, most = 64 - DIGIT, int(m["rows"] or 0), int(m["most"] or 0)
    while shift and most > scale.split_rows:
        shift -= DIGIT
        state, m = materialize_observed(
            _found(_inside(rows, state, part, shift + DIGIT, open_, scale).groupBy(*keys, PROB, RANK, _digit(shift).alias(D))
                   .agg(F.count(F.lit(1)).alias(C)), part, D).unionByName(state.filter(F.col(D).isNull())),
            rows=F.count(F.lit(1)), most=F.max(C))
        most = int(m["most"] or 0)
    inside = _inside(rows, state, part, shift, open_, scale)
    exact = _found(inside.groupBy(*keys, PROB, RANK, KEY).agg(F.count(F.lit(1)).alias(C), F.min("_tw_x").alias("_tw_x")),
                   part, KEY)
    both = exact.select(*keys, PROB, "_tw_x").unionByName(
        state.filter(F.col(D).isNull()).select(*keys, PROB, F.lit(None).cast("double").alias("_tw_x")))
    return both.groupBy(*keys).agg(*[F.max(F.when(F.col(PROB) == i, F.col("_tw_x"))).alias(name) for i, name in enumerate(names)])


def _inside(rows: DataFrame, state: DataFrame, part: list[str], shift: int, n_rows: int, scale: Scale) -> DataFrame:
    """Rows whose digits so far are those of an open entry, once per entry."""
    side = state.filter(F.col(D).isNotNull()).drop(C)
    cut = rows.withColumn(D, _digit(shift))
    return attach_small(cut, side, [*part, D], "inner", scale=scale, n_rows=n_rows)
