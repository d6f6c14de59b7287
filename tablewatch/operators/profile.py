"""A3/A5/A6: input profile and the small/big system split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident
from tablewatch.params import Cols


def input_profile(df: DataFrame, cols: Cols) -> DataFrame:
    """One row: rows, systems (a NULL system counts as one, like
    ``select(sys).distinct().count()``)."""
    s = F.col(quote_ident(cols.sys))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_distinct(s) + F.max(F.when(s.isNull(), 1).otherwise(0))).cast("bigint")
        .alias("systems"),
    )


def system_sizes(df: DataFrame, cols: Cols, max_group_rows: int = 250_000) -> DataFrame:
    """sys, n, size_class: 'small' when n <= max_group_rows else 'big'."""
    return (df.groupBy(F.col(quote_ident(cols.sys))).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("size_class",
                        F.when(F.col("n") <= max_group_rows, F.lit("small"))
                        .otherwise(F.lit("big"))))
