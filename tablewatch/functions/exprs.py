"""Built-in column expressions.

Nothing here leaves the JVM, so whole-stage code generation and vectorised
reads stay in place and no Python worker is started.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

def zscore_expr(x: Column, mean: Column, std: Column) -> Column:
    """0.0 when the spread is NULL (one row) or zero (constant system)."""
    return F.when(std.isNull() | (std == 0), F.lit(0.0)).otherwise((x - mean) / std)


def mean_k_smallest(dists: Column, k: int) -> Column:
    """Mean of the ``k`` smallest non-NULL entries (fewer if fewer exist,
    NULL if none).  The array is sorted once (NULLs last, NaN after every
    number) and its first entries are added up as plain columns, so the sum
    stays in generated code."""
    ordered = F.array_sort(dists)
    nearest = [F.get(ordered, F.lit(i)) for i in range(k)]
    found = sum((d.isNotNull().cast("int") for d in nearest), F.lit(0))
    total = sum((F.coalesce(d, F.lit(0.0)) for d in nearest), F.lit(0.0))
    return total / F.nullif(found, F.lit(0))


def rank_key(c: Column, digits: int | None = None) -> Column:
    """What a rank is taken on: the value itself or, to compare with an engine
    that sums in another order, rounded to ``digits`` decimals."""
    return c if digits is None else F.round(c, digits)


def epoch_micros_to_ts(c: Column) -> Column:
    """Epoch microseconds (integer or DECIMAL(p,0)) to TIMESTAMP.  The cast to
    bigint raises on overflow under ANSI, like a checked Arrow cast."""
    return F.timestamp_micros(c.cast("bigint"))


def quote_ident(*parts: str) -> str:
    """Back-tick quote a (multi-part) identifier, escaping inner back-ticks."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (presentation for cross-engine checks)."""
    return df.select([
        F.round(F.col(quote_ident(f.name)), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(quote_ident(f.name))
        for f in df.schema.fields
    ])
