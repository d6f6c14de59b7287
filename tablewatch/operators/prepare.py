"""K0: validate the three role columns and normalise their types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from tablewatch.functions.exprs import quote_ident
from tablewatch.params import Cols

_TS_FROM_NUMBER = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}


def absent_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Those of ``names`` that ``df`` lacks, by exact, case-sensitive name
    (Spark itself would resolve names case-insensitively)."""
    return sorted(set(names).difference(df.columns))


def require_columns(df: DataFrame, names: list[str]) -> None:
    absent = absent_columns(df, names)
    if absent:
        raise ValueError(f"input lacks column(s) {', '.join(absent)}; it has {', '.join(df.columns)}")


def prepare(df: DataFrame, cols: Cols, ts_unit: str = "s", nan_as_null: bool = False) -> DataFrame:
    """Timestamp column -> TIMESTAMP (left alone if already TIMESTAMP or
    TIMESTAMP_NTZ), feature -> DOUBLE.  Unparseable strings become NULL
    (``try_`` forms; ANSI stays on for everything else).  Numbers in the
    timestamp column are epochs in ``ts_unit`` ("s" like ``to_timestamp``,
    "ms" or "us")."""
    require_columns(df, [cols.sys, cols.ts, cols.x])
    ts_type = df.schema[cols.ts].dataType
    ts = F.col(quote_ident(cols.ts))
    if isinstance(ts_type, (TimestampType, TimestampNTZType)):
        ts_expr = None
    elif isinstance(ts_type, StringType):
        ts_expr = F.try_to_timestamp(ts)
    elif isinstance(ts_type, DateType):
        ts_expr = ts.cast("timestamp")
    elif isinstance(ts_type, NumericType):
        if ts_unit not in _TS_FROM_NUMBER:
            raise ValueError(f"ts_unit must be one of {sorted(_TS_FROM_NUMBER)}")
        src = ts if ts_unit == "s" else ts.cast("bigint")
        ts_expr = _TS_FROM_NUMBER[ts_unit](src)
    else:
        ts_expr = F.try_to_timestamp(ts.cast("string"))
    repl = {}
    if not isinstance(df.schema[cols.x].dataType, DoubleType):
        repl[cols.x] = F.col(quote_ident(cols.x)).try_cast("double")
    if nan_as_null:
        x = repl.get(cols.x, F.col(quote_ident(cols.x)))
        repl[cols.x] = F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)
    if ts_expr is not None:
        repl[cols.ts] = ts_expr
    # Columns that already have the right type are left untouched (no
    # projection), which keeps identical sub-plans identical for reuse.
    return df.withColumns(repl) if repl else df
