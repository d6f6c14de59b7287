"""Joining a measured small side onto a large one.

Per-group statistics (one row per system) are joined back onto the rows.
We broadcast the small side only after counting it: rows x estimated row
width must stay under ``Scale.broadcast_bytes``.  Beyond that the join is a
plain shuffle join, and AQE's skew-join splitting takes care of a hot key on
the large side.
"""

from __future__ import annotations

from functools import reduce

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, ByteType, DataType, DateType,
                               DecimalType, FloatType, IntegerType, MapType, ShortType, StringType,
                               StructType)

from tablewatch.functions.exprs import quote_ident
from tablewatch.params import Scale
from tablewatch.session import ensure_checkpoint_dir


def _width(t: DataType, array_len: int) -> int:
    if isinstance(t, (StringType, BinaryType)):
        return 64
    if isinstance(t, ArrayType):
        return 16 + array_len * _width(t.elementType, 1)
    if isinstance(t, MapType):
        return 16 + array_len * (_width(t.keyType, 1) + _width(t.valueType, 1))
    if isinstance(t, StructType):
        return sum(_width(f.dataType, array_len) for f in t.fields)
    if isinstance(t, (ByteType, ShortType, IntegerType, FloatType, DateType, BooleanType)):
        return 4
    if isinstance(t, DecimalType):
        return 16
    return 8


def estimate_row_bytes(df: DataFrame, array_len: int = 16) -> int:
    return 16 + sum(_width(f.dataType, array_len) for f in df.schema.fields)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small derived table once and cut its lineage.

    A reliable checkpoint goes to ``spark.checkpoint.dir`` (shared storage on
    a cluster), so a lost executor does not force recomputing the aggregate
    that produced it, and later counts/joins do not rescan the input.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize`` that also returns aggregate metrics of the table
    (e.g. its row count), collected by the same job through an Observation
    instead of a second pass."""
    ensure_checkpoint_dir(df.sparkSession)
    obs = Observation(f"tw_{uuid.uuid4().hex[:12]}")
    ck = df.observe(obs, *[c.alias(k) for k, c in metrics.items()]).checkpoint(eager=True)
    return ck, dict(obs.get)


def should_broadcast(n_rows: int, row_bytes: int, scale: Scale) -> bool:
    return n_rows * row_bytes <= scale.broadcast_bytes


def attach_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", *,
                 scale: Scale, null_safe: bool = True, n_rows: int | None = None,
                 row_bytes: int | None = None) -> DataFrame:
    """``big JOIN small USING (on)`` with a measured broadcast decision.

    ``null_safe`` matches NULL keys to each other (group-by semantics, which
    window partitions share).  ``n_rows`` may be passed when already known.
    """
    if n_rows is None:
        n_rows = small.count()
    if row_bytes is None:
        row_bytes = estimate_row_bytes(small)
    keys = [f"__tw_k{i}" for i in range(len(on))]
    rest = [c for c in small.columns if c not in on]
    side = small.select(*[F.col(quote_ident(k)).alias(a) for k, a in zip(on, keys)],
                        *[F.col(quote_ident(c)) for c in rest])
    if should_broadcast(n_rows, row_bytes, scale):
        side = F.broadcast(side)
    if null_safe:
        cond = reduce(lambda a, b: a & b,
                      [big[quote_ident(k)].eqNullSafe(side[a]) for k, a in zip(on, keys)])
    else:
        cond = reduce(lambda a, b: a & b,
                      [big[quote_ident(k)] == side[a] for k, a in zip(on, keys)])
    out = big.join(side, cond, how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return out
    return out.drop(*keys)
