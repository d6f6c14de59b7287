"""One schema for files of several: the least type of each column that holds,
and that Spark's Parquet reader can read directly from, all of its files.

The footer census gives every (column, physical type) of a folder; Spark's own
type for each comes from one example file.  ``common_type`` joins them on a
small lattice.  Columns that some files lack are NULL there.  A column without
a common readable type makes the folder an error that names the types; such
files need the sanitiser or a cast first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.functions.exprs import quote_ident

_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
_FRACTIONS = (T.FloatType(), T.DoubleType())


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type both widen to without loss, or None."""
    if a == b:
        return a
    if a in _INTEGERS and b in _INTEGERS:
        return _INTEGERS[max(_INTEGERS.index(a), _INTEGERS.index(b))]
    if a in _FRACTIONS and b in _FRACTIONS:
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        if x in _INTEGERS[:3] and y in _FRACTIONS:
            return T.DoubleType()
        if x in _INTEGERS and isinstance(y, T.DecimalType):
            return _decimal(max(_DIGITS[x], y.precision - y.scale), y.scale)
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
        if isinstance(x, T.TimestampNTZType) and isinstance(y, T.TimestampType):
            return y
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return _decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale))
    return None


def _decimal(whole: int, scale: int) -> T.DecimalType | None:
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def readable(physical: str, own: T.DataType, target: T.DataType) -> bool:
    """Whether the reader gives a column stored as ``physical`` right as
    ``target`` (unsigned integers have fewer ways than signed ones)."""
    if own == target:
        return True
    if physical.startswith("uint"):
        return target in _INTEGERS or (physical in ("uint8", "uint16") and isinstance(target, T.DoubleType))
    return True


def column_types(spark: SparkSession, manifest: DataFrame) -> dict[str, list[tuple[str, str, str]]]:
    """Per folder: (column, physical type, example file), in the order in which
    the files show them first.  A row per distinct type, not per file."""
    fields = manifest.select("folder", "path", F.posexplode("fields").alias("pos", "f"))
    found = fields.groupBy("folder", F.col("f.name").alias("column"), F.col("f.arrow_type").alias("kind")).agg(
        F.min(F.struct("path", "pos")).alias("first"))
    out: dict[str, list] = {}
    for r in sorted(found.collect(), key=lambda r: (r["folder"], r["first"]["path"], r["first"]["pos"])):
        out.setdefault(r["folder"], []).append((r["column"], r["kind"], r["first"]["path"]))
    return out


def widened_schema(spark: SparkSession, types: list[tuple[str, str, str]]) -> T.StructType:
    """The folder's schema; ValueError where a column has no common type."""
    schemas: dict[str, T.StructType] = {}
    names: dict[str, str] = {}
    kinds: dict[str, list[tuple[str, T.DataType]]] = {}
    for column, kind, path in types:
        if path not in schemas:
            schemas[path] = spark.read.parquet(path).schema
        names.setdefault(column.lower(), column)  # Spark resolves names in any case
        kinds.setdefault(column.lower(), []).append((kind, schemas[path][column].dataType))
    fields = []
    for low, found in kinds.items():
        target = reduce(lambda a, b: None if a is None else common_type(a, b), [t for _, t in found])
        if target is None or not all(readable(kind, own, target) for kind, own in found):
            raise ValueError(f"no common type for {names[low]}: " + ", ".join(sorted(kind for kind, _ in found)))
        fields.append(T.StructField(names[low], target))
    return T.StructType(fields)


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"{quote_ident(f.name)} {f.dataType.simpleString()}" for f in schema)
