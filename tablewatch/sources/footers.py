"""S13: distributed Parquet footer census.

Spark reads a folder with the schema of one file, so mixed files (int32 in
one, uint64 in another) need a look at every footer.  The file list is a
DataFrame; each task opens its files' footers with pyarrow (footer only, no
data pages) and returns one row per file.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.sources.files import PARQUET_GLOB, list_files, with_relative

FIELD = ("struct<name:string, arrow_type:string, type_name:string, precision:int, scale:int, "
         "nullable:boolean, field_metadata:string>")
FOOTER_SCHEMA = (f"path string, n_rows bigint, n_row_groups int, fields array<{FIELD}>, "
                 "error string")


def _open_args(path: str):
    from pyarrow import fs
    if path.startswith("file:"):
        local = path[5:]
        while local.startswith("//"):
            local = local[1:]
        return fs.LocalFileSystem(), local
    if path.startswith("s3a://") or path.startswith("s3n://"):
        path = "s3://" + path.split("://", 1)[1]
    return fs.FileSystem.from_uri(path)


def _describe(t) -> tuple[str, int | None, int | None]:
    import pyarrow as pa
    if pa.types.is_decimal(t):
        return "decimal", t.precision, t.scale
    if pa.types.is_timestamp(t):
        return "timestamp", None, None
    return str(t).split("[")[0].split("(")[0].split("<")[0], None, None


def _footers(batches):
    import json

    import pandas as pd
    import pyarrow.parquet as pq

    def described(metadata):
        """Keys and values of a field as JSON; the format's own keys aside."""
        own = {k.decode(): v.decode(errors="replace") for k, v in (metadata or {}).items()
               if not k.startswith(b"PARQUET:")}
        return json.dumps(own, sort_keys=True) if own else None

    for pdf in batches:
        out = []
        for path in pdf["path"]:
            try:
                filesystem, p = _open_args(path)
                with filesystem.open_input_file(p) as f:
                    md = pq.ParquetFile(f).metadata
                    schema = md.schema.to_arrow_schema()
                fields = []
                for fld in schema:
                    tn, prec, sc = _describe(fld.type)
                    fields.append({"name": fld.name, "arrow_type": str(fld.type), "type_name": tn,
                                   "precision": prec, "scale": sc, "nullable": fld.nullable,
                                   "field_metadata": described(fld.metadata)})
                out.append({"path": path, "n_rows": md.num_rows, "n_row_groups": md.num_row_groups,
                            "fields": fields, "error": None})
            except Exception as e:  # noqa: BLE001 - reported per file
                out.append({"path": path, "n_rows": None, "n_row_groups": None, "fields": None,
                            "error": f"{type(e).__name__}: {e}"})
        yield pd.DataFrame(out, columns=["path", "n_rows", "n_row_groups", "fields", "error"])


# The footer reader runs inside tasks: ship this module's functions with the
# job instead of requiring the package to be installed on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_footers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """files (needs ``path``) -> path, n_rows, n_row_groups, fields, error.
    Files are spread round-robin so footers are read in parallel."""
    n = max(1, spark.sparkContext.defaultParallelism)
    return files.select("path").repartition(n).mapInPandas(_footers, FOOTER_SCHEMA)


def parquet_files(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files under root with relative path, folder and size."""
    return with_relative(list_files(spark, root, PARQUET_GLOB), root)


def schema_census(spark: SparkSession, root: str) -> DataFrame:
    """One row per (file, top-level column): path, rel, folder, rel_dir, size,
    n_rows, column, arrow_type, type_name, precision, scale, nullable,
    field_metadata (JSON, NULL if none), error.  A file whose footer cannot be read appears once with its error."""
    files = parquet_files(spark, root)
    foot = read_footers(spark, files)
    joined = files.join(foot, "path", "left")
    return joined.select(
        "path", "rel", "folder", "rel_dir", "size", "n_rows",
        F.explode_outer("fields").alias("f"), "error",
    ).select(
        "path", "rel", "folder", "rel_dir", "size", "n_rows",
        F.col("f.name").alias("column"), F.col("f.arrow_type").alias("arrow_type"),
        F.col("f.type_name").alias("type_name"), F.col("f.precision").alias("precision"),
        F.col("f.scale").alias("scale"), F.col("f.nullable").alias("nullable"),
        F.col("f.field_metadata").alias("field_metadata"), "error",
    )
