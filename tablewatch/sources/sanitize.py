"""K9: type clean-up rewrite (unsigned 64-bit -> DECIMAL(20,0), epoch
microseconds in a column named ``timestamp`` -> TIMESTAMP).

Plan: the footer census gives every file's physical types; ``plan_casts``
turns them into per-file cast rows (a DataFrame, also the dry-run report).
Paths and their casts stay in a table.  One job deals its rows to tasks; a task
reads a file in stretches of bounded size, casts the listed columns and writes
the file of the same relative path.  Parquet details that Spark's own writer
does not carry (required columns, field metadata) stay as they were.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.operators.joins import materialize, materialize_observed
from tablewatch.sources import footers
from tablewatch.sources.files import _strip_scheme, qualify
from tablewatch.sources.footers import parquet_files, schema_census

# The column name that carries epoch microseconds, the labels
# of the two target types in reports, and the smallest decimal precision
# treated as an already-widened epoch.
TIMESTAMP_NAME = "timestamp"
TO_TIMESTAMP = "timestamp(us, tz='UTC')"
TO_DECIMAL = "decimal128(20,0)"
MIN_EPOCH_DECIMAL_PRECISION = 18

# Where Spark keeps a file's schema a second time (fixed value), and its names
# of the two target types.
SPARK_SCHEMA_KEY = b"org.apache.spark.sql.parquet.row.metadata"
SPARK_NAMES = {TO_TIMESTAMP: "timestamp", TO_DECIMAL: "decimal(20,0)"}

STRETCH_BYTES = 8 << 20     # decoded data that a task holds, and size of a row group
STRETCH_ROWS = 1 << 16      # and its rows, as long values that repeat take few of those bytes
TASK_BYTES = 128 << 20      # input of one task, unless one file is larger
REWRITE_SCHEMA = "path string, out_path string, n_rows bigint"


def plan_casts(census: DataFrame) -> DataFrame:
    """path, rel_dir, column, from_type, to_type for every column that
    changes.  Top-level columns only; exact (case-sensitive) name match."""
    name = F.col("column")
    tn = F.col("type_name")
    is_ts_source = (tn == "uint64") | ((tn == "decimal") & (F.col("scale") == 0)
                                       & (F.col("precision") >= MIN_EPOCH_DECIMAL_PRECISION))
    to_type = (F.when((name == TIMESTAMP_NAME) & is_ts_source, F.lit(TO_TIMESTAMP))
               .when((name != TIMESTAMP_NAME) & (tn == "uint64"), F.lit(TO_DECIMAL)))
    return (census.filter(F.col("error").isNull())
            .select("path", "rel_dir", "column", F.col("arrow_type").alias("from_type"),
                    to_type.alias("to_type"))
            .filter(F.col("to_type").isNotNull()))


def _target_types():
    import pyarrow as pa
    return {TO_TIMESTAMP: pa.timestamp("us", tz="UTC"), TO_DECIMAL: pa.decimal128(20, 0)}


def _retyped_schema(pf, casts: dict[str, str]):
    """The file's schema after the casts.  INT96 holds instants, so such a
    column stays one (UTC) when it is stored as microseconds."""
    import json

    import pyarrow as pa
    targets = _target_types()
    int96 = {c.path for c in (pf.schema.column(i) for i in range(len(pf.schema)))
             if c.physical_type == "INT96"}
    old = pf.schema_arrow
    fields = [f.with_type(targets[casts[f.name]]) if f.name in casts
              else f.with_type(pa.timestamp("us", tz="UTC")) if f.name in int96 else f
              for f in old]
    metadata = dict(old.metadata or {})
    if SPARK_SCHEMA_KEY in metadata:
        stored = json.loads(metadata[SPARK_SCHEMA_KEY])
        for f in stored["fields"]:
            if f["name"] in casts:
                f["type"] = SPARK_NAMES[casts[f["name"]]]
        metadata[SPARK_SCHEMA_KEY] = json.dumps(stored).encode()
    return pa.schema(fields, metadata=metadata or None)


def _retyped(column, kind):
    """Checked casts: a value that does not fit raises."""
    import pyarrow as pa
    if column.type == kind:
        return column
    if pa.types.is_timestamp(kind) and not pa.types.is_timestamp(column.type):
        return column.cast(pa.int64()).cast(kind)
    return column.cast(kind, safe=not pa.types.is_timestamp(kind))


def _rewrite_file(path: str, dest: str, casts: dict[str, str], compression: str) -> int:
    """Rows written to ``dest``.  The file appears under its name only when it
    is complete, so a task that is lost or runs twice leaves no part of one."""
    import uuid

    import pyarrow as pa
    import pyarrow.parquet as pq
    source, p = footers._open_args(path)
    sink, d = footers._open_args(dest if ":" in dest.split("/")[0] else f"file:{dest}")
    folder, name = d.rsplit("/", 1)
    tmp = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    sink.create_dir(folder, recursive=True)
    rows = 0
    try:
        with source.open_input_file(p) as f:
            pf = pq.ParquetFile(f, buffer_size=1 << 20, pre_buffer=False)
            schema = _retyped_schema(pf, casts)
            md = pf.metadata
            decoded = sum(md.row_group(i).total_byte_size for i in range(md.num_row_groups))
            stretch = max(1, min(STRETCH_ROWS, STRETCH_BYTES * max(md.num_rows, 1) // max(decoded, 1)))
            with pq.ParquetWriter(tmp, schema, filesystem=sink, compression=compression,
                                  coerce_timestamps="us", allow_truncated_timestamps=True) as out:
                for batch in pf.iter_batches(batch_size=stretch):
                    columns = [_retyped(c, k.type) for c, k in zip(batch.columns, schema)]
                    out.write_table(pa.Table.from_arrays(columns, schema=schema))
                    rows += batch.num_rows
        if sink.get_file_info(d).type != pa.fs.FileType.NotFound:
            sink.delete_file(d)
        sink.move(tmp, d)
    except BaseException:
        if sink.get_file_info(tmp).type != pa.fs.FileType.NotFound:
            sink.delete_file(tmp)
        raise
    finally:
        pa.default_memory_pool().release_unused()
    return rows


# Tasks need not have the package installed (as in ``footers``).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _rewrite(files: DataFrame, out: str, compression: str, n_tasks: int) -> DataFrame:
    """files (path, rel, casts) -> path, out_path, n_rows; evaluate to write."""
    base = out.rstrip("/")

    def write(batches):
        import pyarrow as pa
        import pyarrow.fs  # noqa: F401 - named as pa.fs
        for batch in batches:
            for row in batch.to_pylist():
                dest = f"{base}/{row['rel']}"
                casts = {c["column"]: c["to_type"] for c in row["casts"] or []}
                n = _rewrite_file(row["path"], dest, casts, compression)
                yield pa.RecordBatch.from_pydict(
                    {"path": [row["path"]], "out_path": [dest], "n_rows": [n]},
                    schema=pa.schema([("path", pa.string()), ("out_path", pa.string()), ("n_rows", pa.int64())]))

    return files.select("path", "rel", "casts").repartition(n_tasks).mapInArrow(write, REWRITE_SCHEMA)


def _refuse_existing(spark: SparkSession, files: DataFrame, out: str) -> None:
    try:
        there = parquet_files(spark, out)
    except AnalysisException:       # no such folder yet
        return
    clash = files.select("rel").join(there.select("rel"), "rel", "left_semi").first()
    if clash:
        raise FileExistsError(f"{out}/{clash['rel']} exists; pass overwrite to replace it")


def sanitize(spark: SparkSession, root: str, out: str, overwrite: bool = False,
             only_changed: bool = True, compression: str = "snappy",
             dry_run: bool = False) -> DataFrame:
    """Rewrite the Parquet files under ``root`` into ``out``, each to the same
    relative path.  Returns the report: path, rel_dir, column, from_type,
    to_type, out_path, written, error — one row per cast, plus one row per
    file whose footer could not be read.  A file that exists there is an error
    unless ``overwrite``; other files in ``out`` are left alone.  Nullability,
    field and file metadata are kept; timestamps are stored as microseconds; a
    value that does not fit its new type raises.  ``out`` must lie outside
    ``root`` and must not contain it: an overwrite would replace files that are
    still to be read.  One file is one task's work, in stretches of
    ``STRETCH_BYTES``."""
    root, out = qualify(root), qualify(out)
    inner, outer = f"{_strip_scheme(out).rstrip('/')}/", f"{_strip_scheme(root).rstrip('/')}/"
    if inner.startswith(outer) or outer.startswith(inner):
        raise ValueError(f"the output folder {out} overlaps the input folder {root}")
    census = materialize(schema_census(spark, root))
    plan = materialize(plan_casts(census))
    unreadable = (census.filter(F.col("error").isNotNull())
                  .select("path", "rel_dir", F.lit(None).cast("string").alias("column"),
                          F.lit(None).cast("string").alias("from_type"),
                          F.lit(None).cast("string").alias("to_type"),
                          F.lit(None).cast("string").alias("out_path"),
                          F.lit(False).alias("written"), "error"))
    if dry_run:
        return (plan.withColumn("out_path", F.lit(None).cast("string"))
                .withColumn("written", F.lit(False))
                .withColumn("error", F.lit(None).cast("string"))
                .unionByName(unreadable))
    casts = plan.groupBy("path").agg(F.collect_list(F.struct("column", "to_type")).alias("casts"))
    readable = census.filter(F.col("error").isNull()).select("path", "rel", "size").distinct()
    files, total = materialize_observed(readable.join(casts, "path", "inner" if only_changed else "left"),
                                        n=F.count(F.lit(1)), size=F.sum("size"))
    if not overwrite:
        _refuse_existing(spark, files, out)
    n_tasks = max(4 * spark.sparkContext.defaultParallelism, (total["size"] or 0) // TASK_BYTES)
    done = materialize(_rewrite(files, out, compression, max(1, min(total["n"], n_tasks))))
    return (plan.join(done.select("path", "out_path"), "path", "left")
            .withColumn("written", F.col("out_path").isNotNull())
            .withColumn("error", F.lit(None).cast("string"))
            .unionByName(unreadable))


def sanitize_summary(census: DataFrame, plan: DataFrame) -> DataFrame:
    """files_scanned, files_changed, casts (one row)."""
    per_file = plan.groupBy("path").agg(F.count(F.lit(1)).alias("_n"))
    return (census.select("path").distinct().join(per_file, "path", "left")
            .agg(F.count(F.lit(1)).alias("files_scanned"),
                 F.count_if(F.col("_n") > 0).alias("files_changed"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("casts")))


def main(argv: list[str] | None = None) -> None:
    """python -m tablewatch.sources.sanitize --in DIR --out DIR [--overwrite]
    [--dry-run] [--compression snappy]"""
    import argparse

    from tablewatch.session import get_session
    ap = argparse.ArgumentParser(description="Copy a Parquet tree with its unsigned and epoch columns retyped.")
    ap.add_argument("--in", dest="in_dir", required=True)
    ap.add_argument("--out", dest="out_dir", required=True)
    ap.add_argument("--overwrite", action="store_true")
    ap.add_argument("--dry-run", action="store_true")
    ap.add_argument("--compression", default="snappy")
    a = ap.parse_args(argv)
    spark = get_session(app="tablewatch-sanitize")
    census = materialize(schema_census(spark, a.in_dir))
    report = sanitize(spark, a.in_dir, a.out_dir, a.overwrite, True, a.compression, a.dry_run)
    for row in report.orderBy("path", "column").toLocalIterator():
        print(*row, sep="\t")
    sanitize_summary(census, plan_casts(census)).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
