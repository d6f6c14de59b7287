"""Append of new files by a committed manifest.

The manifest is a table of the files taken in so far: path, size, modified,
n_rows, batch.  A run lists the source, finds the files the manifest does not
hold by an anti join, reads their row counts from the footers, writes their
rows as one batch of the sink, and only then commits the batch by writing its
manifest rows.  A batch without manifest rows does not exist for readers, so a
run that died between the two is simply repeated: its files are still new.  An
idle run writes nothing.  Paths stay in tables; the driver sees one batch id.
A file that was written anew (other size or time) counts as new.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.sources.files import PARQUET_GLOB, list_files
from tablewatch.sources.footers import read_footers
from tablewatch.operators.joins import materialize_observed

MANIFEST_SCHEMA = "path string, size bigint, modified timestamp, n_rows bigint, batch string"
_KEY = ("path", "size", "modified")


def manifest_of(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The committed files of a sink (none before its first commit)."""
    where = f"{sink_dir.rstrip('/')}/manifest"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(where)


def stage(spark: SparkSession, source_dir: str, sink_dir: str) -> tuple[str, DataFrame, int] | None:
    """Writes the rows of new files as a batch that is not committed yet.
    Returns (batch, its manifest rows, rows); None where nothing is new."""
    known = manifest_of(spark, sink_dir).select(*[F.col(c).alias(f"k_{c}") for c in _KEY])
    files = list_files(spark, source_dir, PARQUET_GLOB)
    same = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in _KEY]
    new = files.join(known, same[0] & same[1] & same[2], "left_anti")
    counts = read_footers(spark, new).select(F.col("path").alias("f_path"), "n_rows", "error")
    new, m = materialize_observed(new.join(counts, F.col("path") == F.col("f_path"), "left").drop("f_path"),
                                  files=F.count(F.lit(1)), rows=F.sum("n_rows"), oldest=F.min("modified"),
                                  bad=F.max(F.when(F.col("error").isNotNull(), F.concat_ws(": ", "path", "error"))))
    if not m["files"]:
        return None
    if m["bad"]:
        raise ValueError(f"unreadable file, nothing was appended: {m['bad']}")
    batch = uuid.uuid4().hex
    # Files older than the oldest new one are not even listed; the join takes exactly the new ones.
    oldest = m["oldest"].replace(microsecond=0)
    rows = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", PARQUET_GLOB)
            .option("modifiedAfter", _second_before(oldest)).parquet(source_dir))
    name = "_tw_path"
    taken = rows.withColumn(name, F.col("_metadata.file_path")).join(
        new.select(F.col("path").alias("_tw_new")), F.col(name) == F.col("_tw_new"), "left_semi").drop(name)
    taken.write.parquet(f"{sink_dir.rstrip('/')}/data/batch={batch}")
    return batch, new.select(*_KEY, "n_rows", F.lit(batch).alias("batch")), int(m["rows"] or 0)


def _second_before(moment) -> str:
    from datetime import timedelta
    return (moment - timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")


def commit(staged: tuple[str, DataFrame, int], sink_dir: str) -> int:
    """Makes a staged batch visible; returns its rows."""
    _, rows, n = staged
    rows.write.mode("append").parquet(f"{sink_dir.rstrip('/')}/manifest")
    return n


def append_new_files(spark: SparkSession, source_dir: str, sink_dir: str) -> int:
    """Appends the rows of files that the sink's manifest does not hold;
    returns how many rows that were (exact, from the footers)."""
    staged = stage(spark, source_dir, sink_dir)
    return commit(staged, sink_dir) if staged else 0


def appended(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The rows of all committed batches."""
    base = f"{sink_dir.rstrip('/')}/data"
    batches = [r["batch"] for r in manifest_of(spark, sink_dir).select("batch").distinct().collect()]  # one a run
    if not batches:
        raise ValueError(f"{sink_dir} has no committed batch")
    return spark.read.option("basePath", base).parquet(*[f"{base}/batch={b}" for b in batches]).drop("batch")
