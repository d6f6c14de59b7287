"""S2/S3: file discovery through Spark's own (parallel) file listing.

``binaryFile`` lists files with their size; as long as the ``content``
column is not selected no file body is read.  Recursive lookup turns off
partition inference, so folder names like ``year=2025`` stay plain folders.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted Parquet extensions, case-insensitive (fixed values):
#   .parquet  .prq
PARQUET_EXTENSIONS = (".parquet", ".prq")
# The same rule as a Hadoop glob; a plain *.{parquet,prq} would miss b.PRQ.
PARQUET_GLOB = "*.{[pP][aA][rR][qQ][uU][eE][tT],[pP][rR][qQ]}"


def qualify(root: str) -> str:
    """Absolute form of a local root given relative to the working
    directory; URIs (file:, hdfs:, s3a:, ...) are returned unchanged."""
    if ":" in root.split("/")[0] or os.path.isabs(root):
        return root.rstrip("/") or "/"
    return os.path.abspath(root)


def is_parquet_path(path: Column) -> Column:
    low = F.lower(path)
    return low.endswith(PARQUET_EXTENSIONS[0]) | low.endswith(PARQUET_EXTENSIONS[1])


def list_files(spark: SparkSession, root: str | list[str], glob: str | None = None) -> DataFrame:
    """Every file under ``root`` (one folder or several, listed together) at
    any depth: path, size, modified.  ``glob`` filters file names (e.g.
    ``PARQUET_GLOB``)."""
    root = qualify(root) if isinstance(root, str) else [qualify(r) for r in root]
    reader = (spark.read.format("binaryFile").option("recursiveFileLookup", "true"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def with_relative(files: DataFrame, root: str) -> DataFrame:
    """Add ``rel`` (path below root), ``folder`` (first component, NULL for
    files directly in the root) and ``rel_dir`` (folder part of ``rel``)."""
    base = qualify(root).rstrip("/")
    # Spark reports absolute, scheme-qualified paths; strip through the root.
    tail = F.regexp_extract(F.col("path"), r".*?" + _re_escape(_strip_scheme(base)) + r"/(.*)$",
                            1)
    parts = F.split(tail, "/")
    n = F.size(parts)
    return (files.withColumn("rel", tail)
            .withColumn("folder", F.when(n > 1, F.element_at(parts, 1)))
            .withColumn("rel_dir", F.when(n > 1, F.array_join(F.slice(parts, 1, n - 1), "/"))
                        .otherwise(F.lit(""))))


def _strip_scheme(p: str) -> str:
    if p.startswith("file:"):
        p = p[5:]
        while p.startswith("//"):
            p = p[1:]
    elif "://" in p:
        p = p.split("://", 1)[1]
        p = p[p.index("/"):] if "/" in p else ""
    return p


def _re_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?{}[]\|()" else ch)
    return "".join(out)


def list_subfolders(spark: SparkSession, root: str) -> list[str] | None:
    """Names of the directories directly under ``root`` (empty ones too),
    through Hadoop's FileSystem of the session: one metadata call, no file
    content.  ``None`` when the JVM gateway is not reachable (e.g. a Spark
    Connect session); callers then derive folders from the file listing."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(conf)
        return sorted(st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory())
    except Exception:  # noqa: BLE001 - fall back to the file listing
        return None
