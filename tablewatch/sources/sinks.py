"""S14-S16: result sinks, console quick-look, incremental and resumable fetch."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident

# Output folder names of the seven results (fixed values, they are the
# reference job's output layout).
RESULT_NAMES = (
    "temp_outliers_zscore",
    "temp_suspects_topk",
    "temp_outliers_iqr",
    "temp_outliers_kmeans",
    "temp_outliers_knn",
    "iqr_bounds",
    "iqr_outliers_detailed",
)


def write_result(df: DataFrame, path: str, n_files: int | None = None, mode: str = "overwrite",
                 compression: str = "snappy") -> None:
    """Parquet, overwrite by default.  The reference forces one file per
    output (``coalesce(1)``), which funnels the whole result through one task;
    here ``n_files`` is opt-in and otherwise every task writes its own file."""
    if n_files:
        df = df.coalesce(n_files)
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_all(results: dict[str, DataFrame], out_dir: str, n_files: int | None = None,
              mode: str = "overwrite") -> dict[str, str]:
    paths = {}
    for name, df in results.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        write_result(df, path, n_files, mode)
        paths[name] = path
    return paths


# The five views, the output each one shows and the measure it
# is sorted by (none: by system).
VIEWS = {"kmeans_top": ("kmeans_scores", "km_dist"), "knn_top": ("temp_outliers_knn", "knn_dist"), "iqr_bounds": ("iqr_bounds", None),
         "iqr_top": ("iqr_outliers_detailed", "dist_from_bound"), "zscore_top": ("temp_outliers_zscore", "abs_z")}


def quicklook(results: dict[str, DataFrame], cols, scores: dict[str, DataFrame] | None = None,
              limit: int = 100, digits: int | None = None) -> dict[str, DataFrame]:
    """The five console views, as ordered, limited frames (each a
    TakeOrderedAndProject, never a global sort).  Rows of equal measure, after
    rounding to ``digits`` if given, follow system, time and tie-break columns."""
    frames = {**results, **(scores or {})}
    out = {}
    for view, (name, measure) in VIEWS.items():
        if name not in frames:
            continue
        df = frames[name]
        order = [F.col(quote_ident(c)).asc_nulls_first() for c in (cols.sys, cols.ts, *cols.tie_break) if c in df.columns]
        if measure:
            order.insert(0, (F.round(measure, digits) if digits is not None else F.col(measure)).desc_nulls_last())
        df = df.orderBy(*order).limit(limit)
        if view == "kmeans_top":
            df = df.select(*(quote_ident(c) for c in (cols.sys, cols.ts, cols.x, *cols.tie_break)), "z", "cluster", "km_dist")
        out[view] = df
    return out


def fetch_incremental(df: DataFrame, prefetch: bool = True) -> Iterator[Row]:
    """Stream a result to the client one partition at a time (the query
    server's incremental collect)."""
    return df.toLocalIterator(prefetchPartitions=prefetch)


_AT = "__at"


def stage_pages(df: DataFrame, path: str, order: list[str]) -> None:
    """Computes a result once, for fetching page by page: rows are dealt by
    ranges of ``order``, sorted within a range and written with their place
    (range number and row in it, one growing number), and the ranges' row
    counts beside them.  Does nothing where that was done before; what a
    broken run left is written anew."""
    spark = df.sparkSession
    if staged(spark, path):
        return
    keys = [F.col(quote_ident(c)).asc_nulls_first() for c in order]
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_AT, F.monotonically_increasing_id())
     .write.mode("overwrite").parquet(f"{path}/rows"))
    (spark.read.parquet(f"{path}/rows").groupBy(F.shiftright(_AT, 33).alias("part")).agg(F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").parquet(f"{path}/parts"))


def staged(spark: SparkSession, path: str) -> bool:
    """Whether a result was staged to the end: the counts are written last."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/parts/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def fetch_page(spark: SparkSession, path: str, cursor: int = 0, rows: int = 10_000) -> tuple[DataFrame, int | None]:
    """(page, next cursor) of a staged result: ``rows`` rows in order from row
    ``cursor`` on; the next cursor is None at the end.  A page is one interval
    of places, which Parquet statistics narrow down to its row groups, so a
    client that comes back with its last cursor costs one page."""
    whole = spark.read.parquet(f"{path}/rows")
    first = at = None
    begin = 0  # rows before the range; there are as many ranges as shuffle partitions
    for part, n in spark.read.parquet(f"{path}/parts").orderBy("part").collect():
        if first is None and cursor < begin + n:
            first = (part << 33) + cursor - begin
        if cursor + rows > begin:
            at = (part << 33) + min(cursor + rows - begin, n)
        begin += n
    page = whole.filter(F.col(_AT).between(first, at - 1)) if first is not None and rows > 0 else whole.limit(0)
    return page.orderBy(_AT).drop(_AT), cursor + rows if cursor + rows < begin else None


def fetch_pages(spark: SparkSession, path: str, cursor: int = 0, rows: int = 10_000) -> Iterator[tuple[DataFrame, int | None]]:
    """The pages from ``cursor`` to the end."""
    at: int | None = cursor
    while at is not None:
        page, at = fetch_page(spark, path, at, rows)
        yield page, at
