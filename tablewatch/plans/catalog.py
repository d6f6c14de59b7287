"""K10: ad-hoc SQL over registered tables and a catalog report.

The reference serves SQL through a Thrift server and lets a BI client list
tables, views and view definitions.  Here the same questions are a function
call in the session: ``run_sql`` and ``catalog_report`` (no server).
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident
from tablewatch.sources.files import PARQUET_GLOB, list_files
from tablewatch.sources.footers import read_footers

REPORT_SCHEMA = ("name string, kind string, n_columns int, n_files bigint, bytes bigint, "
                 "n_rows bigint, definition string")


def run_sql(spark: SparkSession, text: str, namespace: str | None = None) -> DataFrame:
    """``spark.sql`` with ``namespace`` as the current one while the text is
    analysed; the session's own is restored.  Consume with ``collect``,
    ``toLocalIterator`` (incremental) or a write."""
    if not namespace:
        return spark.sql(text)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(namespace)
    try:
        return spark.sql(text)
    finally:
        spark.catalog.setCurrentDatabase(before)


def _entries(spark: SparkSession, namespace: str | None) -> dict[str, str]:
    """Name -> catalog kind of what a namespace holds, temporary views aside."""
    found = spark.catalog.listTables(quote_ident(namespace)) if namespace else []
    return {t.name: t.tableType for t in found if not t.isTemporary}


def list_tables(spark: SparkSession, namespace: str | None) -> list[str]:
    """Names of tables and views (empty namespace -> empty list)."""
    return sorted(_entries(spark, namespace))


def list_views(spark: SparkSession, namespace: str | None) -> list[str]:
    return sorted(n for n, kind in _entries(spark, namespace).items() if kind == "VIEW")


def definition(spark: SparkSession, namespace: str | None, name: str) -> str | None:
    """CREATE statement of a table or view; NULL where the catalog has none."""
    ident = quote_ident(*filter(None, (namespace, name)))
    if not spark.catalog.tableExists(ident):
        return None
    try:
        return spark.sql(f"SHOW CREATE TABLE {ident}").first()["createtab_stmt"]
    except (AnalysisException, SparkRuntimeException):  # what SQL cannot express
        return None


STATS = ["name", "n_columns", "n_files", "bytes", "n_rows"]


def _plain(path: Column) -> Column:
    """A path as tables and listings both write it."""
    return F.regexp_replace(F.regexp_replace(path, "^file:/+", "/"), "/+$", "")


def _listing(spark: SparkSession, locations: list[str]) -> tuple[DataFrame | None, list[str]]:
    """Files of all locations that are there, and those locations.  One
    listing; only where some location is gone is each looked up by itself."""
    try:
        return list_files(spark, locations, PARQUET_GLOB), locations
    except AnalysisException:
        if len(locations) == 1:
            return None, []
        there = [one for one in locations if _listing(spark, [one])[1]]
        return (list_files(spark, there, PARQUET_GLOB) if there else None), there


def _stored_stats(spark: SparkSession, stored: list[tuple[str, int, str]]) -> DataFrame:
    """STATS of the tables (name, n_columns, location) over Parquet files: one
    listing, one reading of footers and one aggregate for all of them.  A file
    belongs to every table whose location is one of its folders.  A table whose
    location is gone has NULL counts."""
    tables = spark.createDataFrame(stored, "name string, n_columns int, location string") \
        .withColumn("_at", _plain(F.col("location")))
    listed, there = _listing(spark, sorted({location for _, _, location in stored}))
    if listed is None:
        none = F.lit(None).cast("bigint")
        return tables.select("name", "n_columns", none.alias("n_files"), none.alias("bytes"), none.alias("n_rows"))
    files = listed.groupBy("path").agg(F.max("size").alias("size"))
    parts = F.split(_plain(F.col("path")), "/")
    folders = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    known = files.join(read_footers(spark, files).select("path", "n_rows"), "path", "left")
    sums = known.withColumn("_in", F.explode(folders)).join(tables.select("name", "_at"), F.col("_in") == F.col("_at")) \
        .groupBy("name").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"), F.sum("n_rows").alias("n_rows"))
    # An empty folder counts nothing; a folder that is not there is unknown.
    empty = F.when(F.col("location").isin(there), F.lit(0))
    return tables.join(sums, "name", "left").select(
        "name", "n_columns", F.coalesce("n_files", empty).cast("bigint").alias("n_files"),
        F.col("bytes").cast("bigint").alias("bytes"), F.coalesce("n_rows", empty).cast("bigint").alias("n_rows"))


def _counted_stats(df: DataFrame, name: str, is_view: bool) -> DataFrame:
    """STATS of a view, or of a table over other files, by counting."""
    if is_view:
        none = F.lit(None).cast("bigint")
        sums = df.agg(none.alias("n_files"), none.alias("bytes"), F.count(F.lit(1)).alias("n_rows"))
    else:
        sums = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")) \
            .groupBy("p", "s").count().agg(F.count(F.lit(1)).alias("n_files"), F.sum("s").cast("bigint").alias("bytes"),
                                           F.sum("count").cast("bigint").alias("n_rows"))
    return sums.select(F.lit(name).alias("name"), F.lit(len(df.columns)).cast("int").alias("n_columns"),
                       "n_files", "bytes", "n_rows")


def parquet_location(spark: SparkSession, namespace: str, name: str) -> str | None:
    """Where a Parquet table's files are; None for other tables."""
    rows = {r[0]: r[1] for r in
            spark.sql(f"DESCRIBE TABLE EXTENDED {quote_ident(namespace, name)}").collect()}
    return rows.get("Location") if (rows.get("Provider") or "").lower() == "parquet" else None


def catalog_report(spark: SparkSession, namespace: str) -> DataFrame:
    """name, kind ('table'/'view'), n_columns, n_files, bytes, n_rows,
    definition for every table and view of ``namespace``.  All tables over
    Parquet files share one listing and one reading of footers, whatever their
    number; a view is counted.  A view whose table is gone, and a table whose
    folder is gone, keep their definition with NULL counts."""
    kinds = {name: "view" if kind == "VIEW" else "table" for name, kind in _entries(spark, namespace).items()}
    stored, frames, broken, texts = [], [], [], []
    for name in sorted(kinds):
        texts.append((name, kinds[name], definition(spark, namespace, name)))
        try:
            df = spark.table(quote_ident(namespace, name))
            location = parquet_location(spark, namespace, name) if kinds[name] == "table" else None
            if location:
                stored.append((name, len(df.columns), location))
            else:
                frames.append(_counted_stats(df, name, kinds[name] == "view"))
        except Exception:  # noqa: BLE001 - e.g. a view over a dropped table
            broken.append((name, None, None, None, None))
    if stored:
        frames.append(_stored_stats(spark, stored))
    if broken:
        frames.append(spark.createDataFrame(broken, "name string, n_columns int, n_files bigint, bytes bigint, n_rows bigint"))
    if not frames:
        return spark.createDataFrame([], REPORT_SCHEMA)
    known = spark.createDataFrame(texts, "name string, kind string, definition string")
    return known.join(reduce(DataFrame.unionByName, frames), "name") \
        .select("name", "kind", *STATS[1:], "definition")
