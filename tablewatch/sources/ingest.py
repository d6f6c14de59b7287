"""K8: every immediate sub-folder of a data folder becomes one table.

* Discovery (S2-S4): Spark's parallel file listing; files directly in the
  root are ignored; a folder without Parquet files is reported and skipped.
* Manifest (S7): per file path, size, row count from the footer, format —
  read by the distributed footer census, no data pages are touched.
* Registration (S5/S6/S9): an external, unpartitioned Parquet table over
  the folder (``recursiveFileLookup`` + case-insensitive extension glob), no
  copy.  Re-running is idempotent: the table is refreshed, not appended to
  again (the reference appends every file a second time).  Two folders whose
  names differ only by case share one table name: each gets its own table
  and the shared name becomes a UNION ALL view over them.
* Files of several schemas (U2): the table takes the least type of every column
  that all files can be read as; a column some files lack is NULL there.
* Summary (S8): folder, table, n_files, n_rows, status, error.  One
  unreadable file fails its whole folder; the other folders continue.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewatch.functions.exprs import quote_ident
from tablewatch.operators.joins import materialize
from tablewatch.sources.files import (PARQUET_GLOB, _strip_scheme, is_parquet_path, list_files,
                                      list_subfolders, qualify, with_relative)
from tablewatch.sources.footers import read_footers
from tablewatch.sources.widen import column_types, ddl, widened_schema

SUMMARY_SCHEMA = ("folder string, table string, n_files bigint, n_rows bigint, status string, "
                  "error string")


def file_manifest(spark: SparkSession, root: str, listing: DataFrame | None = None) -> DataFrame:
    """folder, table, path, size, n_rows, format, error for every Parquet file
    under an immediate sub-folder of ``root`` (and its footer's schema as text
    and as fields).  ``listing``: a file listing
    with relative paths already taken (reused instead of listing again)."""
    if listing is None:
        listing = with_relative(list_files(spark, root, PARQUET_GLOB), root)
    files = listing.filter(F.col("folder").isNotNull() & is_parquet_path(F.col("path")))
    foot = read_footers(spark, files)
    schema = F.array_join(F.transform("fields", lambda f: F.concat_ws(
        ":", f["name"], f["arrow_type"])), ",")
    return (files.join(foot, "path", "left")
            .select("folder",
                    F.regexp_replace(F.lower("folder"), "[^0-9a-z_]", "_").alias("table"),
                    "path", "size", "n_rows",
                    F.lit("PARQUET").alias("format"), schema.alias("schema"), "error", "fields"))


def table_name(folder: str) -> str:
    """Lower-cased folder name (the reference's rule); characters the session
    catalog does not accept in a table name become '_'."""
    name = re.sub(r"[^0-9a-z_]", "_", folder.lower())
    return name or "_"


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_ident(namespace)}")


def _location(spark: SparkSession, namespace: str, table: str) -> str | None:
    if not spark.catalog.tableExists(quote_ident(namespace, table)):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_ident(namespace, table)}").collect()
    for r in rows:
        if r[0] == "Location":
            return r[1]
    return None


def _norm(path: str) -> str:
    return _strip_scheme(path).rstrip("/")


def _register(spark: SparkSession, namespace: str, table: str, path: str, schema: StructType | None = None) -> str:
    """``schema``: what the table's files widen to, if they differ; a table
    whose columns no longer are these is made anew (its files stay)."""
    ident = quote_ident(namespace, table)
    current = _location(spark, namespace, table)
    if current is not None and (_norm(current) != _norm(path) or (
            schema is not None and ddl(spark.table(ident).schema) != ddl(schema))):
        spark.sql(f"DROP TABLE IF EXISTS {ident}")
        current = None
    if current is None:
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        columns = f"({ddl(schema)})" if schema is not None else ""
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {ident} {columns} USING parquet
                      OPTIONS (recursiveFileLookup 'true', pathGlobFilter '{PARQUET_GLOB}')
                      LOCATION '{escaped}'""")
        return "created"
    spark.sql(f"REFRESH TABLE {ident}")
    return "refreshed"


def register_folders(spark: SparkSession, root: str, namespace: str = "nyc") -> DataFrame:
    """Register every sub-folder of ``root`` as ``namespace.<lower-case folder
    name>``; returns the summary.  The namespaces ``namespace`` and
    ``default`` are created if absent."""
    root = qualify(root)
    ensure_namespace(spark, namespace)
    ensure_namespace(spark, "default")
    listing = materialize(with_relative(list_files(spark, root), root)
                          .filter(F.col("folder").isNotNull()))
    counted = {r["folder"]: r["n_parquet"] for r in listing.groupBy("folder")
               .agg(F.count_if(is_parquet_path(F.col("path"))).alias("n_parquet")).collect()}
    names = list_subfolders(spark, root)
    if names is None:
        names = sorted(counted)
    hidden = [n for n in names if n.startswith((".", "_"))]
    folders = [{"folder": n, "n_parquet": counted.get(n, 0)} for n in names if n not in hidden]
    manifest = materialize(file_manifest(spark, root, listing))
    per_folder = {r["folder"]: r for r in manifest.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.first("error", ignorenulls=True).alias("error"),
        F.first(F.when(F.col("error").isNotNull(), F.col("path")), ignorenulls=True).alias("bad"),
        F.count_distinct("schema").alias("n_schemas"),
    ).collect()}
    mixed = [n for n, m in per_folder.items() if m["n_schemas"] > 1 and m["error"] is None]
    types = column_types(spark, manifest.filter(F.col("folder").isin(mixed))) if mixed else {}
    by_table: dict[str, list[tuple]] = {}
    summary = [(n, None, 0, 0, "skipped", "hidden: the name starts with '.' or '_'") for n in hidden]
    for f in folders:
        name = f["folder"]
        table = table_name(name)
        m = per_folder.get(name)
        if f["n_parquet"] == 0 or m is None:
            summary.append((name, None, 0, 0, "skipped", "no parquet files"))
            continue
        if m["error"] is not None:
            summary.append((name, table, m["n_files"], None, "error", f"{m['bad']}: {m['error']}"))
            continue
        path = f"{root.rstrip('/')}/{name}"
        try:
            schema = widened_schema(spark, types[name]) if name in types else None
        except ValueError as e:
            summary.append((name, table, m["n_files"], None, "error", str(e)))
            continue
        by_table.setdefault(table, []).append((name, path, m, schema))

    def note(m):
        return f"mixed schemas: {m['n_schemas']} distinct" if m["n_schemas"] > 1 else None
    for table, entries in by_table.items():
        summary += _register_all(spark, namespace, table, entries, set(by_table), note)
    return spark.createDataFrame(summary, SUMMARY_SCHEMA)


def _register_all(spark: SparkSession, namespace: str, table: str, entries: list[tuple],
                  taken: set[str], note) -> list[tuple]:
    """Registers the folders that share one table name; one summary row each.
    A single folder is a table.  Several folders are tables of their own below
    a view that unions them by column name.  What an earlier run left under
    these names in the other form is dropped first."""
    if len(entries) == 1:
        name, path, m, schema = entries[0]
        try:
            _drop(spark, namespace, table, "VIEW")
            for part in _part_names(table, taken, 1000, spark, namespace):
                _drop(spark, namespace, part, "TABLE")
            status = _register(spark, namespace, table, path, schema)
            return [(name, table, m["n_files"], m["n_rows"], status, note(m))]
        except Exception as e:  # noqa: BLE001 - reported, other folders continue
            return [(name, table, m["n_files"], None, "error", str(e))]
    rows, parts = [], []
    for part, (name, path, m, schema) in zip(_part_names(table, taken, len(entries)), sorted(entries, key=lambda x: x[0])):
        try:
            status = _register(spark, namespace, part, path, schema)
            parts.append(part)
            rows.append((name, table, m["n_files"], m["n_rows"], status, note(m)))
        except Exception as e:  # noqa: BLE001
            rows.append((name, table, m["n_files"], None, "error", str(e)))
    try:
        _drop(spark, namespace, table, "TABLE")
        if parts:
            columns = {p: spark.table(quote_ident(namespace, p)).columns for p in parts}
            every = list(dict.fromkeys(c for cs in columns.values() for c in cs))
            union = " UNION ALL ".join(
                "SELECT " + ", ".join(quote_ident(c) if c in columns[p] else f"NULL AS {quote_ident(c)}" for c in every)
                + f" FROM {quote_ident(namespace, p)}" for p in parts)
            spark.sql(f"CREATE OR REPLACE VIEW {quote_ident(namespace, table)} AS {union}")
    except Exception as e:  # noqa: BLE001
        rows = [(r[0], table, r[2], None, "error", r[5] if r[4] == "error" else str(e)) for r in rows]
    return rows


def _part_names(table: str, taken: set[str], n: int, spark: SparkSession | None = None,
                namespace: str | None = None) -> list[str]:
    """Names for the tables below a shared name, none of them a folder's own;
    with a session, only those that exist."""
    names = [f"{table}__part{i}" for i in range(n)]
    free = [x if x not in taken else f"{x}_" for x in names]
    if spark is None:
        return free
    known = {t.name for t in spark.catalog.listTables(quote_ident(namespace))}
    return [x for x in free if x in known]


def _drop(spark: SparkSession, namespace: str, name: str, kind: str) -> None:
    """Drops a table or view of that name if it is of that kind."""
    ident = quote_ident(namespace, name)
    if spark.catalog.tableExists(ident):
        is_view = spark.catalog.getTable(ident).tableType == "VIEW"
        if is_view == (kind == "VIEW"):
            spark.sql(f"DROP {kind} IF EXISTS {ident}")


def create_table(spark: SparkSession, name: str, schema: str, replace: bool = True,
                 namespace: str | None = None) -> str:
    """S10: drop-and-recreate an empty, unpartitioned table with an explicit
    schema, e.g. ``create_table(spark, "table_name", "id INT NOT NULL, data
    STRING", namespace="namespace")``."""
    if namespace:
        ensure_namespace(spark, namespace)
    ident = quote_ident(namespace, name) if namespace else quote_ident(name)
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {ident}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ident} ({schema}) USING parquet")
    return ident


def main(argv: list[str] | None = None) -> None:
    """python -m tablewatch.sources.ingest DATA_DIR [--namespace nyc]"""
    import argparse

    from tablewatch.session import get_session
    ap = argparse.ArgumentParser(description="Register every sub-folder as a Parquet table.")
    ap.add_argument("root")
    ap.add_argument("--namespace", default="nyc")
    a = ap.parse_args(argv)
    spark = get_session(app="tablewatch-ingest")
    for row in register_folders(spark, a.root, a.namespace).toLocalIterator():
        print(*row, sep="\t")
    spark.stop()


if __name__ == "__main__":
    main()
