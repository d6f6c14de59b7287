"""

Every query reads the given tables (or data Spark derives from them) in
full.  Double outputs are rounded to 6 decimals on both sides and rank keys
to 9, so that two engines that sum in a different order agree.

Column roles used throughout:
  events   by user:   system=user_id,    time=ts,         feature=value,           tie=event_id
  events   by type:   system=event_type, time=ts,         feature=value,           tie=event_id
  lineitem by supp:   system=l_suppkey,  time=l_shipdate, feature=l_extendedprice,
                      tie=l_orderkey,l_linenumber,l_partkey
  lineitem by flag:   system=l_returnflag (3 hot keys, a third of the rows each), same roles,
                      tie=l_orderkey,l_linenumber,l_partkey,l_suppkey
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident, round_doubles
from tablewatch.operators import (absent_columns, input_profile, iqr_bounds, iqr_outliers, iqr_outliers_detailed,
                                  kmeans_anomalies, knn_exact, knn_exact_scores, knn_lsh,
                                  knn_lsh_scores, knn_time, knn_time_scores, prepare,
                                  sizes_from_stats, suspects_topk, system_sizes, zscore,
                                  zscore_outliers, zscore_with_stats)
from tablewatch.operators.grid import knn_grid
from tablewatch.params import Cols, Params, Scale
from tablewatch.plans.catalog import catalog_report, run_sql
from tablewatch.plans.detect import run as run_job
from tablewatch.session import library_on_workers, scratch_path
from tablewatch.sources.append import append_new_files, appended, stage
from tablewatch.sources.derived import epoch_micros, write_folders, write_uint64
from tablewatch.sources.footers import schema_census
from tablewatch.sources.ingest import create_table, file_manifest, register_folders
from tablewatch.sources.sanitize import plan_casts, sanitize, sanitize_summary
from tablewatch.sources.sinks import VIEWS, fetch_page, fetch_pages, stage_pages
from tablewatch.streaming.incremental import ingest_new_files

SMOKE_DIR = "/root/testdata/sf0.001"

# Two engines that add up in another order agree on ranks of values rounded to
# this many decimals; the operators themselves rank the raw values.
RANK_DIGITS = 9

EV = Cols("user_id", "ts", "value", ("event_id",))
ET = Cols("event_type", "ts", "value", ("event_id",))
# (l_orderkey, l_linenumber) repeats in these tables; with the part (and the
# supplier, the system of LI) the order is total.
LI = Cols("l_suppkey", "l_shipdate", "l_extendedprice", ("l_orderkey", "l_linenumber", "l_partkey"))
# Hot keys: three return flags, each holding a third of lineitem.
LR = Cols("l_returnflag", "l_shipdate", "l_extendedprice",
          ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))

# Small split sizes force the range-split (hot system) plans on the test
# tables; their answers must equal the single-window plans.
SPLIT_USER = Scale(split_rows=20, max_splits=8)
SPLIT_TYPE = Scale(split_rows=400, max_splits=64)
SPLIT_HOT = Scale(split_rows=4000, max_splits=64)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scored(spark: SparkSession, sf_dir: str, table: str, cols: Cols,
            scale: Scale = Scale()) -> DataFrame:
    return zscore(prepare(_table(spark, sf_dir, table), cols), cols, scale)


def _scored_sizes(spark: SparkSession, sf_dir: str, table: str, cols: Cols,
                  scale: Scale = Scale()):
    """Scored rows and the per-system counts of the z-score statistics (the
    KNN operators reuse them instead of counting again)."""
    s, stats = zscore_with_stats(prepare(_table(spark, sf_dir, table), cols), cols, scale)
    return s, sizes_from_stats(stats, cols)


# --------------------------------------------------------------------------
# Spark queries
# --------------------------------------------------------------------------

def q_zscore_scores(spark, sf_dir):
    s = _scored(spark, sf_dir, "events", EV)
    return round_doubles(s.select("user_id", "ts", "value", "event_id",
                                  "n", "mean_feat", "std_feat", "z", "abs_z"))


def q_zscore_outliers(spark, sf_dir):
    return round_doubles(zscore_outliers(_scored(spark, sf_dir, "events", EV), EV))


def q_zscore_outliers_lineitem(spark, sf_dir):
    return round_doubles(zscore_outliers(_scored(spark, sf_dir, "lineitem", LI), LI, z_thresh=1.5))


def q_zscore_outliers_by_type(spark, sf_dir):
    return round_doubles(zscore_outliers(_scored(spark, sf_dir, "events", ET), ET))


def q_suspects_topk(spark, sf_dir):
    return round_doubles(suspects_topk(_scored(spark, sf_dir, "events", EV), EV, 50, RANK_DIGITS))


def q_iqr_bounds(spark, sf_dir):
    return round_doubles(iqr_bounds(prepare(_table(spark, sf_dir, "events"), EV), EV))


def q_iqr_outliers_detailed(spark, sf_dir):
    return round_doubles(iqr_outliers_detailed(prepare(_table(spark, sf_dir, "events"), EV), EV))


def q_iqr_outliers(spark, sf_dir):
    return round_doubles(iqr_outliers(prepare(_table(spark, sf_dir, "events"), EV), EV))


def q_iqr_bounds_lineitem(spark, sf_dir):
    return round_doubles(iqr_bounds(prepare(_table(spark, sf_dir, "lineitem"), LI), LI))


def q_kmeans_anomalies(spark, sf_dir):
    s = _scored(spark, sf_dir, "events", EV)
    return round_doubles(kmeans_anomalies(s, EV, k=2, pr_cutoff=0.99, rank_digits=RANK_DIGITS))


def q_knn_time_scores(spark, sf_dir):
    return round_doubles(knn_time_scores(_scored(spark, sf_dir, "events", EV), EV, 5))


def q_knn_time_outliers(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "events", EV)
    return round_doubles(knn_time(s, EV, 5, 0.99, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_time_outliers_split(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "events", EV, SPLIT_USER)
    return round_doubles(knn_time(s, EV, 5, 0.99, scale=SPLIT_USER, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_time_outliers_by_type(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "events", ET, SPLIT_TYPE)
    return round_doubles(knn_time(s, ET, 5, 0.99, scale=SPLIT_TYPE, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_time_outliers_lineitem(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "lineitem", LI)
    return round_doubles(knn_time(s, LI, 5, 0.99, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_exact_outliers(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "events", EV)
    return round_doubles(knn_exact(s, EV, 5, 0.99, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_exact_outliers_by_type(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "events", ET, SPLIT_TYPE)
    return round_doubles(knn_exact(s, ET, 5, 0.99, scale=SPLIT_TYPE, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_lsh_outliers(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "events", EV)
    return round_doubles(knn_lsh(s, EV, 5, 0.99, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_split_outliers(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "events", EV)
    return round_doubles(knn_lsh(s, EV, 5, 0.99, max_group_rows=65, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_lsh_outliers_by_type(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "events", ET, SPLIT_TYPE)
    return round_doubles(knn_lsh(s, ET, 5, 0.99, scale=SPLIT_TYPE, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_exact_scores(spark, sf_dir):
    return round_doubles(knn_exact_scores(_scored(spark, sf_dir, "events", EV), EV, 5))


def q_knn_lsh_scores(spark, sf_dir):
    return round_doubles(knn_lsh_scores(_scored(spark, sf_dir, "events", EV), EV, 5))


def q_iqr_outliers_detailed_lineitem(spark, sf_dir):
    # Uniform prices leave nothing outside 1.5 IQR; a 0.5 multiplier does.
    return round_doubles(iqr_outliers_detailed(prepare(_table(spark, sf_dir, "lineitem"), LI),
                                               LI, mult=0.5))


def q_suspects_topk_lineitem(spark, sf_dir):
    return round_doubles(suspects_topk(_scored(spark, sf_dir, "lineitem", LI), LI, 50, RANK_DIGITS))


def q_zscore_outliers_hot(spark, sf_dir):
    s = _scored(spark, sf_dir, "lineitem", LR, SPLIT_HOT)
    return round_doubles(zscore_outliers(s, LR, z_thresh=1.5))


def q_iqr_bounds_hot(spark, sf_dir):
    return round_doubles(iqr_bounds(prepare(_table(spark, sf_dir, "lineitem"), LR), LR,
                                    scale=SPLIT_HOT))


def q_iqr_bounds_exact(spark, sf_dir):
    # Every system beyond split_rows: the bracketed quantile plan throughout.
    return round_doubles(iqr_bounds(prepare(_table(spark, sf_dir, "events"), EV), EV,
                                    scale=SPLIT_USER))


def q_knn_time_outliers_hot(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "lineitem", LR, SPLIT_HOT)
    return round_doubles(knn_time(s, LR, 5, 0.99, scale=SPLIT_HOT, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_exact_outliers_hot(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "lineitem", LR, SPLIT_HOT)
    return round_doubles(knn_exact(s, LR, 5, 0.99, scale=SPLIT_HOT, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_lsh_outliers_hot(spark, sf_dir):
    s, sizes = _scored_sizes(spark, sf_dir, "lineitem", LR, SPLIT_HOT)
    return round_doubles(knn_lsh(s, LR, 5, 0.99, scale=SPLIT_HOT, sizes=sizes, rank_digits=RANK_DIGITS))


def q_knn_grid2_outliers(spark, sf_dir):
    """Neighbours in two standardised features, price and quantity."""
    li = prepare(_table(spark, sf_dir, "lineitem"), LI)
    got = knn_grid(li.withColumn("l_quantity", F.col("l_quantity").cast("double")), LI,
                   ["l_extendedprice", "l_quantity"], 5, 0.99, rank_digits=RANK_DIGITS)
    return round_doubles(got)


def q_input_profile(spark, sf_dir):
    return input_profile(prepare(_table(spark, sf_dir, "events"), EV), EV)


def q_small_big_systems(spark, sf_dir):
    return system_sizes(_table(spark, sf_dir, "events"), EV, max_group_rows=65)


def _namespace() -> str:
    return f"tw_{uuid.uuid4().hex[:10]}"


def _ingest_tree(spark, sf_dir) -> str:
    """events / lineitem / orders as three folders (mixed case, nested)."""
    root = scratch_path(spark, "ingest")
    write_folders({
        "Events": _table(spark, sf_dir, "events"),
        "lineitem/2024/q1": _table(spark, sf_dir, "lineitem"),
        "orders": _table(spark, sf_dir, "orders"),
    }, root)
    return root


def q_folder_ingest_summary(spark, sf_dir):
    summary = register_folders(spark, _ingest_tree(spark, sf_dir), _namespace())
    return summary.select("table", "n_rows", "status")


def q_file_manifest(spark, sf_dir):
    m = file_manifest(spark, _ingest_tree(spark, sf_dir))
    return m.groupBy("table").agg(F.sum("n_rows").cast("bigint").alias("n_rows"),
                                  F.count_if(F.col("error").isNotNull()).alias("n_bad"))


def q_sql_by_system(spark, sf_dir):
    ns = _namespace()
    register_folders(spark, _ingest_tree(spark, sf_dir), ns)
    return run_sql(spark, "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total_value "
                          "FROM events GROUP BY user_id", namespace=ns)


def q_catalog_report(spark, sf_dir):
    ns = _namespace()
    root = _ingest_tree(spark, sf_dir)
    register_folders(spark, root, ns)
    spark.sql(f"CREATE OR REPLACE VIEW {quote_ident(ns, 'big_events')} AS "
              f"SELECT * FROM {quote_ident(ns, 'events')} WHERE value > 50")
    spark.sql(f"CREATE TABLE {quote_ident(ns, 'gone')} USING parquet "
              f"LOCATION '{root}/orders'")
    spark.sql(f"CREATE OR REPLACE VIEW {quote_ident(ns, 'orphan_view')} AS "
              f"SELECT * FROM {quote_ident(ns, 'gone')}")
    spark.sql(f"DROP TABLE {quote_ident(ns, 'gone')}")
    return catalog_report(spark, ns).select(
        "name", "kind", "n_columns", "n_rows", F.col("definition").isNotNull().alias("defined"),
        F.coalesce(F.col("n_files") > 0, F.lit(False)).alias("has_files"),
        F.coalesce(F.col("bytes") > 0, F.lit(False)).alias("has_bytes"))


def _sanitize_input(spark, sf_dir, unsigned: bool) -> str:
    """events with its ids unsigned (or its time a decimal), all columns."""
    ev = _table(spark, sf_dir, "events")
    root = scratch_path(spark, "sanitize-in")
    rest = [F.col(quote_ident(c)) for c in ev.columns if c not in ("event_id", "user_id", "ts")]
    micros = epoch_micros("ts") if unsigned else epoch_micros("ts").cast("decimal(20,0)")
    src = ev.select("event_id", "user_id", micros.alias("timestamp"), *rest)
    if unsigned:
        write_uint64(src, f"{root}/counters/2024", ["event_id", "user_id", "timestamp"],
                     required={"event_id": {"unit": "id"}}).collect()
    else:
        src.write.parquet(f"{root}/counters")
    return root


def _sanitized(spark, sf_dir, unsigned: bool) -> str:
    out = scratch_path(spark, "sanitize-out")
    sanitize(spark, _sanitize_input(spark, sf_dir, unsigned), out).count()
    return out


def _as_events(got: DataFrame) -> DataFrame:
    return round_doubles(got.withColumn("ts", F.col("timestamp").cast("timestamp_ntz")).drop("timestamp"))


def q_sanitize_timestamp(spark, sf_dir):
    return _as_events(spark.read.parquet(f"{_sanitized(spark, sf_dir, False)}/counters"))


def q_sanitize_decimal(spark, sf_dir):
    return _as_events(spark.read.parquet(f"{_sanitized(spark, sf_dir, True)}/counters/2024"))


def q_sanitize_footer(spark, sf_dir):
    """What the sanitised files store, from their footers, and their rows."""
    census = schema_census(spark, _sanitized(spark, sf_dir, True))
    return (census.filter(F.col("column").isin("event_id", "user_id", "timestamp"))
            .groupBy("rel_dir", "column", "arrow_type", "nullable", "field_metadata")
            .agg(F.sum("n_rows").cast("bigint").alias("n_rows")))


def q_sanitize_totals(spark, sf_dir):
    census = schema_census(spark, _sanitize_input(spark, sf_dir, unsigned=True))
    got = sanitize_summary(census, plan_casts(census))
    # Files follow the input's partitions; casts per changed file do not.
    return got.select((F.col("files_changed") == F.col("files_scanned")).alias("all_changed"),
                      (F.col("casts") / F.col("files_changed")).cast("int").alias("casts_per_file"))


def _typed_alike(spark, sf_dir, ts, unit="s"):
    ev = _table(spark, sf_dir, "events")
    src = ev.withColumns({"ts": ts, "value": F.col("value").cast("string")})
    return round_doubles(prepare(src, EV, ts_unit=unit)
                         .withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def q_prepare_strings(spark, sf_dir):
    return _typed_alike(spark, sf_dir, F.col("ts").cast("string"))


def q_prepare_epochs(spark, sf_dir):
    return _typed_alike(spark, sf_dir, epoch_micros("ts"), "us")


def q_create_table(spark, sf_dir):
    """Drop and recreate: only the last contents stay."""
    ns = _namespace()
    ev = _table(spark, sf_dir, "events")
    schema = ", ".join(f"{quote_ident(f.name)} {f.dataType.simpleString()}" for f in ev.schema)
    for part in (ev.limit(0).unionAll(ev), ev.filter("value > 50")):
        ident = create_table(spark, "copy", schema, namespace=ns)
        part.write.insertInto(ident)
    return round_doubles(spark.table(ident))


def q_detect_all_outputs(spark, sf_dir):
    """The whole job: its seven result folders, written and read again."""
    out = scratch_path(spark, "job")
    p = Params(input_path=f"{sf_dir}/events.parquet", feature="value", ts_col="ts", sys_col="user_id",
               tie_break=("event_id",), out_dir=out, rank_digits=RANK_DIGITS)
    paths = run_job(spark, p, show=False)["paths"]
    frames = []
    for name, measure in JOB_MEASURES.items():
        got = spark.read.parquet(paths[name])
        row = F.col("event_id") if "event_id" in got.columns else F.lit(-1).cast("bigint")
        frames.append(got.select(F.lit(name).alias("output"), "user_id", row.alias("event_id"),
                                 F.col(measure).cast("double").alias("measure")))
    return round_doubles(reduce(DataFrame.unionByName, frames))


def _job(spark, sf_dir) -> dict:
    return run_job(spark, Params(input_path=f"{sf_dir}/events.parquet", feature="value", ts_col="ts", sys_col="user_id",
                                 tie_break=("event_id",), out_dir=scratch_path(spark, "job"), rank_digits=RANK_DIGITS,
                                 print_limit=40), show=False)


def q_quicklook_views(spark, sf_dir):
    """The five console views of the job, 40 rows each."""
    frames = []
    for view, got in _job(spark, sf_dir)["views"].items():
        row = F.col("event_id") if "event_id" in got.columns else F.lit(-1).cast("bigint")
        measure = F.col(VIEWS[view][1] or "n_outliers").cast("double")
        frames.append(got.select(F.lit(view).alias("view"), "user_id", row.alias("event_id"), measure.alias("measure")))
    return round_doubles(reduce(DataFrame.unionByName, frames))


def q_fetch_pages(spark, sf_dir):
    """All events in five pages; the client leaves after two of them, and
    the result is staged again, to no effect, before it goes on."""
    path, order = scratch_path(spark, "pages"), ["user_id", "ts", "event_id"]
    ev = _table(spark, sf_dir, "events")
    rows = ev.count() // 5 + 1
    stage_pages(ev, path, order)
    early = [fetch_page(spark, path, k * rows, rows) for k in range(2)]
    stage_pages(ev.limit(0), path, order)
    pages = early + (list(fetch_pages(spark, path, early[-1][1], rows)) if early[-1][1] is not None else [])
    return round_doubles(reduce(DataFrame.unionByName, [p.withColumn("page", F.lit(k).cast("bigint")) for k, (p, _) in enumerate(pages)]))


def q_required_columns(spark, sf_dir):
    """Which tables the job takes, and the columns that the others lack."""
    frames = []
    for name, cols in (("events", EV), ("lineitem", LI), ("orders", EV), ("events", Cols("USER_ID", "ts", "value"))):
        df = _table(spark, sf_dir, name)
        lacking = absent_columns(df, [cols.sys, cols.ts, cols.x])
        try:
            rows = prepare(df, cols)
        except ValueError:
            rows = df.limit(0)
        frames.append(rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), F.lit(cols.sys).alias("system"), F.lit(",".join(lacking)).alias("lacking"), "n_rows"))
    return reduce(DataFrame.unionByName, frames)


def q_cast_plan(spark, sf_dir):
    root = _sanitize_input(spark, sf_dir, unsigned=True)
    return plan_casts(schema_census(spark, root)).select("rel_dir", "column", "from_type",
                                                         "to_type").distinct()


def q_schema_census(spark, sf_dir):
    """Columns and rows per folder; how many files hold them does not matter."""
    return (schema_census(spark, _ingest_tree(spark, sf_dir))
            .groupBy("folder", "rel_dir", "column")
            .agg(F.sum("n_rows").cast("bigint").alias("n_rows"),
                 F.count_if(F.col("error").isNotNull()).alias("n_bad"),
                 F.count_distinct("arrow_type").alias("n_types")))


def q_stream_ingest(spark, sf_dir):
    """Two arrivals of events files and one idle rerun, ingested exactly once."""
    ev = _table(spark, sf_dir, "events")
    src, sink, ckpt = (scratch_path(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    early = F.coalesce(F.col("event_type").isin("click", "view"), F.lit(False))
    counts = []
    for batch, part in ((1, ev.filter(early)), (2, ev.filter(~early)), (3, None)):
        if part is not None:
            part.write.parquet(f"{src}/batch={batch}")
        counts.append(ingest_new_files(spark, src, sink, ckpt, schema=ev.schema))
    return (spark.read.parquet(sink).groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))
            .withColumn("ingested", F.lit(sum(counts)).cast("bigint")))


def q_append_new_files(spark, sf_dir):
    """Two arrivals, a run that dies before its commit, its repetition and an
    idle run: every row once."""
    ev = _table(spark, sf_dir, "events")
    src, sink = scratch_path(spark, "append-src"), scratch_path(spark, "append-sink")
    early = F.coalesce(F.col("event_type").isin("click", "view"), F.lit(False))
    ev.filter(early).write.parquet(f"{src}/first")
    counts = [append_new_files(spark, src, sink)]
    ev.filter(~early).write.parquet(f"{src}/second")
    stage(spark, src, sink)  # staged, never committed
    counts += [append_new_files(spark, src, sink), append_new_files(spark, src, sink)]
    return (appended(spark, sink).groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))
            .withColumns({"ingested": F.lit(sum(counts)).cast("bigint"), "idle": F.lit(counts[-1]).cast("bigint")}))


def q_mixed_folder_rows(spark, sf_dir):
    """A folder whose files store user_id as int32, uint64 and int64, value as
    float or not at all, read back as one table."""
    ev = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    root, ns = scratch_path(spark, "mixed"), _namespace()
    kind = F.col("event_type")
    small, big = F.coalesce(kind == "click", F.lit(False)), F.coalesce(kind == "view", F.lit(False))
    write_folders({"Mixed/a": ev.filter(small).select("event_id", F.col("user_id").cast("int"), "event_type"),
                   "Mixed/c": ev.filter(~small & ~big)}, root)
    write_uint64(ev.filter(big).withColumn("value", F.col("value").cast("float")), f"{root}/Mixed/b", ["user_id"]).collect()
    done = register_folders(spark, root, ns).first()
    got = spark.table(quote_ident(ns, "mixed"))
    return got.select("event_id", F.col("user_id").cast("string").alias("user_id"), "event_type",
                      F.round("value", 3).alias("value"), F.lit(done["status"]).alias("status"),
                      F.lit(got.schema["user_id"].dataType.simpleString()).alias("user_type"))


def q_broken_tree_summary(spark, sf_dir):
    """Good, empty, hidden, unreadable and case-pair folders in one tree."""
    ev = _table(spark, sf_dir, "events")
    root = scratch_path(spark, "broken")
    write_folders({"good": ev, "Pair": ev.filter("value > 50"), "pair": ev.filter("NOT coalesce(value > 50, false)"),
                   ".hidden": ev, "_also": ev}, root)
    ev.select(F.col("event_type").cast("string").alias("value")).write.text(f"{root}/bad")
    ev.select(F.col("event_type").cast("string").alias("value")).write.text(f"{root}/none")
    _rename_parts(spark, f"{root}/bad", ".parquet")
    got = register_folders(spark, root, _namespace())
    return got.select("folder", "table", (F.col("n_files") > 0).alias("has_files"), "n_rows", "status",
                      F.col("error").isNotNull().alias("noted"))


def _rename_parts(spark, folder: str, suffix: str) -> None:
    """Gives the text files of a folder another extension (through Hadoop)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(path):
        if st.getPath().getName().startswith("part-"):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(st.getPath().toString() + suffix))


# --------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# --------------------------------------------------------------------------

def _cols_sql(c: Cols) -> str:
    return ", ".join([c.sys, c.ts, c.x, *c.tie_break])


def _time_order(c: Cols) -> str:
    return ", ".join([c.ts, *c.tie_break])


def _scored_sql(table: str, c: Cols) -> str:
    return f"""
      SELECT *, CASE WHEN std_feat IS NULL OR std_feat = 0 THEN 0.0
                     ELSE ({c.x} - mean_feat) / std_feat END AS z
      FROM (SELECT {_cols_sql(c)},
                   count(*) OVER (PARTITION BY {c.sys}) AS n,
                   avg({c.x}) OVER (PARTITION BY {c.sys}) AS mean_feat,
                   stddev_samp({c.x}) OVER (PARTITION BY {c.sys}) AS std_feat
            FROM {table})"""


def _r(expr: str, alias: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {alias}"


def _base_sel(c: Cols) -> str:
    return ", ".join([c.sys, c.ts, _r(c.x, c.x), *c.tie_break])


def _zscore_outliers_sql(table: str, c: Cols, z_thresh: float = 2.0, digits: int = 6) -> str:
    return f"""SELECT {_base_sel(c)}, {_r('z', 'z')}, {_r('abs(z)', 'abs_z', digits)}
               FROM ({_scored_sql(table, c)}) WHERE n >= 20 AND abs(z) > {z_thresh}"""


def _iqr_sql(table: str, c: Cols, detailed: str, mult: float = 1.5, digits: int = 6) -> str:
    withb = f"""
      SELECT t.{c.sys} AS {c.sys}, t.{c.ts} AS {c.ts}, t.{c.x} AS {c.x},
             {', '.join('t.' + b + ' AS ' + b for b in c.tie_break)},
             q.q1, q.q3, q.q3 - q.q1 AS iqr,
             q.q1 - {mult} * (q.q3 - q.q1) AS low, q.q3 + {mult} * (q.q3 - q.q1) AS high
      FROM {table} t LEFT JOIN (
        SELECT {c.sys}, quantile_disc({c.x}, 0.25) AS q1, quantile_disc({c.x}, 0.75) AS q3
        FROM {table} GROUP BY {c.sys}) q ON t.{c.sys} = q.{c.sys}"""
    if detailed == "bounds":
        return f"""SELECT {c.sys}, {_r('any_value(q1)', 'q1')}, {_r('any_value(q3)', 'q3')},
                          {_r('any_value(iqr)', 'iqr')}, {_r('any_value(low)', 'low')},
                          {_r('any_value(high)', 'high')}, count(*) AS n,
                          CAST(sum(CASE WHEN {c.x} < low OR {c.x} > high THEN 1 ELSE 0 END)
                               AS BIGINT) AS n_outliers
                   FROM ({withb}) GROUP BY {c.sys}"""
    outl = f"SELECT * FROM ({withb}) WHERE {c.x} < low OR {c.x} > high"
    if detailed == "plain":
        return f"SELECT {_base_sel(c)} FROM ({outl})"
    return f"""SELECT {_base_sel(c)}, {_r('q1', 'q1')}, {_r('q3', 'q3')}, {_r('iqr', 'iqr')},
                      {_r('low', 'low')}, {_r('high', 'high')},
                      CASE WHEN {c.x} < low THEN 'below_low' ELSE 'above_high' END AS "where",
                      {_r(f'CASE WHEN {c.x} < low THEN low - {c.x} ELSE {c.x} - high END',
                          'dist_from_bound', digits)}
               FROM ({outl})"""


def _dists_sql(part: str, order: str, k: int = 5) -> str:
    w = f"(PARTITION BY {part} ORDER BY {order})"
    items = [f"abs(z - lead(z, {i}) OVER {w})" for i in range(1, k + 1)]
    items += [f"abs(z - lag(z, {i}) OVER {w})" for i in range(1, k + 1)]
    return "list_filter([" + ", ".join(items) + "], lambda d: d IS NOT NULL)"


def _mean_k_sql(ds: str, k: int = 5) -> str:
    return (f"CASE WHEN len({ds}) > 0 THEN list_sum(list_sort({ds})[1:{k}]) / "
            f"least({k}, len({ds})) END")


def _knn_time_scores_sql(table: str, c: Cols) -> str:
    return f"""
      SELECT {_cols_sql(c)}, z, {_mean_k_sql('ds')} AS knn_dist
      FROM (SELECT *, {_dists_sql(c.sys, _time_order(c))} AS ds
            FROM ({_scored_sql(table, c)}))"""


def _knn_exact_scores_sql(table: str, c: Cols) -> str:
    return f"""
      SELECT {_cols_sql(c)}, z, {_mean_k_sql('ds')} AS knn_dist
      FROM (SELECT *, {_dists_sql(c.sys, 'z, ' + _time_order(c))} AS ds
            FROM ({_scored_sql(table, c)}))"""


def _knn_lsh_scores_sql(table: str, c: Cols, max_group_rows: int = 2**62) -> str:
    small = f"""
      SELECT {_cols_sql(c)}, z,
             coalesce({_mean_k_sql('list_filter(ds, lambda d: d < 1.5)')}, 0.0) AS knn_dist
      FROM (SELECT *, {_dists_sql(c.sys + ', cell', 'z, ' + _time_order(c))} AS ds
            FROM (SELECT *, floor(z / 1.0) AS cell FROM ({_scored_sql(table, c)})
                  WHERE {c.sys} IS NOT NULL AND n <= {max_group_rows}))"""
    big = f"""
      SELECT {_cols_sql(c)}, z, {_mean_k_sql('ds')} AS knn_dist
      FROM (SELECT *, {_dists_sql(c.sys, _time_order(c))} AS ds
            FROM ({_scored_sql(table, c)}) WHERE {c.sys} IS NOT NULL AND n > {max_group_rows})"""
    return f"{small} UNION ALL {big}"


def _knn_cut_sql(scores: str, c: Cols, cutoff: float = 0.99, digits: int = 6) -> str:
    return f"""
      SELECT {_base_sel(c)}, {_r('z', 'z')}, {_r('knn_dist', 'knn_dist', digits)},
             {_r('knn_pr', 'knn_pr')}
      FROM (SELECT *, percent_rank() OVER (PARTITION BY {c.sys}
                                           ORDER BY round(knn_dist, 9) ASC NULLS FIRST) AS knn_pr
            FROM ({scores}))
      WHERE knn_pr >= {cutoff}"""


def _kmeans_cut_sql(steps: int = 50, cutoff: float = 0.99) -> str:
    """Lloyd's iteration for two centres from the quarter and three-quarter
    quantiles of the standardised z."""
    return f"""
      WITH RECURSIVE s AS MATERIALIZED ({_scored_sql('events', EV)}),
      f AS MATERIALIZED (SELECT *, (z - (SELECT avg(z) FROM s)) / (SELECT stddev_samp(z) FROM s) AS f
                         FROM s WHERE z IS NOT NULL),
      it(step, c0, c1) AS (
        SELECT 0, round(quantile_disc(f, 0.25), 9), round(quantile_disc(f, 0.75), 9) FROM f
        UNION ALL
        SELECT step + 1, m0, m1 FROM (
          SELECT it.step, round(avg(f) FILTER ((f - c0) * (f - c0) <= (f - c1) * (f - c1)), 9) AS m0,
                 round(avg(f) FILTER ((f - c0) * (f - c0) > (f - c1) * (f - c1)), 9) AS m1
          FROM it, f WHERE it.step < {steps} GROUP BY it.step, c0, c1)),
      c AS (SELECT c0, c1 FROM it ORDER BY step DESC LIMIT 1)
      SELECT * FROM (
        SELECT *, percent_rank() OVER (PARTITION BY user_id ORDER BY round(km_dist, 9) NULLS FIRST) AS km_pr
        FROM (SELECT f.*, CASE WHEN abs(f - c0) <= abs(f - c1) THEN 0 ELSE 1 END AS cluster,
                     least(abs(f - c0), abs(f - c1)) AS km_dist FROM f, c))
      WHERE km_pr >= {cutoff}"""


# What each result folder of the job is compared by.
JOB_MEASURES = {"temp_outliers_zscore": "abs_z", "temp_suspects_topk": "abs_z", "temp_outliers_iqr": "value",
                "temp_outliers_kmeans": "km_dist", "temp_outliers_knn": "knn_dist", "iqr_bounds": "n_outliers",
                "iqr_outliers_detailed": "dist_from_bound"}

_TIES = ", ts NULLS FIRST, event_id NULLS FIRST"

_ORACLE: dict[str, str] = {
    "zscore_scores": f"""
        SELECT user_id, ts, {_r('value', 'value')}, event_id, n, {_r('mean_feat', 'mean_feat')},
               {_r('std_feat', 'std_feat')}, {_r('z', 'z')}, {_r('abs(z)', 'abs_z')}
        FROM ({_scored_sql('events', EV)})""",
    "zscore_outliers": _zscore_outliers_sql("events", EV),
    "zscore_outliers_lineitem": _zscore_outliers_sql("lineitem", LI, 1.5),
    "zscore_outliers_by_type": _zscore_outliers_sql("events", ET),
    "suspects_topk": f"""
        SELECT {_base_sel(EV)}, {_r('z', 'z')}, {_r('abs(z)', 'abs_z')}
        FROM ({_scored_sql('events', EV)})
        ORDER BY round(abs(z), 9) DESC NULLS LAST, user_id NULLS FIRST, ts NULLS FIRST,
                 event_id NULLS FIRST
        LIMIT 50""",
    "iqr_bounds": _iqr_sql("events", EV, "bounds"),
    "iqr_outliers_detailed": _iqr_sql("events", EV, "detailed"),
    "iqr_outliers": _iqr_sql("events", EV, "plain"),
    "iqr_bounds_lineitem": _iqr_sql("lineitem", LI, "bounds"),
    "knn_time_scores": f"""
        SELECT {_base_sel(EV)}, {_r('z', 'z')}, {_r('knn_dist', 'knn_dist')}
        FROM ({_knn_time_scores_sql('events', EV)})""",
    "knn_time_outliers": _knn_cut_sql(_knn_time_scores_sql("events", EV), EV),
    "knn_time_outliers_split": _knn_cut_sql(_knn_time_scores_sql("events", EV), EV),
    "knn_time_outliers_by_type": _knn_cut_sql(_knn_time_scores_sql("events", ET), ET),
    "knn_time_outliers_lineitem": _knn_cut_sql(_knn_time_scores_sql("lineitem", LI), LI),
    "knn_exact_outliers": _knn_cut_sql(_knn_exact_scores_sql("events", EV), EV),
    "knn_exact_outliers_by_type": _knn_cut_sql(_knn_exact_scores_sql("events", ET), ET),
    "knn_lsh_outliers": _knn_cut_sql(_knn_lsh_scores_sql("events", EV), EV),
    "knn_split_outliers": _knn_cut_sql(_knn_lsh_scores_sql("events", EV, 65), EV),
    "knn_lsh_outliers_by_type": _knn_cut_sql(_knn_lsh_scores_sql("events", ET), ET),
    "knn_exact_scores": f"""
        SELECT {_base_sel(EV)}, {_r('z', 'z')}, {_r('knn_dist', 'knn_dist')}
        FROM ({_knn_exact_scores_sql('events', EV)})""",
    "knn_lsh_scores": f"""
        SELECT {_base_sel(EV)}, {_r('z', 'z')}, {_r('knn_dist', 'knn_dist')}
        FROM ({_knn_lsh_scores_sql('events', EV)})""",
    "iqr_outliers_detailed_lineitem": _iqr_sql("lineitem", LI, "detailed", 0.5),
    "suspects_topk_lineitem": f"""
        SELECT {_base_sel(LI)}, {_r('z', 'z')}, {_r('abs(z)', 'abs_z')}
        FROM ({_scored_sql('lineitem', LI)})
        ORDER BY round(abs(z), 9) DESC NULLS LAST, l_suppkey NULLS FIRST, l_shipdate NULLS FIRST,
                 l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST
        LIMIT 50""",
    "zscore_outliers_hot": _zscore_outliers_sql("lineitem", LR, 1.5),
    "iqr_bounds_hot": _iqr_sql("lineitem", LR, "bounds"),
    "iqr_bounds_exact": _iqr_sql("events", EV, "bounds"),
    "knn_time_outliers_hot": _knn_cut_sql(_knn_time_scores_sql("lineitem", LR), LR),
    "knn_exact_outliers_hot": _knn_cut_sql(_knn_exact_scores_sql("lineitem", LR), LR),
    "knn_lsh_outliers_hot": _knn_cut_sql(_knn_lsh_scores_sql("lineitem", LR), LR),
    "input_profile": """
        SELECT count(*) AS rows,
               CAST(count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END)
                    AS BIGINT) AS systems
        FROM events""",
    "small_big_systems": """
        SELECT user_id, count(*) AS n,
               CASE WHEN count(*) <= 65 THEN 'small' ELSE 'big' END AS size_class
        FROM events GROUP BY user_id""",
    "folder_ingest_summary": """
        SELECT 'events' AS "table", count(*) AS n_rows, 'created' AS status FROM events
        UNION ALL SELECT 'lineitem', count(*), 'created' FROM lineitem
        UNION ALL SELECT 'orders', count(*), 'created' FROM orders""",
    "file_manifest": """
        SELECT 'events' AS "table", count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad FROM events
        UNION ALL SELECT 'lineitem', count(*), 0 FROM lineitem
        UNION ALL SELECT 'orders', count(*), 0 FROM orders""",
    "sql_by_system": """
        SELECT user_id, count(*) AS n, round(sum(value), 2) AS total_value
        FROM events GROUP BY user_id""",
    "catalog_report": """
        SELECT *, true AS defined, kind = 'table' AS has_files, kind = 'table' AS has_bytes FROM (
        SELECT 'events' AS name, 'table' AS kind,
               CAST((SELECT count(*) FROM information_schema.columns
                     WHERE table_name = 'events') AS INTEGER) AS n_columns,
               count(*) AS n_rows FROM events
        UNION ALL
        SELECT 'lineitem', 'table',
               CAST((SELECT count(*) FROM information_schema.columns
                     WHERE table_name = 'lineitem') AS INTEGER), count(*) FROM lineitem
        UNION ALL
        SELECT 'orders', 'table',
               CAST((SELECT count(*) FROM information_schema.columns
                     WHERE table_name = 'orders') AS INTEGER), count(*) FROM orders
        UNION ALL
        SELECT 'big_events', 'view',
               CAST((SELECT count(*) FROM information_schema.columns
                     WHERE table_name = 'events') AS INTEGER), count(*)
        FROM events WHERE value > 50
        UNION ALL
        SELECT 'orphan_view', 'view', CAST(NULL AS INTEGER), CAST(NULL AS BIGINT))""",
    "sanitize_timestamp": "SELECT * EXCLUDE (value), round(value, 6) AS value FROM events",
    "sanitize_decimal": """
        SELECT CAST(event_id AS DECIMAL(20,0)) AS event_id, CAST(user_id AS DECIMAL(20,0)) AS user_id,
               round(value, 6) AS value, * EXCLUDE (event_id, user_id, value)
        FROM events""",
    "stream_ingest": """
        SELECT event_type, count(*) AS n, round(sum(value), 6) AS total,
               (SELECT count(*) FROM events) AS ingested
        FROM events GROUP BY event_type""",
    "append_new_files": """
        SELECT event_type, count(*) AS n, round(sum(value), 6) AS total,
               (SELECT count(*) FROM events) AS ingested, CAST(0 AS BIGINT) AS idle
        FROM events GROUP BY event_type""",
    "mixed_folder_rows": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
               round(CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'view' THEN CAST(CAST(value AS FLOAT) AS DOUBLE)
                          ELSE value END, 3) AS value,
               'created' AS status, 'decimal(20,0)' AS user_type
        FROM events""",
    "broken_tree_summary": """
        SELECT 'good' AS folder, 'good' AS "table", true AS has_files, count(*) AS n_rows, 'created' AS status,
               false AS noted FROM events
        UNION ALL SELECT 'Pair', 'pair', true, count(*), 'created', false FROM events WHERE value > 50
        UNION ALL SELECT 'pair', 'pair', true, count(*), 'created', false FROM events WHERE NOT coalesce(value > 50, false)
        UNION ALL SELECT '.hidden', NULL, false, 0, 'skipped', true
        UNION ALL SELECT '_also', NULL, false, 0, 'skipped', true
        UNION ALL SELECT 'none', NULL, false, 0, 'skipped', true
        UNION ALL SELECT 'bad', 'bad', true, NULL, 'error', true""",
    "knn_grid2_outliers": """
        WITH s AS (
            SELECT l_suppkey, avg(l_extendedprice) AS m1, stddev_samp(l_extendedprice) AS s1,
                   avg(CAST(l_quantity AS DOUBLE)) AS m2, stddev_samp(CAST(l_quantity AS DOUBLE)) AS s2
            FROM lineitem GROUP BY l_suppkey),
        r AS (
            SELECT row_number() OVER () AS i, l.l_suppkey, l_shipdate, l_extendedprice, CAST(l_quantity AS DOUBLE) AS l_quantity,
                   l_orderkey, l_linenumber, l_partkey,
                   CASE WHEN s1 IS NULL OR s1 = 0 THEN 0.0 ELSE (l_extendedprice - m1) / s1 END AS z1,
                   CASE WHEN s2 IS NULL OR s2 = 0 THEN 0.0 ELSE (l_quantity - m2) / s2 END AS z2
            FROM lineitem l JOIN s ON l.l_suppkey = s.l_suppkey),
        d AS (
            SELECT a.i, list_avg(min(sqrt((a.z1 - b.z1) * (a.z1 - b.z1) + (a.z2 - b.z2) * (a.z2 - b.z2)), 5)) AS knn_dist
            FROM r a JOIN r b ON a.l_suppkey = b.l_suppkey AND a.i <> b.i GROUP BY a.i),
        k AS (
            SELECT r.*, d.knn_dist, percent_rank() OVER (PARTITION BY l_suppkey ORDER BY round(d.knn_dist, 9) NULLS FIRST) AS knn_pr
            FROM r LEFT JOIN d ON r.i = d.i)
        SELECT l_suppkey, l_shipdate, round(l_extendedprice, 6) AS l_extendedprice, round(l_quantity, 6) AS l_quantity,
               l_orderkey, l_linenumber, l_partkey, round(z1, 6) AS z_l_extendedprice, round(z2, 6) AS z_l_quantity,
               round(knn_dist, 6) AS knn_dist, round(knn_pr, 6) AS knn_pr
        FROM k WHERE knn_pr >= 0.99""",
    "sanitize_footer": """
        SELECT 'counters/2024' AS rel_dir, c AS "column", t AS arrow_type, o AS nullable, m AS field_metadata,
               (SELECT count(*) FROM events) AS n_rows
        FROM (VALUES ('event_id', 'decimal128(20, 0)', false, '{"unit": "id"}'),
                     ('user_id', 'decimal128(20, 0)', true, NULL),
                     ('timestamp', 'timestamp[us, tz=UTC]', true, NULL)) v(c, t, o, m)""",
    "sanitize_totals": "SELECT count(*) > 0 AS all_changed, 3 AS casts_per_file FROM events",
    "prepare_strings": "SELECT event_id, user_id, ts, event_type, round(value, 6) AS value, "
                       "* EXCLUDE (event_id, user_id, ts, event_type, value) FROM events",
    "prepare_epochs": "SELECT event_id, user_id, ts, event_type, round(value, 6) AS value, "
                      "* EXCLUDE (event_id, user_id, ts, event_type, value) FROM events",
    "create_table": "SELECT * EXCLUDE (value), round(value, 6) AS value FROM events WHERE value > 50",
    "cast_plan": """
        SELECT 'counters/2024' AS rel_dir, c AS "column", 'uint64' AS from_type, t AS to_type
        FROM (VALUES ('event_id', 'decimal128(20,0)'), ('user_id', 'decimal128(20,0)'),
                     ('timestamp', 'timestamp(us, tz=''UTC'')')) v(c, t)
        WHERE (SELECT count(*) FROM events) > 0""",
    "schema_census": """
        SELECT f AS folder, d AS rel_dir, column_name AS "column", n AS n_rows,
               CAST(0 AS BIGINT) AS n_bad, CAST(1 AS BIGINT) AS n_types
        FROM information_schema.columns
        JOIN (SELECT 'events' AS t, 'Events' AS f, 'Events' AS d, count(*) AS n FROM events
              UNION ALL SELECT 'lineitem', 'lineitem', 'lineitem/2024/q1', count(*) FROM lineitem
              UNION ALL SELECT 'orders', 'orders', 'orders', count(*) FROM orders)
          ON table_name = t""",
    "kmeans_anomalies": f"""
        SELECT {_base_sel(EV)}, {_r('z', 'z')}, cluster, {_r('km_dist', 'km_dist')}, {_r('km_pr', 'km_pr')}
        FROM ({_kmeans_cut_sql()})""",
    "detect_all_outputs": f"""
        SELECT 'temp_outliers_zscore' AS output, user_id, event_id, abs_z AS measure
        FROM ({_zscore_outliers_sql('events', EV)})
        UNION ALL SELECT 'temp_suspects_topk', user_id, event_id, {_r('abs(z)', 'measure')} FROM (
            SELECT * FROM ({_scored_sql('events', EV)})
            ORDER BY round(abs(z), 9) DESC NULLS LAST, user_id NULLS FIRST, ts NULLS FIRST, event_id NULLS FIRST
            LIMIT 50)
        UNION ALL SELECT 'temp_outliers_iqr', user_id, event_id, value FROM ({_iqr_sql('events', EV, 'plain')})
        UNION ALL SELECT 'temp_outliers_kmeans', user_id, event_id, {_r('km_dist', 'measure')} FROM ({_kmeans_cut_sql()})
        UNION ALL SELECT 'temp_outliers_knn', user_id, event_id, knn_dist
        FROM ({_knn_cut_sql(_knn_time_scores_sql('events', EV), EV)})
        UNION ALL SELECT 'iqr_bounds', user_id, CAST(-1 AS BIGINT), CAST(n_outliers AS DOUBLE)
        FROM ({_iqr_sql('events', EV, 'bounds')})
        UNION ALL SELECT 'iqr_outliers_detailed', user_id, event_id, dist_from_bound
        FROM ({_iqr_sql('events', EV, 'detailed')})""",
    "quicklook_views": " UNION ALL ".join(f"""
        SELECT * FROM (SELECT '{view}' AS view, user_id, {row} AS event_id, {measure} AS measure FROM ({sql})
                       ORDER BY {order} user_id NULLS FIRST{ties} LIMIT 40)"""
        for view, sql, row, measure, order, ties in (
            ("kmeans_top", _kmeans_cut_sql(cutoff=-1), "event_id", "round(km_dist, 6)", "round(km_dist, 9) DESC NULLS LAST,", _TIES),
            ("knn_top", _knn_cut_sql(_knn_time_scores_sql("events", EV), EV, digits=12), "event_id", "round(knn_dist, 6)",
             "round(knn_dist, 9) DESC NULLS LAST,", _TIES),
            ("iqr_bounds", _iqr_sql("events", EV, "bounds"), "CAST(-1 AS BIGINT)", "CAST(n_outliers AS DOUBLE)", "", ""),
            ("iqr_top", _iqr_sql("events", EV, "detailed", digits=12), "event_id", "round(dist_from_bound, 6)",
             "round(dist_from_bound, 9) DESC NULLS LAST,", _TIES),
            ("zscore_top", _zscore_outliers_sql("events", EV, digits=12), "event_id", "round(abs_z, 6)",
             "round(abs_z, 9) DESC NULLS LAST,", _TIES))),
    "fetch_pages": """
        SELECT * EXCLUDE (value), round(value, 6) AS value,
               CAST((row_number() OVER (ORDER BY user_id NULLS FIRST, ts NULLS FIRST, event_id NULLS FIRST) - 1)
                    // ((SELECT count(*) FROM events) // 5 + 1) AS BIGINT) AS page
        FROM events""",
    "required_columns": """
        SELECT t AS "table", s AS system, coalesce(lacking, '') AS lacking,
               CASE WHEN lacking IS NOT NULL THEN 0 WHEN t = 'events' THEN (SELECT count(*) FROM events)
                    ELSE (SELECT count(*) FROM lineitem) END AS n_rows
        FROM (SELECT t, s, string_agg(c, ',' ORDER BY c) FILTER (column_name IS NULL) AS lacking
              FROM (VALUES ('events', 'user_id', ['user_id', 'ts', 'value']), ('orders', 'user_id', ['user_id', 'ts', 'value']),
                           ('lineitem', 'l_suppkey', ['l_suppkey', 'l_shipdate', 'l_extendedprice']),
                           ('events', 'USER_ID', ['USER_ID', 'ts', 'value'])) v(t, s, cs), unnest(cs) u(c)
              LEFT JOIN information_schema.columns i ON i.table_name = t AND i.column_name = c
              GROUP BY t, s)""",
}

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "zscore_scores": q_zscore_scores,
    "zscore_outliers": q_zscore_outliers,
    "zscore_outliers_lineitem": q_zscore_outliers_lineitem,
    "zscore_outliers_by_type": q_zscore_outliers_by_type,
    "suspects_topk": q_suspects_topk,
    "iqr_bounds": q_iqr_bounds,
    "iqr_outliers_detailed": q_iqr_outliers_detailed,
    "iqr_outliers": q_iqr_outliers,
    "iqr_bounds_lineitem": q_iqr_bounds_lineitem,
    "kmeans_anomalies": q_kmeans_anomalies,
    "knn_time_scores": q_knn_time_scores,
    "knn_time_outliers": q_knn_time_outliers,
    "knn_time_outliers_split": q_knn_time_outliers_split,
    "knn_time_outliers_by_type": q_knn_time_outliers_by_type,
    "knn_time_outliers_lineitem": q_knn_time_outliers_lineitem,
    "knn_exact_outliers": q_knn_exact_outliers,
    "knn_exact_outliers_by_type": q_knn_exact_outliers_by_type,
    "knn_lsh_outliers": q_knn_lsh_outliers,
    "knn_split_outliers": q_knn_split_outliers,
    "knn_lsh_outliers_by_type": q_knn_lsh_outliers_by_type,
    "knn_exact_scores": q_knn_exact_scores,
    "knn_lsh_scores": q_knn_lsh_scores,
    "iqr_outliers_detailed_lineitem": q_iqr_outliers_detailed_lineitem,
    "suspects_topk_lineitem": q_suspects_topk_lineitem,
    "zscore_outliers_hot": q_zscore_outliers_hot,
    "iqr_bounds_hot": q_iqr_bounds_hot,
    "iqr_bounds_exact": q_iqr_bounds_exact,
    "knn_time_outliers_hot": q_knn_time_outliers_hot,
    "knn_exact_outliers_hot": q_knn_exact_outliers_hot,
    "knn_lsh_outliers_hot": q_knn_lsh_outliers_hot,
    "knn_grid2_outliers": q_knn_grid2_outliers,
    "input_profile": q_input_profile,
    "small_big_systems": q_small_big_systems,
    "folder_ingest_summary": q_folder_ingest_summary,
    "file_manifest": q_file_manifest,
    "sql_by_system": q_sql_by_system,
    "catalog_report": q_catalog_report,
    "sanitize_timestamp": q_sanitize_timestamp,
    "sanitize_decimal": q_sanitize_decimal,
    "cast_plan": q_cast_plan,
    "schema_census": q_schema_census,
    "stream_ingest": q_stream_ingest,
    "append_new_files": q_append_new_files,
    "mixed_folder_rows": q_mixed_folder_rows,
    "broken_tree_summary": q_broken_tree_summary,
    "sanitize_footer": q_sanitize_footer,
    "sanitize_totals": q_sanitize_totals,
    "prepare_strings": q_prepare_strings,
    "prepare_epochs": q_prepare_epochs,
    "create_table": q_create_table,
    "detect_all_outputs": q_detect_all_outputs,
    "quicklook_views": q_quicklook_views,
    "fetch_pages": q_fetch_pages,
    "required_columns": q_required_columns,
}


try:
    import corpus_pipeline
    from tablewatch.llm import queries as llm_queries
except ModuleNotFoundError as missing:  # the library also runs without these parts
    if missing.name not in ("corpus_pipeline", "tablewatch.llm"):
        raise
else:
    _QUERIES.update(llm_queries.QUERIES)
    _ORACLE.update(llm_queries.ORACLE)
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        _ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: per-system z-score outliers of the events table."""
    return _from_here(q_zscore_outliers)(spark, SMOKE_DIR)


def _from_here(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        library_on_workers(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _from_here(query) for name, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
