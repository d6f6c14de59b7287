"""K7: the whole anomaly job (the reference's script) as one function plus a
command line with the same flags and environment variables.

    python -m tablewatch.plans.detect -i data/stats -f temperature \
        --timestamp-col ts --system-col device -o preds

Shared intermediate results: the per-system statistics and quartiles are
small tables computed once (checkpointed) and joined back; the scored rows are
written once to the scratch folder and every output reads its columns there.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident
from tablewatch.operators.iqr import iqr_all
from tablewatch.operators.kmeans import kmeans_cut, kmeans_scores
from tablewatch.operators.knn import (_base, knn_exact_scores, knn_lsh_scores, knn_rank_cut,
                                      knn_time_scores)
from tablewatch.operators.prepare import prepare
from tablewatch.operators.profile import input_profile
from tablewatch.operators.splits import as_sizes, group_sizes
from tablewatch.operators.zscore import (sizes_from_stats, suspects_topk, zscore_outliers,
                                         zscore_with_stats)
from tablewatch.params import Params
from tablewatch.session import scratch_path
from tablewatch.sources.sinks import quicklook, write_all


def load_input(spark: SparkSession, p: Params) -> DataFrame:
    """Directory or glob; ``.prq`` and ``.parquet`` alike (no mergeSchema)."""
    return prepare(spark.read.parquet(p.input_path), p.cols, p.ts_unit, p.nan_as_null)


def knn_outliers(scored: DataFrame, p: Params, sizes: DataFrame | None = None) -> DataFrame:
    """KNN outliers in the configured mode.  ``sizes``: rows per system when
    already known (the z-score statistics carry them)."""
    cols, scale = p.cols, p.scale
    if sizes is None:
        sizes = group_sizes(_base(scored, cols), [cols.sys])
    mode = p.knn_mode.lower()
    if mode == "time":
        scores = knn_time_scores(scored, cols, p.knn_k, scale, sizes)
    elif mode == "exact":
        scores = knn_exact_scores(scored, cols, p.knn_k, scale, sizes)
    else:
        scores = knn_lsh_scores(scored, cols, p.knn_k, p.lsh_bucket, p.lsh_thresh,
                                p.max_group_rows, 0.0, scale, sizes)
        sizes = sizes.filter(F.col(quote_ident(cols.sys)).isNotNull())
    # No cache needed: the plain plan reads the scores once, and the split
    # plan checkpoints them itself before its several passes.
    return knn_rank_cut(scores, cols, p.knn_pr_cutoff, scale, sizes, p.rank_digits)


def detect_all(spark: SparkSession, p: Params, df: DataFrame | None = None,
               extras: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The seven results of the reference job, keyed by output folder name.
    ``extras``, if given, receives intermediate frames for the quick-look
    (``kmeans_scores``: every row with its cluster and distance)."""
    if df is None:
        df = load_input(spark, p)
    else:
        # Validation and type normalisation; a no-op for typed columns.
        df = prepare(df, p.cols, p.ts_unit, p.nan_as_null)
    cols = p.cols
    scored, stats = zscore_with_stats(df, cols, p.scale)
    sizes = as_sizes(sizes_from_stats(stats, cols), p.scale)
    # Score once: every output below reads pruned columns of this table.
    path = scratch_path(spark, "scores")
    scored.select(*[F.col(quote_ident(c)) for c in [*cols.key, "n", "z", "abs_z"]]) \
        .write.parquet(path)
    scored = spark.read.parquet(path)
    iqr = iqr_all(scored, cols, p.iqr_mult, p.scale, sizes)
    km = kmeans_scores(scored, cols, p.kmeans_k, scale=p.scale)
    if extras is not None:
        extras["kmeans_scores"] = km
    return {
        "temp_outliers_zscore": zscore_outliers(scored, cols, p.z_thresh, p.min_points),
        "temp_suspects_topk": suspects_topk(scored, cols, p.topk, p.rank_digits),
        "temp_outliers_iqr": iqr["iqr_outliers"],
        "temp_outliers_kmeans": kmeans_cut(km, cols, p.km_pr_cutoff, p.scale, p.rank_digits),
        "temp_outliers_knn": knn_outliers(scored, p, sizes),
        "iqr_bounds": iqr["iqr_bounds"],
        "iqr_outliers_detailed": iqr["iqr_outliers_detailed"],
    }


def write_results(spark: SparkSession, results: dict[str, DataFrame], out_dir: str, cols,
                  n_files: int | None = None) -> dict[str, str]:
    """Write the seven outputs.  The compact IQR output is a projection of
    the detailed one, so it is read back from the written detailed output
    instead of being recomputed from the input."""
    first = {k: v for k, v in results.items() if k != "temp_outliers_iqr"}
    paths = write_all(first, out_dir, n_files)
    if "temp_outliers_iqr" in results:
        if "iqr_outliers_detailed" in paths:
            keep = [quote_ident(c) for c in [cols.sys, cols.ts, cols.x, *cols.tie_break]]
            compact = spark.read.parquet(paths["iqr_outliers_detailed"]).select(*keep)
        else:
            compact = results["temp_outliers_iqr"]
        paths.update(write_all({"temp_outliers_iqr": compact}, out_dir, n_files))
    return paths


def run(spark: SparkSession, p: Params, n_files: int | None = None, show: bool = True) -> dict:
    df = load_input(spark, p)
    extras: dict[str, DataFrame] = {}
    results = detect_all(spark, p, df, extras)
    paths = write_results(spark, results, p.out_dir, p.cols, n_files)
    prof = input_profile(df, p.cols).first()
    # The views read what was just written, nothing is computed again.
    written = {name: spark.read.parquet(path) for name, path in paths.items()}
    views = quicklook(written, p.cols, extras, p.print_limit, p.rank_digits)
    if show:
        print(f"{prof['rows']} rows in {prof['systems']} systems; {p.feature} judged at "
              f"|z| > {p.z_thresh} in systems of {p.min_points} rows or more")
        for name, view in views.items():
            print(f"\n{name}:")
            view.show(p.print_limit, truncate=False)
    return {"paths": paths, "rows": prof["rows"], "systems": prof["systems"], "views": views}


def main(argv: list[str] | None = None) -> None:
    from tablewatch.session import get_session
    p = Params.from_cli(argv)
    spark = get_session(app="tablewatch-detect")
    run(spark, p)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
