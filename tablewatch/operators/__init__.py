"""Relational operators of the anomaly job (K0-K6) and their skew-safe
building blocks."""

from tablewatch.operators.iqr import (iqr_all, iqr_bounds, iqr_outliers,  # noqa: F401
                                      iqr_outliers_detailed, quartiles, with_bounds)
from tablewatch.operators.joins import attach_small, materialize  # noqa: F401
from tablewatch.operators.kmeans import kmeans_anomalies, kmeans_cut, kmeans_scores  # noqa: F401
from tablewatch.operators.knn import (knn, knn_exact, knn_exact_scores, knn_lsh,  # noqa: F401
                                      knn_lsh_scores, knn_rank_cut, knn_time, knn_time_scores)
from tablewatch.operators.prepare import absent_columns, prepare, require_columns  # noqa: F401
from tablewatch.operators.profile import input_profile, system_sizes  # noqa: F401
from tablewatch.operators.splits import (group_sizes, neighbor_diffs,  # noqa: F401
                                         percent_rank_at_least, range_splits)
from tablewatch.operators.zscore import (sizes_from_stats, suspects_topk,  # noqa: F401
                                         system_stats, zscore, zscore_outliers,
                                         zscore_with_stats)
