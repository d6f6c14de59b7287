"""Column roles and tunables of the anomaly job.

Names and defaults of the public parameters are kept from the reference job
(fixed values, they define its results):
  input path "./data/stats_test/*.prq", feature "temperature",
  timestamp column "timestamp", system column "system_id", output dir "preds",
  Z_THRESH 2, MIN_POINTS 20, TOPK 50, KMEANS_K 2, KM_PR_CUTOFF 0.99,
  KNN_MODE "time", KNN_K 5, KNN_PR_CUTOFF 0.99, LSH_BUCKET 1.0, LSH_THRESH 1.5,
  MAX_GROUP_ROWS 250000, PRINT_LIMIT 100, k-means seed 42, IQR multiplier 1.5.
"""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Cols:
    """Which columns play which role.  ``tie_break`` makes orderings total."""

    sys: str = "system_id"
    ts: str = "timestamp"
    x: str = "temperature"
    tie_break: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "tie_break", tuple(self.tie_break))
        roles = [self.sys, self.ts, self.x, *self.tie_break]
        if len(set(roles)) != len(roles):
            raise ValueError(f"column roles must be distinct, got {roles}")

    @property
    def key(self) -> list[str]:
        return [self.sys, self.ts, self.x, *self.tie_break]


@dataclass(frozen=True)
class Scale:
    """Knobs for the skew-safe plans.

    ``split_rows``: a group (system, or system x grid cell) with more rows than
    this is cut into ordered ranges that become separate tasks.
    ``max_splits`` bounds the number of ranges per group.
    ``broadcast_bytes``: largest small side we broadcast after measuring it.
    ``sample_rows``: rows sampled per big group to place thresholds and
    quantile brackets (checked afterwards, so results stay exact).
    """

    split_rows: int = 2_000_000
    max_splits: int = 16_384
    broadcast_bytes: int = 64 * 1024 * 1024
    quantile_accuracy: int = 10_000
    sample_rows: int = 1_000_000


@dataclass(frozen=True)
class Params:
    input_path: str = "./data/stats_test/*.prq"
    feature: str = "temperature"
    ts_col: str = "timestamp"
    sys_col: str = "system_id"
    out_dir: str = "preds"
    tie_break: tuple[str, ...] = ()
    z_thresh: float = 2.0
    min_points: int = 20
    topk: int = 50
    kmeans_k: int = 2
    km_pr_cutoff: float = 0.99
    knn_mode: str = "time"
    knn_k: int = 5
    knn_pr_cutoff: float = 0.99
    lsh_bucket: float = 1.0
    lsh_thresh: float = 1.5
    max_group_rows: int | None = None
    rank_digits: int | None = None
    print_limit: int = 100
    iqr_mult: float = 1.5
    ts_unit: str = "s"
    nan_as_null: bool = False
    scale: Scale = field(default_factory=Scale)

    @property
    def cols(self) -> Cols:
        return Cols(self.sys_col, self.ts_col, self.feature, tuple(self.tie_break))

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @classmethod
    def from_cli(cls, argv: list[str] | None = None, env: dict[str, str] | None = None) -> "Params":
        """Same flags and environment variables as the reference job."""
        env = dict(os.environ if env is None else env)
        ap = argparse.ArgumentParser(description="Per-system anomaly detection over Parquet.")
        ap.add_argument("-i", "--input", default=env.get("INPUT_PATH", cls.input_path))
        ap.add_argument("-f", "--feature", default=env.get("FEATURE_COL", cls.feature))
        ap.add_argument("--timestamp-col", default=env.get("TIMESTAMP_COL", cls.ts_col))
        ap.add_argument("--system-col", default=env.get("SYSTEM_COL", cls.sys_col))
        ap.add_argument("-o", "--out", default=env.get("OUTPUT_DIR", cls.out_dir))
        ap.add_argument("--tie-break", default=env.get("TIE_BREAK", ""),
                        help="comma-separated columns that make time order total")
        a = ap.parse_args(argv)
        g = env.get
        return cls(
            input_path=a.input, feature=a.feature, ts_col=a.timestamp_col,
            sys_col=a.system_col, out_dir=a.out,
            tie_break=tuple(c for c in a.tie_break.split(",") if c),
            z_thresh=float(g("Z_THRESH", "2")),
            min_points=int(g("MIN_POINTS", "20")),
            topk=int(g("TOPK", "50")),
            kmeans_k=int(g("KMEANS_K", "2")),
            km_pr_cutoff=float(g("KM_PR_CUTOFF", "0.99")),
            knn_mode=g("KNN_MODE", "time"),
            knn_k=int(g("KNN_K", "5")),
            knn_pr_cutoff=float(g("KNN_PR_CUTOFF", "0.99")),
            lsh_bucket=float(g("LSH_BUCKET", "1.0")),
            lsh_thresh=float(g("LSH_THRESH", "1.5")),
            max_group_rows=int(g("MAX_GROUP_ROWS")) if g("MAX_GROUP_ROWS") else None,
            rank_digits=int(g("RANK_DIGITS")) if g("RANK_DIGITS") else None,
            print_limit=int(g("PRINT_LIMIT", "100")),
            iqr_mult=float(g("IQR_MULT", "1.5")),
            ts_unit=g("TS_UNIT", "s"),
            nan_as_null=g("NAN_AS_NULL", "0") in ("1", "true", "yes"),
            scale=Scale(
                split_rows=int(g("SPLIT_ROWS", str(Scale.split_rows))),
                max_splits=int(g("MAX_SPLITS", str(Scale.max_splits))),
                broadcast_bytes=int(g("BROADCAST_BYTES", str(Scale.broadcast_bytes))),
            ),
        )
