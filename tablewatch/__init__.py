"""tablewatch: Parquet folders as tables, type clean-up, SQL/catalog access
and per-system anomaly detection, written as Spark DataFrame/SQL jobs."""

from tablewatch.params import Cols, Params, Scale  # noqa: F401
from tablewatch.session import get_session, scratch_path  # noqa: F401
