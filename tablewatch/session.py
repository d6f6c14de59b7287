"""Session construction and the shared scratch folder.

Every helper takes the session as an argument; nothing here is global.
The scratch folder lives under ``spark.checkpoint.dir`` (a shared
filesystem on a cluster).  Only when that setting is absent — unit tests,
a laptop — do we create a private one.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the operators in this package.  Sizes follow the
# reference deployment (64 MB splits / advisory partitions) and turn on AQE's
# partition coalescing and skew-join splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tablewatch",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control on a
    cluster.  ``shuffle_partitions``: a value sized to the data (about 128 MB
    of shuffle data per partition; AQE coalesces the rest), by default that of
    the environment variable ``SHUFFLE_PARTITIONS`` or else four per core.
    ``SPARK_DRIVER_MEMORY`` sets the driver's memory of a new session.
    """
    shuffle_partitions = shuffle_partitions or int(os.environ.get("SHUFFLE_PARTITIONS") or 0)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if os.environ.get("SPARK_DRIVER_MEMORY"):
        builder = builder.config("spark.driver.memory", os.environ["SPARK_DRIVER_MEMORY"])
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    if not shuffle_partitions and not spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        spark.conf.set("spark.sql.shuffle.partitions", str(max(8, 4 * spark.sparkContext.defaultParallelism)))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    library_on_workers(spark)
    return spark


def library_on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this library from where the driver has it
    (the same path on every node; ship it with --py-files otherwise)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a private one only if
    the cluster names none (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        configured = tempfile.mkdtemp(prefix="tablewatch-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)  # ours alone
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint folder.

    Used for data that Spark derives and writes (fixtures for the registered
    queries, cut lineage of intermediate tables).  Never machine-local on a
    cluster because the checkpoint folder is shared storage there.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tablewatch-scratch/{name}-{uuid.uuid4().hex[:12]}"
