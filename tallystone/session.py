"""Session construction and the shared (cluster-visible) working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library is planned for. AQE re-plans joins at
# runtime (broadcast when a side turns out small, splits skewed partitions),
# coalesces small shuffle partitions and keeps partition sizes near the
# advisory size, which is what makes the same code hold from sf0.01 to 100 TB.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # guard against wrong groups when a union of identically hash-partitioned
    # inputs feeds an aggregation on that key (Spark 4.1 with exchange reuse)
    "spark.sql.unionOutputPartitioning": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tallystone", extra: dict | None = None) -> SparkSession:
    """Return a session with the library defaults.

    On a cluster, call without ``master`` and let spark-submit decide. A
    checkpoint folder is only invented when the deployment did not name one
    (``spark.checkpoint.dir``), which is the local/test case.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local master (tests, a laptop)
    may go without: there a private temporary folder is created and registered.
    On a cluster every executor would write to its own disk, so that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tallystone-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{purpose}-{uuid.uuid4().hex}"

