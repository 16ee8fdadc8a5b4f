"""Session construction and the shared storage location for written tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins and coalesces shuffle
# partitions at run time; skew handling splits hot partitions of joins and of
# REBALANCE before partitioned writes.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "cabflow",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the recommended settings.

    On a cluster leave ``master`` unset so spark-submit decides. The web UI
    is kept off: the library never needs it.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for written tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; that setting is read
    from the session. When it is unset, a local run gets a private scratch folder,
    registered so that checkpoint() works too; on a cluster, where executors could
    not see such a folder, that is an error.
    """
    app = spark.sparkContext.applicationId
    if app in _SHARED:
        return _SHARED[app]
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        root = configured.rstrip("/")
    else:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cabflow-")
        spark.sparkContext.setCheckpointDir(os.path.join(root, "checkpoints"))
    _SHARED[app] = root
    return root


_SHARED: dict[str, str] = {}


def shared_path(spark: SparkSession, *parts: str) -> str:
    """Path below :func:`shared_dir`."""
    return os.path.join(shared_dir(spark), *parts)
