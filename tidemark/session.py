"""Session helpers: one place for the settings every job relies on.

The library never hard-codes a storage location. Anything that has to be
written (landed tables, stream checkpoints, lineage cuts) goes under the
shared folder the cluster names in ``spark.checkpoint.dir``. Only when that
setting is absent (unit tests, a laptop) do we pick a scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine's semantics depend on (T23: zone-less text is read in
# the session zone, so the zone is pinned).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.retainedExecutions": "5",
    "spark.ui.enabled": "false",
}


# Starting point for a large cluster (~100 TB inputs, ~1000 executors). AQE
# coalesces the generous initial shuffle width down to ~256 MB partitions,
# splits skewed join partitions, and turns joins into broadcasts only from
# measured sizes; file splits of 512 MB keep scan tasks in the tens of
# thousands rather than millions.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_cluster_defaults(spark: SparkSession, conf: dict | None = None) -> dict:
    """Set each ``CLUSTER_CONF`` entry the session has not set itself
    (explicit cluster settings always win). Returns what was applied."""
    applied = {}
    for k, v in (conf or CLUSTER_CONF).items():
        try:
            explicit = spark.sparkContext.getConf().contains(k)
        except Exception:  # noqa: BLE001
            explicit = False
        if not explicit:
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Session with the engine's settings. ``master=None`` leaves the master
    to the launcher (spark-submit on a cluster); ``shuffle_partitions=None``
    keeps the cluster's setting."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_time_zone(spark)
    shared_dir(spark)
    return spark


def pin_time_zone(spark: SparkSession) -> None:
    """Zone-less source text and instant columns are interpreted in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written intermediates.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set do we create one, which is
    the unit-test / single-machine case.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def session_key(spark: SparkSession) -> tuple[str, str]:
    """Identity of a live session (application + session), for caches of
    plan objects that must never outlive the session they belong to."""
    return (spark.sparkContext.applicationId, str(spark._jsparkSession.sessionUUID()))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that must touch the local disk (tests)."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
