"""Session construction and the shared storage root.

Lineage is cut only with reliable storage: ``checkpoint()`` into the folder named by
``spark.checkpoint.dir`` or tables written under it.  That setting is read from the
session; a private folder is created only for local-mode sessions where it is unset
(tests, benchmarks on one machine).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

STORE_KEY = "cohortsmith.store.root"

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # registration join and per-patient aggregate share one partitioning on patid; split a hot
    # patient there even though the aggregate then needs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.shuffle.partitions": "8",
    # one machine: small inputs still use every core (a cluster sets its own, below)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.files.openCostInBytes": "512k",
    # stored tables are partitioned by a handful of values (e.g. codelist family): write them
    # concurrently instead of sorting every task's rows by the partition column first
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


# Starting point for a large cluster (tens of TB per run): AQE sizes post-shuffle partitions
# from run-time statistics, splits skewed join partitions and demotes joins to broadcast only
# when the measured side is small.  Tune the initial partition count to ~input/256MB.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    "spark.sql.files.openCostInBytes": "4m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # buckets of stored one-row-per-patient tables; all must agree for joins without exchange
    "cohortsmith.store.buckets": "4000",
}


def build_session(master: str | None = None, app: str = "cohortsmith", conf: dict | None = None,
                  ) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    cluster = {} if master is None or master.startswith("local") else CLUSTER_CONF
    for k, v in {**DEFAULTS, **cluster, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_store(spark)
    return spark


_ROOTS: dict[str, str] = {}  # application -> its private folder: all its sessions share one


def ensure_store(spark: SparkSession) -> str:
    """Root folder for checkpoints and materialised tables (shared storage on a cluster)."""
    root = spark.conf.get(STORE_KEY, None)
    if root:
        return root
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) session: the server owns checkpointing
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        spark.conf.set(STORE_KEY, root)
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None) or _ROOTS.get(sc.applicationId)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = _ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="cohortsmith-store-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "checkpoints"))
    spark.conf.set(STORE_KEY, root)
    return root
