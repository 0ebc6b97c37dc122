"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (partition coalescing and
# skew-join splitting) and no web UI.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state (e.g. one row per (day, terminal)) lives in RocksDB:
    # off-heap, spills to local disk, checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Remove checkpoint files of lineage cuts once their DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tripmetrics", extra: dict | None = None,
                  time_zone: str = "UTC") -> SparkSession:
    """Get or create a session with the defaults above.

    ``time_zone`` sets where days and hours begin, in batch and in streams.

    On a cluster call it without ``master``; the submitter's settings win for
    anything it already set (``getOrCreate`` keeps an existing session).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Stable shared folder for stream checkpoints and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, durable
    folder there).  Only on a local master (tests) and when it is unset, a fresh
    scratch folder is created and registered; elsewhere an unset folder is an
    error, as executors and restarts would not see a local one.  The returned folder is the
    configured one itself, not the per-application subfolder Spark creates
    for ``DataFrame.checkpoint`` files, so a restarted stream finds its
    checkpoint again.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): the server's setting applies
        return conf_dir or ""
    conf_dir = conf_dir or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tripmetrics-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(conf_dir)  # lineage cuts (DataFrame.checkpoint) go below it
    return conf_dir
