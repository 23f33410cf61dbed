"""Session settings shared by tests, benchmarks and jobs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on: UTC for date handling, AQE for runtime
# re-planning (skew splitting, partition coalescing) and dynamic overwrite for
# month-partitioned state.
#
# Broadcast joins: the static planner sizes a join subtree as the *product*
# of its inputs' sizes (no column statistics on raw Parquet), and a pruned
# fact scan under the default 10MB threshold can be picked as the build side.
# So the static threshold is kept small (1MB of estimated file size: lookup
# tables such as nation/region, broadcast without shuffling the big side),
# and everything else is decided by AQE from *measured* shuffle sizes under
# the adaptive threshold. Larger sides stay sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "1MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "revlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` is left to ``spark-submit``; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster this names a
    shared file system). Only when it is unset in a local session, as in
    tests, a scratch folder is created and registered; a cluster session
    raises, since executors would write to disks of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.conf.get("spark.master", "local").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="revlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:  # Spark Connect: the server reads spark.checkpoint.dir
        pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint root for written intermediate tables."""
    return os.path.join(checkpoint_root(spark), name)


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a frame reading it back.

    Cuts lineage like a reliable checkpoint, but computes the plan once (an
    eager ``Dataset.checkpoint`` on an unpersisted plan computes it twice:
    once to count, once to write). Executors may be lost afterwards: the data
    is on shared storage, not in executor memory.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)
