"""Session construction and cluster-aware settings."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings this engine relies on. Session time zone is pinned so that
# timestamp arithmetic and day bucketing are identical on every executor.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from static size *estimates*: a side is broadcast if it is
    # bounded by construction, or when AQE sees its real size at run time.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "chronoledger", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    On a cluster pass ``master=None`` and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB); AQE coalesces small partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read
    here. When it is unset (local tests) a scratch folder is created and set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="chronoledger-ckpt-")
    spark.sparkContext.setCheckpointDir(current)
    return current
