"""Spark session defaults for the library.

The cluster owns its configuration; ``get_session`` only fills in values that
are unset, so a production session (shuffle partitions, checkpoint folder,
broadcast threshold) is never overridden.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

# Settings every query in this library relies on. They are defaults only.
DEFAULTS: dict[str, str] = {
    # R-like calendar arithmetic is done on DATE values in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed join
    # partitions, turn a sort-merge join into a broadcast join once the real
    # size of a side is known to be below the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size post-shuffle partitions by bytes (advisory size), not by the number
    # of cores: small results then run as few tasks, large ones still split.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # Plan-time broadcast only below this estimated size; everything larger is
    # a shuffle join. Dimension tables of this domain are far below it.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.ansi.enabled": "true",
    # Rows go to Python in batches of some MB at most, whatever a text's length:
    # ten thousand long texts at once are held several times over, in the
    # executor and in each of its Python workers.
    ARROW_BATCH: "4m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "waitlens",
                shuffle_partitions: int | None = None, driver_memory: str | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, creating a local one if there is none.
    ``driver_memory`` only matters in local mode, where the driver JVM holds
    every executor thread; it applies when this call starts the JVM."""
    active = SparkSession.getActiveSession()
    if active is not None:  # never override a running session's settings
        apply_defaults(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    for key in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):  # static, so only before the start
        builder = builder.config(key, DEFAULTS[key])
    spark = builder.getOrCreate()
    apply_defaults(spark)  # what spark-submit or its configuration files set stays
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the library's defaults on a running session, only where unset."""
    for key, value in DEFAULTS.items():
        if key.startswith("spark.ui."):
            continue  # static settings of a running application
        try:
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
        except Exception:  # a setting that cannot change at run time
            pass
    ensure_checkpoint_dir(spark)


def bound_batches(spark: SparkSession) -> None:
    """The default of ARROW_BATCH alone, where unset, for operators called
    without ``apply_defaults``."""
    if spark.conf.get(ARROW_BATCH, None) is None:
        spark.conf.set(ARROW_BATCH, DEFAULTS[ARROW_BATCH])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a scratch one only when unset.

    On a cluster the folder is a shared one named by the cluster config; a
    machine-local folder is only used for local runs such as tests.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # sessions without a local SparkContext (Spark Connect)
            current = None
    if current:
        return current
    master = spark.conf.get("spark.master", "")
    if not re.match(r"local(\[|$)", master):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    path = tempfile.mkdtemp(prefix="waitlens-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path
