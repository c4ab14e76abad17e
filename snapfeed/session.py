"""Session construction and cluster-level settings.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that nobody has set, so cluster values win.  The time zone alone is always set: timestamps here are in UTC.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

#: Rows and bytes of one Arrow batch of the Python stage, at most: page HTML rows are large.
ARROW_ROWS, ARROW_BYTES = 256, 4 << 20
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}

# Settings that make results deterministic and plans scale-friendly.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(ARROW_BYTES),
    # Broadcast only what is proven small: the auto threshold stays at Spark's default
    # (10 MB) and every explicit broadcast in this package is of a parameter table.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def _default_driver_memory() -> str:
    """60% of physical memory, capped at 16g (local mode runs everything in the driver)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gib = max(1, min(16, int(total * 0.6) >> 30))
    return f"{gib}g"


def get_spark(master: str | None = None, app: str = "snapfeed", shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session builder. Cluster jobs should call ``configure`` on their own session."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SNAPFEED_DRIVER_MEMORY") or _default_driver_memory())
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    given = spark.conf.getAll
    for key, value in _DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches made smaller where the session's are larger than ``ARROW_ROWS`` or ``ARROW_BYTES`` or unlimited: a Python worker's memory
    then follows neither the size of a scan's splits nor Spark's defaults, of which a session that nobody configured has 10,000 rows."""
    for name, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        held = re.fullmatch(r"(\d+)([bkmgt]?)b?", (spark.conf.get(f"spark.sql.execution.arrow.{name}", None) or "").strip().lower())
        if not held or not 0 < int(held[1]) * _UNITS[held[2]] <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's ``spark.checkpoint.dir``.  Where that is unset a run on one machine gets a fresh
    scratch folder; a cluster, whose machines would not see it, raises."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        current = tempfile.mkdtemp(prefix="snapfeed-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
