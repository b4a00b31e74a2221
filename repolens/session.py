"""Session helpers.

The cluster names its shared checkpoint folder in ``spark.checkpoint.dir``;
we only ever read that setting.  A folder of our own is set only when the
setting is absent, which happens in local tests.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (coalescing, skew join
# splitting), UTC timestamps, and no web UI.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def _half_of_memory_mb() -> int:
    return max(1024, os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") // (1 << 21))


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "repolens") -> SparkSession:
    """Return the active session or build one with the defaults above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor, so its heap is
            # the only memory knob (a cluster sets executor memory itself)
            builder = builder.config("spark.driver.memory", os.environ.get("REPOLENS_DRIVER_MEMORY", f"{_half_of_memory_mb()}m"))
    for key, value in _DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset, a local
    master (tests) gets a fresh folder below the system temp dir; on a cluster
    that folder would be one machine's own, so this raises instead.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="repolens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local

