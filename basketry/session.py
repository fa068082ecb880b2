"""Session helpers: settings the miner relies on, and the checkpoint folder.

The library never creates the session a user works in; ``local_session`` exists
for tests, the bench and the driver contract.  Operators read
``spark.checkpoint.dir`` from the session and raise where it is unset; only
entry points of a local run may set a scratch folder (``local_scratch``).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session used by the library should carry.  AQE re-plans joins
# at run time and splits skewed shuffle partitions; the UI stays off.
RECOMMENDED_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoints that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "basketry",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("BASKETRY_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    local_scratch(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, from the session's ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def local_scratch(spark: SparkSession) -> None:
    """For entry points and tests: where nothing is configured, a local master gets a scratch folder."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not sc.getCheckpointDir() and not configured and (sc.master == "local" or sc.master.startswith("local[")):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-"))
