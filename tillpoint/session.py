"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.  AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is under the threshold), coalesces small shuffle
# partitions and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tillpoint") -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a cluster
    submission keeps whatever its launcher configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    driver_mem = os.environ.get("TILLPOINT_DRIVER_MEMORY")
    if driver_mem:
        builder = builder.config("spark.driver.memory", driver_mem)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for intermediate tables and checkpoints.

    On a cluster it is what the launcher names in ``spark.checkpoint.dir`` (or has set with
    ``SparkContext.setCheckpointDir``); without either this raises, because a folder of the
    driver's own disk is invisible to the executors.  Only a local master, whose executors
    run inside the driver, gets a scratch folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    known = context._jsc.sc().getCheckpointDir()
    if not named and known.isDefined():
        return known.get()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tillpoint-ckpt-")
    if not known.isDefined():
        context.setCheckpointDir(named)
    return named if spark.conf.get("spark.checkpoint.dir", None) else (
        context._jsc.sc().getCheckpointDir().get())
