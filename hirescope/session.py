"""SparkSession defaults and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that are still unset, so cluster values always win.
"""

from __future__ import annotations

import functools
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: runtime re-planning (AQE coalesces small
# shuffle partitions and splits skewed ones), UTC wall clock for the
# timestamp casts, Arrow for the one vectorised UDF.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # size shuffle partitions by bytes, not by core count: AQE merges small
    # ones up to the advisory size, so the same job fits 1 GB and 100 TB
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # the rule tables become thousands of Column operations; capturing the
    # Python call site of each one (a debugging aid for error messages)
    # costs more than planning the query itself (static: applies to
    # sessions built by ``local_session``)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``DEFAULTS`` where the session has no value yet."""
    for key, value in DEFAULTS.items():
        # static settings (fixed when the session was built) are left alone
        if spark.conf.get(key, None) in (None, "") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; required, as a
    folder of the driver's own machine would be lost with it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return path


@functools.cache
def _scratch() -> str:
    return tempfile.mkdtemp(prefix="hirescope-shared-")


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables between steps: that of ``spark.checkpoint.dir``. Only
    a local session without the setting (one process) gets a scratch folder."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.conf.get("spark.master", "").startswith("local["):
        return _scratch()
    return checkpoint_dir(spark).rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """A source for work that is heavy in each row: where it is read by fewer
    tasks than there are cores (a small file can hold many rows), its rows are
    dealt out evenly. A source of more tasks stays as it is. Four tasks a core:
    each one loads the rules again."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(4 * cores)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "hirescope") -> SparkSession:
    """Local session for tests and the bench (UI off, no extra ports); its
    checkpoint and warehouse folders are scratch folders of this machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("HIRESCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="hirescope-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="hirescope-checkpoint-"))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
