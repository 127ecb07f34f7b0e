"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from the platform; nothing here overrides a
setting that is already present.  ``spark.checkpoint.dir`` names storage that
the driver and all executors share; it is read from the session, never made up.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # HotSpot does not JIT methods over 8000 bytes of bytecode; wider fused
    # stages (71-column KPI and 48-column growth projections) would run
    # interpreted.  Above this size Spark compiles per operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: int | str = "*", app: str = "storepulse", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", os.environ.get("STOREPULSE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, made ready for ``checkpoint()``.

    Read from ``spark.checkpoint.dir``, or else from what the application has
    set with ``SparkContext.setCheckpointDir``; without either it raises.
    """
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None)
    if have.isDefined():
        return current or have.get()
    if not current:
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder that the driver and all executors share "
            "when the session is built, for example .config('spark.checkpoint.dir', 'hdfs:///checkpoints')")
    spark.sparkContext.setCheckpointDir(current)
    return current
