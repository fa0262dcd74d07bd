"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# AQE sizes partitions from what it measures at run time, splits hot join partitions and turns a
# sort-merge join into a broadcast only when the measured side is below the threshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app_name: str = "cardwarden", **extra: str) -> SparkSession:
    """Session with the settings above; cluster sizing comes from spark-submit or ``extra``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    cpus = cpus or os.cpu_count() or 4
    spark = build_session(
        **{
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus),
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_fallback_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables and streaming checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset on a local master (tests,
    a laptop) a fresh temporary folder is chosen, once per application; off a local master that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        app = spark.sparkContext.applicationId
        if app not in _fallback_dirs:
            _fallback_dirs[app] = tempfile.mkdtemp(prefix="cardwarden-")
        folder = _fallback_dirs[app]
    return folder.rstrip("/")


def staging_root(spark: SparkSession) -> str:
    """Part of the shared folder that belongs to this application run."""
    return f"{shared_dir(spark)}/cardwarden/{spark.sparkContext.applicationId}"
