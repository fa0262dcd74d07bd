"""Parquet tables written between steps.

Writing cuts the lineage in storage that outlives executors, gives the planner real sizes, and lets
every later step read only the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return read_stage(df.sparkSession, path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Shares out an input that would keep most cores idle: one small or unsplittable (gzip) file. An
    input with enough splits stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() <= cores // 8
    return df.repartition(cores) if few else df
