"""Incremental loads and the date-partitioned copy of the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.plans.warehouse import newer_than, upsert
from cardwarden.sources.staging import stage

PARTITIONS = ("year", "month")
KEYS_PER_SPAN = 10_000_000
HASHED_SPANS = 1024


def load_newer(
    target: DataFrame, source: DataFrame, key: str, time: str, overlap: str = "0 days"
) -> DataFrame:
    """``target`` with every source row newer than its high-water mark, less an overlap that picks
    up late changes. The mark is a single value."""
    mark = target.agg(F.max(time).alias("mark")).first()["mark"]
    if mark is None:
        return upsert(target, source, key, time)
    # As text: a Python datetime would become an instant, read in the driver's own zone.
    since = F.lit(str(mark)).cast("timestamp_ntz") - F.expr(f"interval {overlap}")
    return upsert(target, newer_than(source, time, since), key, time)


def with_partitions(facts: DataFrame) -> DataFrame:
    return facts.withColumns(
        {"year": F.year("transaction_date"), "month": F.month("transaction_date")}
    )


def write_by_month(facts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Year and month folders. Rebalancing gives each month whole files, and cuts a month that holds
    much of the data into several, instead of sending it to one task."""
    balanced = with_partitions(facts).hint("rebalance", *PARTITIONS)
    balanced.write.mode(mode).partitionBy(*PARTITIONS).parquet(path)
    fs, folder = _folder(facts.sparkSession, f"{path.rstrip('/')}_keys")
    fs.delete(folder, True)  # the next load builds it anew


def months(spark: SparkSession, path: str, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Rows from the first to the last (year, month); other folders are not opened."""
    months_since = F.col("year") * 12 + F.col("month")
    return spark.read.parquet(path).where(
        months_since.between(first[0] * 12 + first[1], last[0] * 12 + last[1])
    )


def key_span(key: str, width: int = KEYS_PER_SPAN) -> Column:
    """Folder of the key index that a key belongs to: ranges of ``width`` for whole numbers, which grow with time,
    so that a load of new rows opens few folders; else a hash."""
    number = F.col(key).try_cast("bigint")
    whole = F.col(key).cast("string") == number.cast("string")
    hashed = F.lit(-1).cast("bigint") - F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(HASHED_SPANS))
    return F.when(whole & (number >= 0), F.floor(number / F.lit(width)).cast("bigint")).otherwise(hashed)


def key_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, year int, month int, span bigint").parquet(f"{path.rstrip('/')}_keys")


def write_key_index(spark: SparkSession, path: str, key: str) -> None:
    """Where each key of the month folders is, in folders of key spans, each in the order of its keys, so that
    row groups carry their bounds. Built once over three columns; loads keep it up."""
    placed = spark.read.parquet(path).select(key, *PARTITIONS)
    _write_spans(placed.select(F.col(key).cast("string").alias("key"), *PARTITIONS, key_span(key).alias("span")), path)


def _write_spans(index: DataFrame, path: str) -> None:
    """The marker is away while folders are replaced; an index without it is built anew."""
    fs, marker = _folder(index.sparkSession, _marker(path))
    fs.delete(marker, False)
    (
        index.hint("rebalance", "span").sortWithinPartitions("span", "key").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("span").parquet(f"{path.rstrip('/')}_keys")
    )
    fs.create(marker, True).close()


def _marker(path: str) -> str:
    return f"{path.rstrip('/')}_keys/_COMPLETE"


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _in(values: list[tuple[int, int]]) -> Column:
    wanted = F.lit(False)
    for year, month in values:
        wanted = wanted | (F.col("year").eqNullSafe(F.lit(year)) & F.col("month").eqNullSafe(F.lit(month)))
    return wanted


def upsert_months(
    spark: SparkSession, path: str, updates: DataFrame, key: str, newest: str, staging: str
) -> None:
    """Upserts into the month folders that the updates touch; the others stay as they are.

    The key index tells the months that hold earlier versions, so a row whose month changed leaves its old
    folder; a month that lost its last row goes. Only the index folders of the updated keys are opened. The new
    content is staged first, because a folder cannot be overwritten while it is read. A load that died is run
    again with the same updates: the index is written last, so it still leads to the earlier versions, and both
    months are rewritten.
    """
    latest = updates.groupBy(key).agg(F.max_by(F.struct(*updates.columns), newest).alias("row")).select("row.*")
    dated = stage(with_partitions(latest), f"{staging}/updates")
    fresh = dated.select(F.col(key).cast("string").alias("key"), *PARTITIONS, key_span(key).alias("span"))
    fs, marker = _folder(spark, _marker(path))
    if not fs.exists(marker):
        fs.delete(marker.getParent(), True)
        write_key_index(spark, path, key)
    # at most one value for each folder touched
    spans = [r["span"] for r in fresh.select("span").distinct().collect()]
    if not spans:
        return
    known = key_index(spark, path).where(F.col("span").isin(spans))
    earlier = known.join(fresh.select("key"), "key", "left_semi").select(*PARTITIONS)
    touched = [tuple(r) for r in earlier.union(fresh.select(*PARTITIONS)).distinct().collect()]
    current = spark.read.parquet(path).where(_in(touched))
    kept = current.join(dated.select(key), key, "left_anti")
    merged = stage(kept.unionByName(dated.select(*current.columns)), f"{staging}/merged")
    merged.hint("rebalance", *PARTITIONS).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*PARTITIONS).parquet(path)
    filled = {tuple(r) for r in merged.select(*PARTITIONS).distinct().collect()}
    for year, month in set(touched) - filled:
        fs, folder = _folder(spark, f"{path}/year={year}/month={month}")
        fs.delete(folder, True)
    others = known.join(fresh.select("key"), "key", "left_anti").select("key", *PARTITIONS, "span")
    _write_spans(stage(others.unionByName(fresh), f"{staging}/keys"), path)
