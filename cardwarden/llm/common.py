"""Helpers that several operators share: staged tables, null-safe inputs, ranks without a single task."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.session import staging_root

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of the shared one that nothing else uses."""
    return f"{staging_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back, so later passes and lost executors
    start from the table and not from what led to it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Write ``df`` in the order of (groups, order), nulls first, and add ``__at``, the row's place in that
    order from 0, ``__first``, the place of the first row of its group, and ``__size``, the group's rows.

    Rows are dealt by ranges of the whole order, so a group that holds most rows spans many tasks. Rows equal
    in all of it stay together and may trade places.
    """
    keys = [*groups, *order]
    spread = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(spread.withColumn("__row", F.monotonically_increasing_id()), name)
    part = F.shiftright("__row", 33)
    parts = placed.groupBy(part.alias("__part"), *groups).agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__low"))
    # one row per part, so a single task may add them up
    starts = parts.groupBy("__part").agg(F.sum("__n").alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select(F.col("__part").alias("__p"), F.coalesce(before, F.lit(0)).alias("__before"))
    held = parts.join(starts, F.col("__part") == F.col("__p")).withColumn("__low", F.col("__before") + F.col("__low").bitwiseAND((1 << 33) - 1))
    group = Window.partitionBy(*[F.col(g) for g in groups] or [F.lit(0)])
    held = held.select(
        F.col("__part").alias("__p"), *[F.col(g).alias(f"__g_{i}") for i, g in enumerate(groups)], "__before",
        F.min("__low").over(group).alias("__first"), F.sum("__n").over(group).alias("__size"),
    )
    match = part == F.col("__p")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"__g_{i}"))
    at = (F.col("__before") + F.col("__row").bitwiseAND((1 << 33) - 1)).alias("__at")
    return placed.join(held, match).select(*df.columns, at, "__first", "__size")


def hex_digits(rows: int, rows_per_bin: int = 50_000) -> int:
    """Hex digits of a hash that cut ``rows`` into bins of about ``rows_per_bin``."""
    digits = 0
    while digits < 7 and rows > rows_per_bin * 16**digits:
        digits += 1
    return digits


def ranked(df: DataFrame, by: list[str], order: list[str], rank: str, rows: int) -> DataFrame:
    """Add ``rank``, gapless from 0 within each value of ``by``, in a pseudo-random but repeatable order.

    Rows of one group are first cut into bins by a hash of ``order``; a bin's rank starts where the
    counts of the bins before it end, so a group that holds most rows is not ranked by one task.
    Rows equal in ``order`` may trade their ranks.
    """
    digits = hex_digits(rows)
    spread = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in order])), 1, max(1, digits)), 16, 10).cast("long")
    binned = df.withColumn("__bin", spread if digits else F.lit(0).cast("long"))
    keys = [*by, "__bin"]
    counts = binned.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"__o_{k}") for k in keys], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    match: Column = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__o_{k}"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    numbered = binned.withColumn("__inside", inside)
    return numbered.join(offsets, match).select(*df.columns, (F.col("__before") + F.col("__inside")).alias(rank))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, wherever the driver imported it from."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="cardwarden-py-")) / "cardwarden.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES``, unless the session has a bound: 10,000 whole texts are held twice by an
    executor's JVM and twice by its Python worker, and neither gives the memory back. A plan reads the setting when it runs,
    so it stays."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors, in batches of bounded size."""
    ship(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInArrow(function, schema)
