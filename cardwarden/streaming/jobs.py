"""Scoring, velocity, dedupe, segment metrics and upserts over a stream of raw transactions.

State is kept per key and dropped behind the watermark; set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider where it grows large.
Checkpoints and output live in the shared folder, so a lost executor or driver resumes where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardwarden.config import DEFAULT_RULES, ScoreRules
from cardwarden.functions.numbers import money_sum_or_zero
from cardwarden.operators.clean import clean_transactions, type_columns
from cardwarden.operators.enrich import join_cards, join_mcc, join_users
from cardwarden.operators.features import derive_features
from cardwarden.operators.profiles import Profiles
from cardwarden.operators.scoring import add_score, add_signals, join_profiles
from cardwarden.plans.behaviour import velocity_windows
from cardwarden.plans.incremental import upsert_months


def score_stream(
    transactions: DataFrame,
    cards: DataFrame,
    users: DataFrame,
    mcc: DataFrame,
    profiles: Profiles,
    rules: ScoreRules = DEFAULT_RULES,
) -> DataFrame:
    """Raw stream to scored stream against static lookups and the last staged profiles. Labels are
    not known yet when a transaction arrives."""
    known = clean_transactions(transactions)
    merged = join_mcc(join_users(join_cards(known, type_columns(cards)), type_columns(users)), mcc)
    featured = derive_features(merged)
    return add_score(add_signals(join_profiles(featured, profiles), rules), rules)


def _watermarked(df: DataFrame, time: str, lateness: str) -> DataFrame:
    """Watermarks need an instant; times without zone are taken in the session's zone."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)


CLOSING = "__closing__"


def velocity_stream(
    transactions: DataFrame, time: str, lateness: str = "10 minutes", closing: DataFrame | None = None
) -> DataFrame:
    """Sliding five-minute counts per user; rows later than the watermark are dropped (``late_rows`` counts them).

    A window is given out when the watermark has passed its end. So that a source that has ended keeps none
    back, ``closing`` is a stream of closing events (``write_closing``), which move the watermark and are not counted.
    """
    events = transactions.select("user_id", time)
    if closing is not None:
        events = events.unionByName(closing.select("user_id", time))
    real = F.col("user_id").isNull() | (F.col("user_id") != CLOSING)
    # A filter on the user would be moved below the watermark and take the closing events away.
    return velocity_windows(_watermarked(events, time, lateness), time, counted=real).where("n > 0")


def closing_stream(spark: SparkSession, path: str, time: str) -> DataFrame:
    """Closing events written to ``path``, which need not hold any yet."""
    schema = f"user_id string, `{time}` timestamp_ntz"
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def write_closing(
    events: DataFrame, path: str, time: str, lateness: str = "10 minutes", length: str = "5 minutes"
) -> None:
    """A closing event far enough after the newest event that all windows of length ``length`` end before the watermark."""
    after = F.max(F.col(time).cast("timestamp_ntz")) + F.expr(f"interval {lateness}") + F.expr(f"interval {length}")
    newest = events.agg((after + F.expr("interval 1 second")).alias(time)).where(F.col(time).isNotNull())
    newest.select(F.lit(CLOSING).alias("user_id"), time).write.mode("append").parquet(path)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's last batches dropped behind the watermark, after merging on the map side."""
    return sum(
        int(operator["numRowsDroppedByWatermark"]) for progress in query.recentProgress for operator in progress["stateOperators"]
    )


def dedupe_stream(transactions: DataFrame, key: str, time: str, lateness: str = "1 hour") -> DataFrame:
    """Each key once, however often the source replays it within the lateness."""
    once = _watermarked(transactions, time, lateness).dropDuplicatesWithinWatermark([key])
    return once.withColumn(time, F.col(time).cast("timestamp_ntz"))


def segment_stream(
    scored: DataFrame, time: str, segment: str, length: str = "1 day", lateness: str = "1 hour"
) -> DataFrame:
    """Continuous counts and flagged amounts per window and segment."""
    flagged = F.col("is_suspicious")
    return (
        _watermarked(scored, time, lateness)
        .groupBy(F.window(time, length).alias("w"), segment)
        .agg(
            F.count("*").alias("total"),
            F.count_if(flagged).alias("suspicious"),
            money_sum_or_zero(F.col("amount"), flagged).alias("amount_suspicious"),
        )
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            segment,
            "total",
            "suspicious",
            "amount_suspicious",
        )
    )


def _trigger(every: str | None) -> dict:
    """All that is there and stop, or a micro-batch at a fixed interval."""
    return {"processingTime": every} if every else {"availableNow": True}


def append_to_table(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append-only Parquet output with exactly-once files."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def update_table(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds",
    keys: list[str] | None = None, fold_every: int = 50,
) -> StreamingQuery:
    """Changed groups of each micro-batch in a folder of their own. A batch that is run again
    overwrites its folder, so nothing counts twice; ``latest`` reads the current values. With ``keys``, the batches
    are folded into a snapshot after every ``fold_every`` of them."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{path}/batch_{batch_id:010d}"
        )
        if keys and (batch_id + 1) % fold_every == 0:
            fold(batch.sparkSession, path, keys)

    return (
        stream.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def _complete(spark: SparkSession, path: str, kind: str) -> dict[int, str]:
    """Folders of that kind that Spark has marked as complete, by number, ascending."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return {}
    names = sorted(status.getPath().getName() for status in fs.listStatus(base))
    marked = lambda n: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))
    return {int(n.removeprefix(kind)): f"{path}/{n}" for n in names if n.startswith(kind) and marked(n)}


def _newest(spark: SparkSession, path: str, keys: list[str]) -> tuple[DataFrame, int]:
    """The newest values of each group with their batch, and the newest batch. Read are the last snapshot and the
    batches after it, whatever the number of batches so far."""
    snapshots, batches = _complete(spark, path, "snapshot_"), _complete(spark, path, "batch_")
    upto = max(snapshots, default=-1)
    paths = [snapshots[upto]] if snapshots else []
    paths += [place for number, place in batches.items() if number > upto]
    written = spark.read.parquet(*paths)
    values = [c for c in written.columns if c not in keys]
    newest = written.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("row"))
    return newest.select(*keys, "row.*"), max([upto, *batches])


def fold(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Writes a snapshot of the newest values; it counts once it is complete. Batches and snapshots before the
    snapshot that stood until now go, so a reader that began with that one can finish."""
    newest, upto = _newest(spark, path, keys)
    before = max(_complete(spark, path, "snapshot_"), default=-1)
    if upto == before:
        return
    newest.write.mode("overwrite").parquet(f"{path}/snapshot_{upto:010d}")
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = [p for n, p in _complete(spark, path, "snapshot_").items() if n < before]
    old += [p for n, p in _complete(spark, path, "batch_").items() if n <= before]
    for place in old:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(place), True)


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest values of each group that ``update_table`` wrote."""
    return _newest(spark, path, keys)[0].drop("batch_id")


def upsert_into_months(
    stream: DataFrame, path: str, checkpoint: str, key: str, newest: str, every: str | None = "1 minute"
) -> StreamingQuery:
    """Each micro-batch replaces or adds its rows in the month folders it touches."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        staging = f"{checkpoint}-staging/batch_{batch_id:010d}"
        upsert_months(batch.sparkSession, path, batch, key, newest, staging)

    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )
