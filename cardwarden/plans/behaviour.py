"""Behaviour of a user over time: velocity, travel, deviation, novelty, threshold choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.config import DEFAULT_RULES, ScoreRules
from cardwarden.functions.geo import haversine_km
from cardwarden.functions.numbers import cents, ratio
from cardwarden.operators.enrich import join_centroids
from cardwarden.operators.neighbours import (
    MICROS_PER_DAY, ROWS_PER_CHUNK, crowded_chunks, micros, widths_below, with_neighbour, with_running_totals,
)

HOUR, DAY, MONTH = MICROS_PER_DAY // 24, MICROS_PER_DAY, 30 * MICROS_PER_DAY
AIRLINER_KMH = 900.0


def velocity_windows(
    df: DataFrame, time: str, length: str = "5 minutes", slide: str = "1 minute", counted: Column | None = None
) -> DataFrame:
    """Transactions per user in sliding windows. Works on a batch or, with a watermark, a stream. Rows that are not
    ``counted`` only move the watermark."""
    return (
        df.groupBy(F.window(time, length, slide).alias("w"), "user_id")
        .agg(F.count("*" if counted is None else F.when(counted, 1)).alias("n"))
        .select(
            "user_id",
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "n",
        )
    )


def velocity_features(df: DataFrame, time: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Per transaction: the user's transactions in the last hour and day, distinct merchants in the
    last day and mean amount of the last 30 days, the transaction and its peers included.

    A sliding frame would visit every row of the frame again for each row. Here a transaction adds to
    each count when it happens and takes itself off when it leaves the frame, so that every feature is
    one running total. For distinct merchants it leaves as soon as the user is back at the merchant.
    """
    rows = df.select("transaction_id", "user_id", "merchant_id", time, cents(F.col("amount")).alias("cents"))
    returning = with_neighbour(
        rows, ["user_id", "merchant_id"], time, "transaction_id", [time], "back", following=True,
        rows_per_chunk=rows_per_chunk,
    )
    now, back = micros(time), F.unix_micros(F.col("back")[time].cast("timestamp"))
    # Even positions hold arrivals, the odd one after them departures: a frame includes both ends.
    merchant_known = F.col("merchant_id").isNotNull().cast("bigint")
    left_merchant = F.when(back <= now + DAY, back * 2).otherwise((now + DAY) * 2 + 1)
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")

    def step(at: Column, transaction: Column, **changes: Column) -> Column:
        names = ("hour", "day", "merchants", "month_n", "month_cents")
        return F.struct(
            at.alias("at"),
            transaction.alias("transaction_id"),
            *[changes.get(n, zero).alias(n) for n in names],
        )

    nobody = F.lit(None).cast("string")
    amount = F.coalesce("cents", zero)
    steps = F.array(
        step(now * 2, F.col("transaction_id"), hour=one, day=one, merchants=merchant_known,
             month_n=one, month_cents=amount),
        step((now + HOUR) * 2 + 1, nobody, hour=-one),
        step((now + DAY) * 2 + 1, nobody, day=-one),
        step(left_merchant, nobody, merchants=-merchant_known),
        step((now + MONTH) * 2 + 1, nobody, month_n=-one, month_cents=-amount),
    )
    line = returning.select("user_id", F.inline(steps))
    measures = ["hour", "day", "merchants", "month_n", "month_cents"]
    # Where steps may fall, counted without the merchants' window: a merchant's departure is at the next
    # arrival there or a day later.
    places = F.array(now * 2, now * 2, *[(now + d) * 2 + 1 for d in (HOUR, DAY, DAY, MONTH)])
    places_of = rows.select("user_id", F.explode(places).alias("at"))
    widths = widths_below(2 * DAY, unit=2)
    crowded = crowded_chunks(places_of, ["user_id"], F.col("at"), widths, rows_per_chunk)
    counted = with_running_totals(line, ["user_id"], "at", measures, widths, crowded)
    return counted.where("transaction_id is not null").select(
        "transaction_id",
        "user_id",
        F.col("hour").alias("txns_last_hour"),
        F.col("day").alias("txns_last_day"),
        F.col("merchants").alias("merchants_last_day"),
        (F.col("month_cents") / F.lit(100.0) / F.col("month_n")).alias("mean_amount_30d"),
    )


def impossible_travel(
    df: DataFrame, time: str, speed_above: float = AIRLINER_KMH, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Each located purchase with the user's previous one: distance, time between, speed, and
    whether no airliner could have made it."""
    located = join_centroids(
        df.select("transaction_id", "user_id", "merchant_state", time)
    ).where("merchant_lat is not null")
    payload = ["transaction_id", time, "merchant_lat", "merchant_lon"]
    paired = with_neighbour(
        located, ["user_id"], time, "transaction_id", payload, "before", rows_per_chunk=rows_per_chunk
    ).where("before is not null")
    before = F.col("before")
    measured = paired.select(
        "transaction_id",
        "user_id",
        before["transaction_id"].alias("previous_id"),
        haversine_km(
            before["merchant_lat"], before["merchant_lon"], F.col("merchant_lat"), F.col("merchant_lon")
        ).alias("km"),
        ((micros(time) - F.unix_micros(before[time].cast("timestamp"))) / F.lit(3.6e9)).alias("hours"),
    )
    return measured.withColumn("kmh", ratio(F.col("km"), F.col("hours"))).withColumn(
        "impossible", (F.col("km") > 0) & (F.coalesce("kmh", F.lit(float("inf"))) > speed_above)
    )


def amount_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("user_id").agg(
        F.avg("amount").alias("mean_amount"), F.stddev_samp("amount").alias("sd_amount")
    )


def amount_zscore(df: DataFrame, profile: DataFrame) -> DataFrame:
    """How many standard deviations an amount lies from the user's mean; null where the user has no
    spread. Give it a staged profile in large runs."""
    joined = df.select("transaction_id", "user_id", "amount").join(profile, "user_id", "left")
    return joined.withColumn(
        "z", F.try_divide(F.col("amount") - F.col("mean_amount"), F.col("sd_amount"))
    )


def novelty_flags(df: DataFrame, time: str) -> DataFrame:
    """Whether a transaction is the user's first in its category, hour of day or state.

    The first transaction of each (user, attribute, value) is a minimum, merged on the map side; the
    flags then go back to the transactions by their id, a key without hot values.
    """
    rows = df.select(
        "transaction_id", "user_id", time, "mcc", F.hour("transaction_date").cast("string").alias("hour"),
        "merchant_state",
    )
    kinds = {"new_category": "mcc", "new_hour": "hour", "new_state": "merchant_state"}
    attributes = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.col(c).alias("content")) for k, c in kinds.items()]
    )
    firsts = (
        rows.select("transaction_id", "user_id", time, F.inline(attributes))
        .where("content is not null")
        .groupBy("user_id", "kind", "content")
        .agg(F.min(F.struct(time, "transaction_id")).alias("first"))
    )
    flags = firsts.groupBy(F.col("first.transaction_id").alias("transaction_id")).agg(
        *[F.max(F.col("kind") == k).alias(k) for k in kinds]
    )
    joined = rows.select("transaction_id", "user_id").join(flags, "transaction_id", "left")
    return joined.withColumns({k: F.coalesce(k, F.lit(False)) for k in kinds})


def threshold_sweep(
    facts: DataFrame, review_cost: float = 10.0, rules: ScoreRules = DEFAULT_RULES
) -> DataFrame:
    """Quality and cost of every threshold from 0 to the highest score, the cheapest marked.

    A missed fraud costs its amount, a false alarm one review. Only the score histogram, 21 rows at
    most, is accumulated.
    """
    fraud = F.col("is_fraud")
    per_score = facts.groupBy(F.col("fraud_score").cast("bigint").alias("threshold")).agg(
        F.count("*").alias("n"),
        F.count_if(fraud).alias("fraud"),
        F.coalesce(F.sum(F.when(fraud, cents(F.col("amount")))), F.lit(0)).alias("fraud_cents"),
    )
    grid = facts.sparkSession.range(rules.max_score + 1).withColumnRenamed("id", "threshold")
    whole = W.partitionBy(F.lit(0))
    flagged = whole.orderBy(F.desc("threshold")).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = grid.join(per_score, "threshold", "left").na.fill(0)
    counted = filled.select(
        "threshold",
        F.sum("fraud").over(flagged).alias("tp"),
        F.sum(F.col("n") - F.col("fraud")).over(flagged).alias("fp"),
        (F.sum("fraud").over(whole) - F.sum("fraud").over(flagged)).alias("fn"),
        (F.sum("fraud_cents").over(whole) - F.sum("fraud_cents").over(flagged)).alias("missed_cents"),
    )
    zero = F.lit(0.0)
    rated = counted.select(
        "threshold", "tp", "fp", "fn",
        F.coalesce(ratio(F.col("tp"), F.col("tp") + F.col("fp")), zero).alias("precision"),
        F.coalesce(ratio(F.col("tp"), F.col("tp") + F.col("fn")), zero).alias("recall"),
        F.coalesce(ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), zero).alias("f1"),
        (F.col("missed_cents") / F.lit(100.0) + F.col("fp") * F.lit(review_cost)).alias("expected_cost"),
    )
    cheapest = F.row_number().over(whole.orderBy("expected_cost", "threshold")) == 1
    return rated.withColumn("is_cheapest", cheapest)
