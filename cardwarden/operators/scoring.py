"""Explainable weighted score."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden import config
from cardwarden.config import DEFAULT_RULES, ScoreRules
from cardwarden.operators.features import derive_features
from cardwarden.operators.profiles import Profiles
from cardwarden.schemas import FACT

SIGNALS = ("signal_online", "signal_user_amount", "signal_error", "signal_dark_web", "signal_distance")


def join_profiles(features: DataFrame, profiles: Profiles) -> DataFrame:
    """Adds the user's p99 and the card's frequency.

    Give it staged profiles in large runs: their size is then known when the join is planned, and a
    profile too large to broadcast is a plain scan, so that AQE may split a hot user or card.
    """
    return features.join(profiles.user_p99, "user_id", "left").join(
        profiles.card_frequency, "card_id", "left"
    )


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def add_signals(df: DataFrame, rules: ScoreRules = DEFAULT_RULES) -> DataFrame:
    """Five flags that are never null."""
    error_text = F.trim(F.col("errors").cast("string"))
    return df.withColumns(
        {
            "signal_online": _true(F.col("is_online")),
            "signal_user_amount": _true(F.col("amount") > F.col("p99_amount")),
            "signal_error": _true(~error_text.isin("", "nan")),
            "signal_dark_web": _true(F.col("card_on_dark_web")),
            "signal_distance": _true(F.col("distance_km") > rules.distance_above_km),
        }
    )


def _points(condition: Column, points: int) -> Column:
    return F.when(condition, points).otherwise(0)


def _band_points(rules: ScoreRules) -> Column:
    (top, points), *lower = rules.amount_bands
    banded = F.when(F.col("amount") > top, points)
    for above, value in lower:
        banded = banded.when(F.col("amount") > above, value)
    return banded.otherwise(0)


def score(rules: ScoreRules = DEFAULT_RULES) -> Column:
    online = F.col("signal_online")
    parts = [
        _band_points(rules),
        _points(online, rules.online),
        _points(online & (F.col("amount") > rules.online_expensive_above), rules.online_expensive),
        _points(F.col("signal_error"), rules.error),
        _points(F.col("signal_user_amount"), rules.user_amount),
        _points(F.col("signal_dark_web"), rules.dark_web),
        _points(F.col("signal_distance"), rules.distance),
    ]
    return reduce(add, parts).cast("int")


def reasons(rules: ScoreRules = DEFAULT_RULES) -> Column:
    """Tokens of the signals that fired, in fixed order; empty unless suspicious."""
    fired = [
        (F.col("signal_online"), config.REASON_ONLINE),
        (F.col("amount") > rules.high_amount_above, config.REASON_AMOUNT),
        (F.col("signal_error"), config.REASON_ERROR),
        (F.col("signal_user_amount"), config.REASON_USER_AMOUNT),
        (F.col("signal_dark_web"), config.REASON_DARK_WEB),
        (F.col("signal_distance"), config.REASON_DISTANCE),
    ]
    joined = F.concat_ws(";", *[F.when(condition, token) for condition, token in fired])
    return F.when(F.col("is_suspicious"), joined).otherwise(F.lit(""))


def add_score(df: DataFrame, rules: ScoreRules = DEFAULT_RULES) -> DataFrame:
    return (
        df.withColumn("fraud_score", score(rules))
        .withColumn("is_suspicious", F.col("fraud_score") >= rules.threshold)
        .withColumn("suspicion_reasons", reasons(rules))
    )


def score_transactions(
    clean: DataFrame, profiles: Profiles, rules: ScoreRules = DEFAULT_RULES, ranges: Sequence[str] = ()
) -> DataFrame:
    """Cleaned rows to scored facts: the load columns plus ``is_online``, which by-state metrics use.

    ``ranges`` deals the rows by ranges of these columns. Spark computes twice what stands before such a deal, once
    to sample it; so it comes before the features and the score, which need no shuffle.
    """
    joined = join_profiles(clean, profiles)
    features = derive_features(joined.repartitionByRange(*ranges) if ranges else joined)
    scored = add_score(add_signals(features, rules), rules)
    scored = scored.withColumnsRenamed({"current_age": "user_age", "gender": "user_gender"})
    known = [c for c in FACT.fieldNames() if c in scored.columns]
    return scored.select(*known, "is_online")


def score_distribution(facts: DataFrame) -> DataFrame:
    """Transactions and fraud rate at every score."""
    return facts.groupBy(F.col("fraud_score").cast("bigint").alias("fraud_score")).agg(
        F.count("*").alias("total"),
        F.count_if("is_fraud").alias("fraud"),
        (F.count_if("is_fraud") / F.count("*")).alias("fraud_rate"),
    )
