"""Global, segment and user metrics of the scored facts.

Every aggregate merges on the map side first, so a segment that holds a third of the rows reaches the
reducer as one partial row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.numbers import cents, money_sum_or_zero, ratio


def _flag_measures() -> list[Column]:
    fraud = F.count_if("is_fraud")
    amount = F.col("amount")
    return [
        F.count("*").alias("total_transactions"),
        fraud.alias("total_fraud"),
        ratio(fraud, F.count("*")).alias("fraud_rate"),
        money_sum_or_zero(amount, F.col("is_fraud")).alias("amount_at_risk"),
        F.count_if("is_suspicious").alias("total_suspicious"),
        money_sum_or_zero(amount, F.col("is_suspicious")).alias("amount_suspicious"),
    ]


def segment_metrics(
    facts: DataFrame, columns: Sequence[str], where: Column | str | None = None
) -> DataFrame:
    """Six measures per segment; a null key is a segment of its own."""
    rows = facts if where is None else facts.where(where)
    return rows.groupBy(*columns).agg(*_flag_measures())


def metrics_global(facts: DataFrame) -> DataFrame:
    """One row: totals, rates, error rates, confusion counts, date range. Empty ratios are zero."""
    fraud, flagged = F.col("is_fraud"), F.col("is_suspicious")
    counts = facts.agg(
        F.count("*").alias("total_transactions"),
        F.count_if(fraud).alias("total_fraud"),
        F.count_if(~fraud).alias("legit"),
        money_sum_or_zero(F.col("amount"), fraud).alias("total_amount_at_risk"),
        F.count_if(flagged & fraud).alias("true_positives"),
        F.count_if(~flagged & ~fraud).alias("true_negatives"),
        F.count_if(flagged & ~fraud).alias("false_positives"),
        F.count_if(~flagged & fraud).alias("false_negatives"),
        F.min("transaction_date").cast("date").alias("dataset_start_date"),
        F.max("transaction_date").cast("date").alias("dataset_end_date"),
    )

    def guarded(part: str, whole: str) -> Column:
        return F.coalesce(ratio(F.col(part), F.col(whole)), F.lit(0.0))

    return counts.select(
        "total_transactions",
        "total_fraud",
        guarded("total_fraud", "total_transactions").alias("fraud_rate"),
        "total_amount_at_risk",
        guarded("total_amount_at_risk", "total_fraud").alias("avg_fraud_amount"),
        guarded("false_positives", "legit").alias("false_positive_rate"),
        guarded("false_negatives", "total_fraud").alias("false_negative_rate"),
        "true_positives",
        "true_negatives",
        "false_positives",
        "false_negatives",
        "dataset_start_date",
        "dataset_end_date",
    )


def fraud_by_mcc(facts: DataFrame) -> DataFrame:
    return segment_metrics(facts, ["mcc", "mcc_description"])


def fraud_by_card_type(facts: DataFrame) -> DataFrame:
    return segment_metrics(facts, ["card_brand", "card_type", "has_chip"])


def fraud_by_state(facts: DataFrame) -> DataFrame:
    """In-person rows with a state; a row of unknown channel is neither."""
    in_person = facts.where("not is_online and merchant_state <> ''")
    return segment_metrics(in_person, ["merchant_state"]).withColumnRenamed("merchant_state", "state")


MERCHANT_KEYS = ("merchant_id", "merchant_city", "merchant_state", "mcc_description")


def fraud_by_merchant(facts: DataFrame) -> DataFrame:
    """Grouped on the raw keys and blanked afterwards, so null and '' stay two rows."""
    grouped = segment_metrics(facts, MERCHANT_KEYS)
    return grouped.withColumns({c: F.coalesce(c, F.lit("")) for c in MERCHANT_KEYS})


_USER_ATTRIBUTES = {
    "user_age": "age",
    "user_gender": "gender",
    "yearly_income": "yearly_income",
    "total_debt": "total_debt",
    "debt_income_ratio": "debt_income_ratio",
    "credit_score": "credit_score",
}


def user_profiles(facts: DataFrame) -> DataFrame:
    """Attributes and totals per user; an attribute is any value that is not null.

    Facts are first counted per user, card and attributes, as grouping keys: that pass is hashed, while
    picking a text value inside it would sort every row. The second pass has a few rows per user.
    """
    fraud, in_cents = F.col("is_fraud"), cents(F.col("amount"))
    per_card = (
        facts.where("user_id is not null")
        .groupBy("user_id", "card_id", *_USER_ATTRIBUTES)
        .agg(
            F.count("*").alias("n"),
            F.count_if(fraud).alias("n_fraud"),
            F.count(in_cents).alias("n_amount"),
            F.sum(in_cents).alias("cents"),
            F.sum(F.when(fraud, in_cents)).alias("cents_fraud"),
        )
    )
    dollars = F.sum("cents") / F.lit(100.0)
    return per_card.groupBy("user_id").agg(
        *[F.any_value(c, True).alias(alias) for c, alias in _USER_ATTRIBUTES.items()],
        F.count_distinct("card_id").alias("num_cards"),
        F.sum("n").alias("total_transactions"),
        F.sum("n_fraud").alias("total_fraud"),
        ratio(F.sum("n_fraud"), F.sum("n")).alias("fraud_rate"),
        dollars.alias("total_spent"),
        F.try_divide(dollars, F.sum("n_amount").cast("double")).alias("avg_transaction"),
        F.coalesce(F.sum("cents_fraud") / F.lit(100.0), F.lit(0.0)).alias("amount_at_risk"),
    )
