"""Checks on the loaded facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A loaded table breaks a rule."""


def negative_amounts(facts: DataFrame) -> DataFrame:
    return facts.where("amount < 0").agg(F.count("*").alias("negative_amounts"))


def assert_no_negative_amounts(facts: DataFrame) -> None:
    found = negative_amounts(facts).first()["negative_amounts"]
    if found:
        raise QualityError(f"quality check failed: {found} negative amounts")


def fact_counts(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count("*").alias("total"),
        F.count_if("is_fraud").alias("fraud"),
        F.try_divide(F.count_if("is_fraud").cast("double"), F.count("*").cast("double")).alias(
            "fraud_rate"
        ),
    )


def duplicate_ids(facts: DataFrame) -> DataFrame:
    """Transaction ids that occur more than once; empty when the key holds."""
    return facts.groupBy("transaction_id").agg(F.count("*").alias("copies")).where("copies > 1")


def data_quality_report(facts: DataFrame) -> DataFrame:
    """One row of counts. Rows are merged per state first, so that the distinct counts run over a
    few hundred rows and the table is read once."""
    state = F.col("merchant_state")
    per_state = facts.groupBy("merchant_state").agg(
        F.count("*").alias("n"), F.count_if(F.col("errors") != "").alias("errors")
    )
    return per_state.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_post_clean"),
        F.count_if(state != "").alias("distinct_states"),
        F.count_if(F.length(state) == 2).alias("two_letter_codes"),
        F.count_if(F.length(state) > 2).alias("countries"),
        F.coalesce(F.sum(F.when(state.isNull() | (state == ""), F.col("n"))), F.lit(0)).alias(
            "without_state"
        ),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("with_errors"),
    )
