"""Reports over the pre-aggregated segment tables: places, categories, cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.config import CARD_TYPE_NAMES, UNKNOWN_CATEGORY, US_STATES
from cardwarden.functions.numbers import percent, ratio
from cardwarden.plans.views import FRAUD, View, with_share


def _rate(view: View) -> Column:
    return F.when(
        F.col("total_transactions") > 0, ratio(F.col(view.count), F.col("total_transactions"))
    ).otherwise(F.lit(0.0))


def card_type_name(column: str) -> Column:
    names = [item for pair in CARD_TYPE_NAMES.items() for item in map(F.lit, pair)]
    return F.coalesce(F.element_at(F.create_map(*names), F.col(column)), F.col(column))


# -- places ------------------------------------------------------------------------------------


def state_rates(by_state: DataFrame, view: View = FRAUD) -> DataFrame:
    return by_state.where("state <> ''").select(
        "state",
        "total_transactions",
        F.col(view.count).alias("total_fraud"),
        F.col(view.amount).alias("amount_at_risk"),
        _rate(view).alias("fraud_rate"),
        F.col("state").isin(*US_STATES).alias("is_us"),
    )


def top_states_rate(by_state: DataFrame, view: View = FRAUD, n: int = 10) -> DataFrame:
    us = state_rates(by_state, view).where("is_us").drop("is_us")
    return us.orderBy(F.desc_nulls_last("fraud_rate"), "state").limit(n)


def top_states_amount(by_state: DataFrame, view: View = FRAUD, n: int = 10) -> DataFrame:
    us = state_rates(by_state, view).where("is_us").drop("is_us")
    return us.orderBy(F.desc_nulls_last("amount_at_risk"), "state").limit(n)


def top_international(by_state: DataFrame, view: View = FRAUD, n: int = 15) -> DataFrame:
    abroad = state_rates(by_state, view).where("not is_us")
    top = abroad.orderBy(F.desc_nulls_last("total_transactions"), "state").limit(n)
    return top.select(
        "state",
        "total_transactions",
        "total_fraud",
        "amount_at_risk",
        F.round(F.col("fraud_rate") * 100, 2).alias("fraud_rate_pct"),
    )


def international_with_fraud(by_state: DataFrame, view: View = FRAUD) -> DataFrame:
    """Places outside the US with flagged rows, most first."""
    abroad = state_rates(by_state, view).where("not is_us and total_fraud > 0")
    return abroad.drop("is_us").orderBy(F.desc("total_fraud"), "state")


def international_counts(by_state: DataFrame, view: View = FRAUD) -> DataFrame:
    """How many places outside the US there are, and how many have flagged rows."""
    return (
        state_rates(by_state, view)
        .where("not is_us")
        .agg(F.count("*").alias("places"), F.count_if(F.col("total_fraud") > 0).alias("with_fraud"))
    )


# -- categories --------------------------------------------------------------------------------


def known_categories(by_mcc: DataFrame) -> DataFrame:
    return by_mcc.where(F.col("mcc_description") != UNKNOWN_CATEGORY)


def mcc_rates(by_mcc: DataFrame, view: View = FRAUD) -> DataFrame:
    """Known categories with more than 100 transactions."""
    return (
        known_categories(by_mcc)
        .where("total_transactions > 100")
        .select(
            "mcc_description",
            "total_transactions",
            F.col(view.count).alias("total_fraud"),
            F.col(view.amount).alias("amount_at_risk"),
            _rate(view).alias("fraud_rate"),
        )
    )


def top_mcc_amount(by_mcc: DataFrame, view: View = FRAUD, n: int = 15) -> DataFrame:
    order = (F.desc_nulls_last("amount_at_risk"), "mcc_description", "total_transactions")
    return mcc_rates(by_mcc, view).orderBy(*order).limit(n)


def top_mcc_rate(by_mcc: DataFrame, view: View = FRAUD, n: int = 15) -> DataFrame:
    order = (F.desc_nulls_last("fraud_rate"), "mcc_description", "total_transactions")
    top = mcc_rates(by_mcc, view).orderBy(*order).limit(n)
    return top.withColumn("fraud_rate_pct", F.round(F.col("fraud_rate") * 100, 3))


def top_categories_risk(by_mcc: DataFrame, n: int = 10) -> DataFrame:
    top = (
        known_categories(by_mcc)
        .where("total_fraud > 0")
        .orderBy(
            F.desc_nulls_last("amount_at_risk"), F.desc_nulls_last("total_fraud"), "mcc_description"
        )
        .limit(n)
    )
    return top.select(
        "mcc_description",
        F.col("total_transactions").alias("txns"),
        F.col("total_fraud").alias("fraud"),
        "fraud_rate",
        "amount_at_risk",
        F.round(F.col("fraud_rate") * 100, 3).alias("fraud_pct"),
    )


def category_options(by_mcc: DataFrame) -> DataFrame:
    return known_categories(by_mcc).select("mcc_description").distinct().orderBy("mcc_description")


def top_mcc_volume(by_mcc: DataFrame, n: int = 15) -> DataFrame:
    """Regrouped by description: several codes may share one."""
    return (
        known_categories(by_mcc)
        .groupBy("mcc_description")
        .agg(F.sum("total_transactions").alias("txns"))
        .orderBy(F.desc_nulls_last("txns"), "mcc_description")
        .limit(n)
    )


# -- cards -------------------------------------------------------------------------------------


def card_segments(by_card: DataFrame, view: View = FRAUD) -> DataFrame:
    return by_card.where("card_brand is not null").select(
        "card_brand",
        "card_type",
        "has_chip",
        "total_transactions",
        F.col(view.count).alias("total_fraud"),
        _rate(view).alias("fraud_rate"),
    )


def _totals(by_card: DataFrame, view: View, *keys: str) -> DataFrame:
    """Re-aggregated segments; rows with a null key are left out, as in the report."""
    return (
        card_segments(by_card, view)
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.sum("total_transactions").alias("total"), F.sum("total_fraud").alias("fraud"))
    )


def brand_type_matrix(by_card: DataFrame, view: View = FRAUD) -> DataFrame:
    """Flagged percentage, one row per brand and one column per card type. The types are whatever
    the small segment table holds, so Spark reads them from it."""
    cells = _totals(by_card, view, "card_brand", "card_type").select(
        "card_brand",
        card_type_name("card_type").alias("card_type"),
        percent(F.col("fraud"), F.col("total"), 4).alias("fraud_pct"),
    )
    return cells.groupBy("card_brand").pivot("card_type").agg(F.max("fraud_pct"))


def brand_ranking(by_card: DataFrame, view: View = FRAUD) -> DataFrame:
    totals = _totals(by_card, view, "card_brand")
    rated = totals.withColumn("fraud_pct", percent(F.col("fraud"), F.col("total"), 4))
    return rated.orderBy(F.desc_nulls_last("fraud_pct"), "card_brand")


def chip_rates(by_card: DataFrame, view: View = FRAUD) -> DataFrame:
    return _totals(by_card, view, "has_chip").select(
        F.when(F.col("has_chip"), "Con chip").otherwise("Sin chip").alias("has_chip"),
        "total",
        "fraud",
        ratio(F.lit(100.0) * F.col("fraud"), F.col("total")).alias("fraud_pct"),
    )


def brand_share(by_card: DataFrame) -> DataFrame:
    brands = (
        by_card.where("card_brand is not null")
        .groupBy("card_brand")
        .agg(F.sum("total_transactions").alias("txns"))
    )
    return with_share(brands, "txns", 1)


def card_type_share(by_card: DataFrame) -> DataFrame:
    kinds = (
        by_card.where("card_type is not null")
        .groupBy("card_type")
        .agg(F.sum("total_transactions").alias("txns"))
    )
    return with_share(kinds, "txns", 1).withColumn("card_type", card_type_name("card_type"))
