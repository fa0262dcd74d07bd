"""Merchant panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.numbers import percent, ratio
from cardwarden.operators.metrics import MERCHANT_KEYS

DEFAULT_MERCHANTS = 15


def merchant_kpis(by_merchant: DataFrame) -> DataFrame:
    """Counts rows of the merchant table: one per merchant, city, state and category."""
    with_fraud = F.count_if(F.col("total_fraud") > 0)
    return by_merchant.where("merchant_id <> ''").agg(
        F.count("*").alias("total_merchants"),
        with_fraud.alias("merchants_con_fraude"),
        F.coalesce(F.sum("amount_at_risk"), F.lit(0)).alias("riesgo_total"),
        F.coalesce(F.sum("total_fraud"), F.lit(0)).alias("fraudes_totales"),
        F.coalesce(
            ratio(F.lit(100.0) * with_fraud.cast("double"), F.count("*")), F.lit(0.0)
        ).alias("pct_con_fraude"),
    )


def merchant_concentration(by_merchant: DataFrame, n: int = 10) -> DataFrame:
    """Share of all risk that the ``n`` riskiest merchants hold.

    A distributed top-n and a plain sum are stacked and added up; no window has to number every
    merchant in one partition.
    """
    risky = by_merchant.where("amount_at_risk > 0").select("amount_at_risk")
    top = risky.orderBy(F.desc("amount_at_risk")).limit(n)
    parts = top.select(F.col("amount_at_risk").alias("top"), F.lit(None).alias("all")).unionByName(
        risky.select(F.lit(None).alias("top"), F.col("amount_at_risk").alias("all"))
    )
    return parts.agg(percent(F.sum("top"), F.sum("all"), 1).alias("pct_top10"))


def top_merchants(by_merchant: DataFrame, n: int = DEFAULT_MERCHANTS) -> DataFrame:
    """Most exposed merchants, by amount at risk or, where that is zero, by number of frauds."""
    exposure = F.coalesce(
        F.nullif(F.col("amount_at_risk").cast("double"), F.lit(0.0)), F.col("total_fraud").cast("double")
    )
    top = (
        by_merchant.where("merchant_id <> '' and total_fraud > 0")
        .orderBy(exposure.desc_nulls_last(), *MERCHANT_KEYS)
        .limit(n)
    )
    label = F.format_string(
        "Comercio %s (%s, %s)",
        "merchant_id",
        F.coalesce("merchant_city", F.lit("?")),
        F.coalesce("merchant_state", F.lit("?")),
    )
    return top.select(
        *MERCHANT_KEYS,
        "total_transactions",
        "total_fraud",
        "fraud_rate",
        "amount_at_risk",
        F.round(F.col("fraud_rate") * 100, 2).alias("fraud_rate_pct"),
        label.alias("label"),
    )
