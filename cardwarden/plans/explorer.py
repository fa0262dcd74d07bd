"""Combined filters over the facts, their summary and their newest rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.numbers import money_sum_or_zero

DETAIL_COLUMNS = (
    "transaction_id", "transaction_date", "user_id", "card_id", "amount", "transaction_type",
    "merchant_city", "merchant_state", "mcc_description", "card_brand", "distance_km", "is_fraud",
    "is_suspicious", "fraud_score", "suspicion_reasons",
)


@dataclass(frozen=True)
class Filters:
    """Optional conditions, all of which must hold. The dates are inclusive days."""

    user: str | None = None
    card: str | None = None
    transaction_type: str | None = None
    category: str | None = None
    state: str | None = None
    brand: str | None = None
    first_day: dt.date | None = None
    last_day: dt.date | None = None
    fraud_only: bool = False
    suspicious_only: bool = False

    def conditions(self) -> list[Column]:
        exact = {
            "user_id": self.user,
            "card_id": self.card,
            "transaction_type": self.transaction_type,
            "mcc_description": self.category,
            "merchant_state": self.state,
            "card_brand": self.brand,
        }
        found = [F.col(column) == value for column, value in exact.items() if value]
        when = F.col("transaction_date")
        if self.first_day:
            found.append(when >= F.lit(self.first_day).cast("timestamp_ntz"))
        if self.last_day:
            next_day = self.last_day + dt.timedelta(days=1)
            found.append(when < F.lit(next_day).cast("timestamp_ntz"))
        if self.fraud_only:
            found.append(F.col("is_fraud"))
        if self.suspicious_only:
            found.append(F.col("is_suspicious"))
        return found

    def apply(self, facts: DataFrame) -> DataFrame:
        conditions = self.conditions()
        return facts.where(reduce(and_, conditions)) if conditions else facts


def explorer_summary(facts: DataFrame, filters: Filters) -> DataFrame:
    amount = F.col("amount")
    return filters.apply(facts).agg(
        F.count("*").alias("total"),
        F.count_if("is_fraud").alias("fraude"),
        F.count_if("is_suspicious").alias("sospechosas"),
        money_sum_or_zero(amount).alias("monto_total"),
        money_sum_or_zero(amount, F.col("is_fraud")).alias("monto_fraude"),
    )


def explorer_detail(facts: DataFrame, filters: Filters, n: int = 500) -> DataFrame:
    return (
        filters.apply(facts)
        .select(*DETAIL_COLUMNS)
        .orderBy(F.desc_nulls_last("transaction_date"), F.desc("transaction_id"))
        .limit(n)
    )
