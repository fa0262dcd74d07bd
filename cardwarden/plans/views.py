"""The two views of a report: real fraud (the label) or suspicion (the score)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.functions.numbers import percent


@dataclass(frozen=True)
class View:
    flag: str
    count: str
    amount: str
    flagged_label: str
    other_label: str


FRAUD = View("is_fraud", "total_fraud", "amount_at_risk", "Fraude", "Legítima")
SUSPICIOUS = View(
    "is_suspicious", "total_suspicious", "amount_suspicious", "Sospechosa", "No sospechosa"
)


def with_share(df: DataFrame, column: str, digits: int) -> DataFrame:
    """Adds ``pct``, each row's share of the column's total. For small category tables: the window
    spans all rows."""
    whole = F.sum(column).over(W.partitionBy(F.lit(0)))
    return df.withColumn("pct", percent(F.col(column), whole, digits))


def one_row(*results: DataFrame) -> DataFrame:
    """One-row results side by side, without a join: stack them and keep the known values."""
    stacked = results[0]
    for other in results[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
