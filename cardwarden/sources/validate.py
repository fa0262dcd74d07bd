"""Checks that fail fast before any work starts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cardwarden.schemas import OPTIONAL_COLUMNS, REQUIRED_COLUMNS


class MissingColumnError(ValueError):
    """An input lacks a column the job needs."""


def require_columns(df: DataFrame, kind: str) -> DataFrame:
    for name in REQUIRED_COLUMNS[kind]:
        if name not in df.columns:
            raise MissingColumnError(
                f"{kind} has no column '{name}'. Columns found: {', '.join(df.columns)}"
            )
    return df


def absent_optional(df: DataFrame, kind: str) -> list[str]:
    """Columns that later steps use when present; the readers fill them with nulls."""
    return [c for c in OPTIONAL_COLUMNS[kind] if c not in df.columns]


def validate_inputs(transactions: DataFrame, users: DataFrame, cards: DataFrame) -> None:
    require_columns(transactions, "transactions")
    require_columns(users, "users")
    require_columns(cards, "cards")
