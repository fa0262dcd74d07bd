"""The full refresh: raw inputs to published warehouse tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.config import DEFAULT_RULES, ScoreRules
from cardwarden.operators import metrics, quality
from cardwarden.operators.clean import clean_transactions, type_columns
from cardwarden.operators.enrich import enrich_transactions
from cardwarden.operators.profiles import Profiles, build_profiles
from cardwarden.operators.scoring import score_transactions
from cardwarden.plans.warehouse import (
    Warehouse,
    conform,
    conform_card_types,
    conform_profiles,
    stamped,
)
from cardwarden.sources import files
from cardwarden.sources.staging import spread, stage
from cardwarden.sources.star import Inputs

FACT_ORDER = ("user_id", "transaction_date")


def read_inputs(
    spark: SparkSession, transactions: str, users: str, cards: str, labels: str, mcc: str,
    delimiters: dict[str, str] | None = None,
) -> Inputs:
    """The five files, checked for their columns. ``delimiters`` names those of transactions, users or cards that are
    known; the others are found from a file's first lines."""
    known = delimiters or {}
    return Inputs(
        transactions=files.scan_transactions(spark, transactions, known.get("transactions")),
        users=files.load_users(spark, users, known.get("users")),
        cards=files.load_cards(spark, cards, known.get("cards")),
        mcc=files.load_mcc(spark, mcc),
        labels=files.load_labels(spark, labels),
    )


def merge_inputs(inputs: Inputs) -> DataFrame:
    return enrich_transactions(
        inputs.transactions, inputs.labels, inputs.cards, inputs.users, inputs.mcc
    )


def merge_typed(inputs: Inputs, labels: DataFrame) -> DataFrame:
    """The merged table as it is staged: every text is parsed once, users and cards before their
    joins. The later passes read numbers and timestamps."""
    return enrich_transactions(
        type_columns(inputs.transactions).drop("date"),
        labels,
        type_columns(inputs.cards),
        type_columns(inputs.users),
        inputs.mcc,
    )


def profile_columns(merged: DataFrame) -> DataFrame:
    """The few columns profiles need, so that only those are read from the staged table."""
    return clean_transactions(merged).select("user_id", "card_id", "transaction_date", "amount")


def stage_profiles(merged: DataFrame, root: str, rules: ScoreRules = DEFAULT_RULES) -> Profiles:
    """Profiles written to storage: two small jobs over three columns, then tables of known size."""
    lazy = build_profiles(profile_columns(merged), rules)
    return Profiles(
        *at_once(
            lambda: stage(lazy.user_p99, f"{root}/user_p99"),
            lambda: stage(lazy.card_frequency, f"{root}/card_frequency"),
        )
    )


def at_once(*jobs: Callable[[], DataFrame]) -> list[DataFrame]:
    """Submits independent jobs together, so that the tail of one leaves no cores idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [future.result() for future in [pool.submit(job) for job in jobs]]


def run(
    spark: SparkSession, inputs: Inputs, warehouse: Warehouse, rules: ScoreRules = DEFAULT_RULES
) -> str:
    """Runs every step, publishes the tables at once and returns the name of the run. Success and
    failure are both logged; after a failure the tables of the run before stay current."""
    started = time.monotonic()
    name = warehouse.new_run()
    try:
        facts = _load(inputs, warehouse, name, rules)
        quality.assert_no_negative_amounts(facts)
        warehouse.record_schemas(name)
        warehouse.publish(name)
        warehouse.expire_staging()
    except Exception as error:
        warehouse.discard(name, "staging", "runs")
        warehouse.log_run("error", None, time.monotonic() - started, str(error))
        raise
    warehouse.log_run(
        "success", quality.fact_counts(facts), time.monotonic() - started, "refresh completed"
    )
    return name


def _load(inputs: Inputs, warehouse: Warehouse, name: str, rules: ScoreRules) -> DataFrame:
    """Writes all tables of a run and returns its facts.

    The merged table and the profiles are staged next to the warehouse; labels are staged first, so
    that the label join sees a plain scan. The facts are written once and the metrics read them back,
    a few columns each.
    """
    staging = f"{warehouse.root}/staging/{name}"
    labels = stage(inputs.labels, f"{staging}/labels")
    raw = replace(inputs, transactions=spread(inputs.transactions))
    merged = stage(merge_typed(raw, labels), f"{staging}/merged")
    profiles = stage_profiles(merged, staging, rules)
    scored = score_transactions(clean_transactions(merged), profiles, rules, FACT_ORDER)
    facts = warehouse.write_clustered(
        name,
        "transactions_processed",
        conform(scored, schemas.STORED_FACT).withColumn(
            "processed_at", F.current_timestamp().cast("timestamp_ntz")
        ),
        FACT_ORDER,
        dealt=True,
    )

    tables = {
        "fraud_metrics_global": conform(metrics.metrics_global(facts), schemas.METRICS_GLOBAL),
        "fraud_by_mcc": conform(metrics.fraud_by_mcc(facts), schemas.BY_MCC),
        "fraud_by_card_type": conform_card_types(metrics.fraud_by_card_type(facts)),
        "fraud_by_state": conform(metrics.fraud_by_state(facts), schemas.BY_STATE),
        "fraud_by_merchant": conform(metrics.fraud_by_merchant(facts), schemas.BY_MERCHANT),
        "user_profiles": conform_profiles(metrics.user_profiles(facts)),
    }
    at_once(*[partial(warehouse.write, name, table, stamped(df)) for table, df in tables.items()])
    return facts
