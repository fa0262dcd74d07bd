"""Every registered query by name: ``(spark, table folder) -> DataFrame``.

Queries up to the clean step start from the raw inputs, which Spark derives from the given tables once
per application and folder. Queries that need scored facts or segment tables read the warehouse that
one full refresh fills in the shared folder, as reports do: a few columns of Parquet, not the whole job
again.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from dataclasses import fields, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.operators import clean, enrich, features, metrics, profiles, quality, scoring
from cardwarden.plans import (
    behaviour,
    datasets,
    ensemble,
    explorer,
    incremental,
    merchants,
    overview,
    refresh,
    segments,
    users,
)
from cardwarden.plans.views import FRAUD, SUSPICIOUS
from cardwarden.plans.warehouse import ADDITIONS, SEGMENT_ADDITIONS, Warehouse, add_columns, conform_facts, insert_if_absent
from cardwarden.session import staging_root
from cardwarden.sources import files
from cardwarden.sources.staging import read_stage, spread, stage
from cardwarden.sources.star import Inputs, cards_from, star_inputs, users_from
from cardwarden.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

USER = "7"
FILTERS = explorer.Filters(
    transaction_type="Swipe",
    brand="Visa",
    first_day=dt.date(2024, 6, 1),
    last_day=dt.date(2025, 12, 31),
)
_NARROW = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint"}


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and decimals as double, for comparison with another engine."""
    target = {
        f.name: "double" if isinstance(f.dataType, T.DecimalType) else _NARROW.get(f.dataType.simpleString())
        for f in df.schema.fields
    }
    return df.select(
        *[F.col(f"`{c}`").cast(t).alias(c) if t else F.col(f"`{c}`") for c, t in target.items()]
    )


class Site:
    """Staged results of one table folder in one application."""

    _known: dict[tuple[str, str], "Site"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = f"{staging_root(spark)}/{hashlib.sha1(sf_dir.encode()).hexdigest()[:12]}"
        self.warehouse = Warehouse(spark, f"{self.root}/warehouse")
        self._run: str | None = None
        self._inputs: Inputs | None = None

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Site":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    def inputs(self) -> Inputs:
        """The five raw inputs, landed once as tables of text, as files would arrive."""
        if self._inputs is None:
            given = star_inputs(self.spark, self.sf_dir)
            given = replace(given, transactions=spread(given.transactions))
            names = [f.name for f in fields(given)]
            landed = refresh.at_once(*[partial(stage, getattr(given, n), self.landing(n)) for n in names])
            self._inputs = Inputs(**dict(zip(names, landed)))
        return self._inputs

    def landing(self, name: str) -> str:
        return f"{self.root}/landing/{name}"

    def run(self) -> str:
        if self._run is None:
            inputs = self.inputs()
            self._run = refresh.run(self.spark, inputs, self.warehouse)
        return self._run

    def table(self, name: str) -> DataFrame:
        return self.warehouse.table(name, self.run())

    def facts(self) -> DataFrame:
        return self.table("transactions_processed")

    def _staged(self, name: str) -> DataFrame:
        return read_stage(self.spark, f"{self.warehouse.root}/staging/{self.run()}/{name}")

    def merged(self) -> DataFrame:
        return self._staged("merged")

    def cleaned(self) -> DataFrame:
        return clean.clean_transactions(self.merged())

    def profiles(self) -> profiles.Profiles:
        return profiles.Profiles(self._staged("user_p99"), self._staged("card_frequency"))

    def signals(self) -> DataFrame:
        featured = features.derive_features(self.cleaned())
        return scoring.add_signals(scoring.join_profiles(featured, self.profiles()))

    def export(self, name: str, df: DataFrame, kind: str) -> str:
        """Writes a table as the text files a reader expects and returns the folder."""
        path = f"{self.root}/export/{name}"
        writer = df.write.mode("overwrite")
        if kind == "csv":
            writer.option("header", True).option("escape", '"').option("sep", ";").csv(path)
        else:
            writer.text(path)
        return path


def _registered(build: Callable[[Site], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(Site.of(spark, sf_dir)))

    return query


# -- sources -----------------------------------------------------------------------------------


def scan_transactions(site: Site) -> DataFrame:
    raw = site.inputs().transactions.drop("event_time").withColumnRenamed("transaction_id", "id")
    return files.scan_transactions(site.spark, site.export("transactions", raw, "csv"))


def scan_quoted_records(site: Site) -> DataFrame:
    """Texts with line breaks, quotes and delimiters, exported as quoted cells and scanned again."""
    raw = site.spark.read.parquet(f"{site.sf_dir}/documents.parquet")
    return files.read_delimited(site.spark, site.export("documents", raw, "csv"), ";")


def load_users(site: Site) -> DataFrame:
    raw = users_from(site.spark.read.parquet(f"{site.sf_dir}/customer.parquet"))
    return files.load_users(site.spark, site.export("users", raw, "csv"))


def load_cards(site: Site) -> DataFrame:
    raw = cards_from(site.spark.read.parquet(f"{site.sf_dir}/part.parquet"))
    return files.load_cards(site.spark, site.export("cards", raw, "csv"))


def load_mcc(site: Site) -> DataFrame:
    """The category table as one JSON object; it has ten rows at every scale."""
    entries = F.map_from_entries(F.collect_list(F.struct("mcc", "mcc_description")))
    whole = site.inputs().mcc.agg(F.to_json(entries).alias("value"))
    return files.load_mcc(site.spark, site.export("mcc", whole, "text"))


def load_labels(site: Site) -> DataFrame:
    """Labels as JSON objects of some thousand pairs each, nested under ``target``; the same ids stand beside it with
    an answer that must not count."""
    labels = site.inputs().labels
    answer = F.when(F.col("is_fraud"), "Yes").otherwise("No")
    pairs = F.map_from_entries(F.collect_list(F.struct("transaction_id", answer)))
    chunk = F.floor(F.col("transaction_id").cast("bigint") / 4000)
    beside = F.map_from_entries(F.collect_list(F.struct("transaction_id", F.lit("Yes"))))
    objects = labels.groupBy(chunk.alias("chunk")).agg(pairs.alias("target"), beside.alias("reviewed"))
    text = objects.select(F.to_json(F.struct("target", "reviewed")).alias("value"))
    return files.load_labels(site.spark, site.export("labels", text, "text"))


def stage_roundtrip(site: Site) -> DataFrame:
    merged = refresh.merge_inputs(site.inputs()).drop("event_time")
    return stage(merged, f"{site.root}/roundtrip")


# -- joins, cleaning, features -----------------------------------------------------------------


def join_labels(site: Site) -> DataFrame:
    inputs = site.inputs()
    return enrich.join_labels(inputs.transactions, inputs.labels).select("transaction_id", "is_fraud")


def join_cards(site: Site) -> DataFrame:
    inputs = site.inputs()
    return enrich.join_cards(inputs.transactions, inputs.cards).select(
        "transaction_id", "card_id", "card_brand", "card_type", "has_chip", "credit_limit", "card_on_dark_web"
    )


def join_users(site: Site) -> DataFrame:
    inputs = site.inputs()
    return enrich.join_users(inputs.transactions, inputs.users).select(
        "transaction_id", "user_id", "current_age", "gender", "latitude", "longitude",
        "yearly_income", "total_debt", "credit_score",
    )


def join_mcc(site: Site) -> DataFrame:
    inputs = site.inputs()
    return enrich.join_mcc(inputs.transactions, inputs.mcc).select(
        "transaction_id", "mcc", "mcc_description"
    )


def join_centroids(site: Site) -> DataFrame:
    return enrich.join_centroids(site.inputs().transactions).select(
        "transaction_id", "merchant_state", "merchant_lat", "merchant_lon"
    )


def enrich_transactions(site: Site) -> DataFrame:
    return refresh.merge_inputs(site.inputs()).drop("event_time")


def clean_dates(site: Site) -> DataFrame:
    typed = clean.type_columns(site.inputs().transactions.select("transaction_id", "date", "amount"))
    return typed.select("transaction_id", "transaction_date")


def clean_money(site: Site) -> DataFrame:
    merged = refresh.merge_inputs(site.inputs())
    return clean.type_columns(merged).select("transaction_id", *clean.MONEY_COLUMNS)


def clean_flags(site: Site) -> DataFrame:
    merged = refresh.merge_inputs(site.inputs())
    return clean.type_columns(merged).select("transaction_id", *clean.FLAG_COLUMNS)


def clean_transactions(site: Site) -> DataFrame:
    return clean.clean_transactions(site.inputs().transactions).select(
        "transaction_id", "transaction_date", "amount"
    )


def rejected_rows(site: Site) -> DataFrame:
    return clean.rejected_rows(site.inputs().transactions)


def _rounded(df: DataFrame, column: str, digits: int) -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


def haversine_distance(site: Site) -> DataFrame:
    located = features.add_distance(site.cleaned()).select("transaction_id", "distance_km")
    return _rounded(located, "distance_km", 6)


def derive_features(site: Site) -> DataFrame:
    featured = features.derive_features(site.cleaned()).select(
        "transaction_id", "is_online", "transaction_type", "debt_income_ratio", "hour", "distance_km"
    )
    return _rounded(featured, "distance_km", 6)


# -- profiles and scores -----------------------------------------------------------------------


def _profile_rows(site: Site) -> DataFrame:
    return refresh.profile_columns(site.merged())


def fraud_signals(site: Site) -> DataFrame:
    return site.signals().select("transaction_id", *scoring.SIGNALS)


def fraud_score(site: Site) -> DataFrame:
    return scoring.add_score(site.signals()).select("transaction_id", "fraud_score", "is_suspicious")


def suspicion_reasons(site: Site) -> DataFrame:
    return scoring.add_score(site.signals()).select("transaction_id", "suspicion_reasons")


def transactions_processed(site: Site) -> DataFrame:
    """Scored facts in load order, straight from the staged inputs."""
    return conform_facts(scoring.score_transactions(site.cleaned(), site.profiles()))


def dwh_projection(site: Site) -> DataFrame:
    """The stored facts in load order, as declared."""
    return conform_facts(site.facts())


# -- sinks -------------------------------------------------------------------------------------


def full_refresh(site: Site) -> DataFrame:
    """Runs a whole refresh of its own and reports the row count of every published table."""
    warehouse = Warehouse(site.spark, f"{site.root}/second-warehouse")
    run = refresh.run(site.spark, site.inputs(), warehouse)
    counts = [
        warehouse.table(name, run).agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        for name in sorted(refresh.schemas.WAREHOUSE)
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def insert_absent(site: Site) -> DataFrame:
    """User profiles of odd ids as the target, all profiles as the rows to insert."""
    stored = site.table("user_profiles").select("user_id", "total_transactions")
    target = stored.where(F.col("user_id").cast("bigint") % 2 == 1).withColumn(
        "total_transactions", F.lit(-1).cast("bigint")
    )
    return insert_if_absent(target, stored, "user_id")


def schema_evolution(site: Site) -> DataFrame:
    """A category table of an older layout gains the missing measures with their defaults."""
    older = site.table("fraud_by_mcc").drop(*SEGMENT_ADDITIONS, "computed_at")
    return add_columns(older, SEGMENT_ADDITIONS)


def old_runs_upgraded(site: Site) -> DataFrame:
    """All tables of a run in the first layout, read through the warehouse together with those of a run of today: rows
    of both, the columns that the old run lacked, and how many of its cells a default filled."""
    old = Warehouse(site.spark, f"{site.root}/old-warehouse/{site.warehouse.new_run()}")
    run = old.new_run()
    for name, added in ADDITIONS.items():
        site.table(name).drop(*added).write.parquet(old.location(name, run))
    old.record_schemas(run)
    old.publish(run)
    result = None
    for name, added in ADDITIONS.items():
        had = [r["column_name"] for r in old.schema_record().where(F.col("table_name") == name).collect()]
        gained = sorted(c for c in old.table(name).columns if c not in had)
        both = old.table(name).withColumn("old", F.lit(True)).unionByName(site.table(name).withColumn("old", F.lit(False)))
        filled = [F.count(F.when(F.col("old"), F.col(c))) for c in gained]
        counts = both.agg(F.count("*").alias("rows"), F.lit(",".join(gained)).alias("gained"), sum(filled[1:], filled[0]).alias("filled"))
        counts = counts.select(F.lit(name).alias("table_name"), "*")
        result = counts if result is None else result.unionByName(counts)
    return result


def run_log(site: Site) -> DataFrame:
    site.run()
    return site.warehouse.run_log().select("status", "rows_processed", "rows_fraud", "notes")


def last_run(site: Site) -> DataFrame:
    site.run()
    return datasets.last_run(site.warehouse.run_log()).drop("run_at")


# -- behaviour over time -----------------------------------------------------------------------
#
# The adapter spreads transaction dates over years; these queries use the events' own times, where a
# user's transactions are dense.

TIME = "event_time"


def velocity_5min(site: Site) -> DataFrame:
    return behaviour.velocity_windows(site.cleaned(), TIME)


def velocity_features(site: Site) -> DataFrame:
    return behaviour.velocity_features(site.cleaned(), TIME)


def impossible_travel(site: Site) -> DataFrame:
    pairs = behaviour.impossible_travel(site.cleaned(), TIME)
    for column, digits in (("km", 3), ("hours", 6), ("kmh", 3)):
        pairs = _rounded(pairs, column, digits)
    return pairs


def amount_zscore(site: Site) -> DataFrame:
    cleaned = site.cleaned()
    profile = stage(behaviour.amount_profile(cleaned), f"{site.root}/amount_profile")
    scored = behaviour.amount_zscore(cleaned, profile)
    for column in ("mean_amount", "sd_amount", "z"):
        scored = _rounded(scored, column, 6)
    return scored


def novelty_flags(site: Site) -> DataFrame:
    return behaviour.novelty_flags(site.cleaned(), TIME)


def p99_by_channel(site: Site) -> DataFrame:
    return profiles.p99_by(features.add_channel(site.cleaned()), "transaction_type")


INCREMENTAL_CUT = dt.date(2026, 1, 1)


def incremental_upsert(site: Site) -> DataFrame:
    """Facts up to 2025 with an empty card count as the target; the load brings everything newer,
    and replaces the last thirty days."""
    source = site.facts().select("transaction_id", "transaction_date", "fraud_score", "card_txn_count")
    target = source.where(F.col("transaction_date") < F.lit(INCREMENTAL_CUT)).withColumn(
        "card_txn_count", F.lit(0).cast("bigint")
    )
    return incremental.load_newer(target, source, "transaction_id", "transaction_date", "30 days")


def partitioned_write(site: Site) -> DataFrame:
    path = f"{site.root}/by_month"
    incremental.write_by_month(site.facts(), path)
    return site.spark.read.parquet(path).groupBy("year", "month").agg(
        F.count("*").alias("total"), F.count_if("is_fraud").alias("fraud")
    )


def ml_ensemble(site: Site) -> DataFrame:
    rows = ensemble.model_rows(site.facts())
    model = ensemble.train(rows)
    threshold = ensemble.choose_threshold(ensemble.predict(rows, model))
    return ensemble.compare(ensemble.predict(rows, model, threshold))


# -- streams -----------------------------------------------------------------------------------


def _event_stream(site: Site) -> DataFrame:
    """The landed raw transactions as a stream of files."""
    schema = site.inputs().transactions.schema
    return site.spark.readStream.schema(schema).parquet(site.landing("transactions"))


def _stream_dirs(site: Site, name: str) -> tuple[str, str]:
    """Output and checkpoint of a new run of a stream."""
    base = f"{site.root}/streams/{name}/{site.warehouse.new_run()}"
    return f"{base}/table", f"{base}/checkpoint"


def _scored_stream(site: Site) -> DataFrame:
    inputs = site.inputs()
    return jobs.score_stream(
        _event_stream(site), inputs.cards, inputs.users, inputs.mcc, site.profiles()
    )


def stream_scoring(site: Site) -> DataFrame:
    table, checkpoint = _stream_dirs(site, "scoring")
    scored = _scored_stream(site).select(
        "transaction_id", "amount", "transaction_type", "fraud_score", "is_suspicious", "suspicion_reasons"
    )
    jobs.append_to_table(scored, table, checkpoint).awaitTermination()
    return site.spark.read.parquet(table)


def velocity_5min_stream(site: Site) -> DataFrame:
    """The stream runs to the end of its source; a closing event then brings out the windows that were open."""
    table, checkpoint = _stream_dirs(site, "velocity")
    cleaned = lambda df: clean.clean_transactions(df).withColumnRenamed("client_id", "user_id")
    closing = jobs.closing_stream(site.spark, f"{checkpoint}-closing", TIME)
    counted = jobs.velocity_stream(cleaned(_event_stream(site)), TIME, closing=closing)
    jobs.append_to_table(counted, table, checkpoint).awaitTermination()
    jobs.write_closing(cleaned(site.inputs().transactions), f"{checkpoint}-closing", TIME)
    jobs.append_to_table(counted, table, checkpoint).awaitTermination()
    return site.spark.read.parquet(table)


def stream_dedup(site: Site) -> DataFrame:
    """The transactions and a replay of a third of them, as one stream."""
    raw = site.inputs().transactions.select("transaction_id", "client_id", "amount", TIME)
    replay = raw.where(F.col("transaction_id").cast("bigint") % 3 == 0)
    folder = f"{site.root}/replayed"
    raw.unionByName(replay).write.mode("overwrite").parquet(folder)
    source = site.spark.readStream.schema(raw.schema).parquet(folder)
    table, checkpoint = _stream_dirs(site, "dedup")
    once = jobs.dedupe_stream(source, "transaction_id", TIME)
    jobs.append_to_table(once, table, checkpoint).awaitTermination()
    return site.spark.read.parquet(table)


def stream_segment_metrics(site: Site) -> DataFrame:
    table, checkpoint = _stream_dirs(site, "segments")
    totals = jobs.segment_stream(_scored_stream(site), TIME, "mcc_description")
    jobs.update_table(totals, table, checkpoint, every=None).awaitTermination()
    return jobs.latest(site.spark, table, ["window_start", "mcc_description"])


def _on_facts(report: Callable[..., DataFrame], *args, **kwargs) -> Callable[[Site], DataFrame]:
    return lambda site: report(site.facts(), *args, **kwargs)


def _on(table: str, report: Callable[..., DataFrame], *args, **kwargs) -> Callable[[Site], DataFrame]:
    return lambda site: report(site.table(table), *args, **kwargs)


def amount_histogram_sampled(site: Site) -> DataFrame:
    return overview.amount_histogram(site.facts(), fraction=overview.SAMPLE_FRACTION)


# Reports with a fraud view and a suspicion view: name -> (function of table and view, table).
VIEWED = {
    "channel_breakdown": (overview.channel_breakdown, "transactions_processed"),
    "amount_histogram": (overview.amount_histogram, "transactions_processed"),
    "yearly_trend": (overview.yearly_trend, "transactions_processed"),
    "monthly_trend": (overview.monthly_trend, "transactions_processed"),
    "dow_hour_heatmap": (overview.dow_hour_heatmap, "transactions_processed"),
    "dow_hour_pivot": (overview.dow_hour_pivot, "transactions_processed"),
    "dark_web_rates": (overview.dark_web_rates, "transactions_processed"),
    "state_rates": (segments.state_rates, "fraud_by_state"),
    "top_states_rate": (segments.top_states_rate, "fraud_by_state"),
    "top_states_amount": (segments.top_states_amount, "fraud_by_state"),
    "top_international": (segments.top_international, "fraud_by_state"),
    "international_with_fraud": (segments.international_with_fraud, "fraud_by_state"),
    "international_counts": (segments.international_counts, "fraud_by_state"),
    "mcc_rates": (segments.mcc_rates, "fraud_by_mcc"),
    "top_mcc_amount": (segments.top_mcc_amount, "fraud_by_mcc"),
    "top_mcc_rate": (segments.top_mcc_rate, "fraud_by_mcc"),
    "card_segments": (segments.card_segments, "fraud_by_card_type"),
    "brand_type_matrix": (segments.brand_type_matrix, "fraud_by_card_type"),
    "brand_ranking": (segments.brand_ranking, "fraud_by_card_type"),
    "chip_rates": (segments.chip_rates, "fraud_by_card_type"),
}


def _builders() -> dict[str, Callable[[Site], DataFrame]]:
    found: dict[str, Callable[[Site], DataFrame]] = {
        f.__name__: f
        for f in (
            scan_transactions, scan_quoted_records, load_users, load_cards, load_mcc, load_labels, stage_roundtrip,
            join_labels, join_cards, join_users, join_mcc, join_centroids, enrich_transactions,
            clean_dates, clean_money, clean_flags, clean_transactions, rejected_rows,
            haversine_distance, derive_features, fraud_signals, fraud_score, suspicion_reasons,
            transactions_processed, dwh_projection, full_refresh, schema_evolution, old_runs_upgraded, run_log, last_run,
            velocity_5min, velocity_features, impossible_travel, amount_zscore, novelty_flags,
            p99_by_channel, incremental_upsert, partitioned_write, stream_scoring,
            velocity_5min_stream, stream_dedup, stream_segment_metrics, amount_histogram_sampled,
            ml_ensemble,
        )
    }
    found |= {
        "insert_if_absent": insert_absent,
        "user_p99": lambda s: profiles.user_p99(_profile_rows(s)),
        "user_hour_profile": lambda s: profiles.user_hour_profile(_profile_rows(s)),
        "card_frequency": lambda s: profiles.card_frequency(_profile_rows(s)),
        "p99_by_mcc": lambda s: profiles.p99_by(s.cleaned(), "mcc"),
        "threshold_sweep": _on_facts(behaviour.threshold_sweep),
        "ensemble_split": _on_facts(ensemble.split_counts),
        "score_distribution": _on_facts(scoring.score_distribution),
        "metrics_global": _on_facts(metrics.metrics_global),
        "fraud_by_mcc": _on_facts(metrics.fraud_by_mcc),
        "fraud_by_card_type": _on_facts(metrics.fraud_by_card_type),
        "fraud_by_state": _on_facts(metrics.fraud_by_state),
        "fraud_by_merchant": _on_facts(metrics.fraud_by_merchant),
        "user_profiles": _on_facts(metrics.user_profiles),
        "qc_negative_amounts": _on_facts(quality.negative_amounts),
        "qc_counts": _on_facts(quality.fact_counts),
        "qc_duplicate_ids": _on_facts(quality.duplicate_ids),
        "data_quality_report": _on_facts(quality.data_quality_report),
        "kpi_fraud": _on_facts(overview.kpis, FRAUD),
        "kpi_suspicious": _on_facts(overview.kpis, SUSPICIOUS),
        "confusion_matrix": _on_facts(overview.confusion_matrix),
        "precision_recall_f1": lambda s: overview.precision_recall_f1(
            overview.confusion_matrix(s.facts())
        ),
        "top_fraud_users": _on("user_profiles", users.top_fraud_users),
        "user_profile_lookup": _on("user_profiles", users.user_profile_lookup, USER),
        "user_monthly_spend": _on_facts(users.user_monthly_spend, USER),
        "user_amount_histogram": _on_facts(users.user_amount_histogram, USER),
        "user_category_mix": _on_facts(users.user_category_mix, USER),
        "user_geography": _on_facts(users.user_geography, USER),
        "user_history": _on_facts(users.user_history, USER),
        "merchant_kpis": _on("fraud_by_merchant", merchants.merchant_kpis),
        "merchant_concentration": _on("fraud_by_merchant", merchants.merchant_concentration),
        "top_merchants": _on("fraud_by_merchant", merchants.top_merchants),
        "top_categories_risk": _on("fraud_by_mcc", segments.top_categories_risk),
        "dataset_date_range": _on("fraud_metrics_global", datasets.dataset_date_range),
        "category_options": _on("fraud_by_mcc", segments.category_options),
        "explorer_summary": _on_facts(explorer.explorer_summary, FILTERS),
        "explorer_detail": _on_facts(explorer.explorer_detail, FILTERS),
        "transaction_summary": _on_facts(datasets.transaction_summary),
        "yearly_volume": _on_facts(datasets.yearly_volume),
        "channel_share": _on_facts(datasets.channel_share),
        "user_summary": _on("user_profiles", datasets.user_summary),
        "age_histogram": _on("user_profiles", datasets.age_histogram),
        "gender_share": _on("user_profiles", datasets.gender_share),
        "income_histogram": _on("user_profiles", datasets.income_histogram),
        "credit_histogram": _on("user_profiles", datasets.credit_histogram),
        "card_summary": _on_facts(datasets.card_summary),
        "brand_share": _on("fraud_by_card_type", segments.brand_share),
        "card_type_share": _on("fraud_by_card_type", segments.card_type_share),
        "label_balance": _on_facts(datasets.label_balance),
        "mcc_usage": _on_facts(datasets.mcc_usage),
        "top_mcc_volume": _on("fraud_by_mcc", segments.top_mcc_volume),
    }
    for name, (report, table) in VIEWED.items():
        found[name] = _on(table, partial(report, view=FRAUD))
        found[f"{name}_suspicious"] = _on(table, partial(report, view=SUSPICIOUS))
    return found


def all_queries() -> dict[str, Query]:
    return {name: _registered(build) for name, build in _builders().items()}
