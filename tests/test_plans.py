"""What the physical plans must look like."""

import pytest
from pyspark.sql import functions as F

from cardwarden import catalog
from cardwarden.operators.enrich import enrich_transactions, join_labels
from cardwarden.plans import users
from cardwarden.plans.incremental import months, write_by_month
from cardwarden.plans.warehouse import Warehouse
from cardwarden.sources.staging import stage


def plan(df, final=False):
    if final:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_lookups_are_broadcast_by_size(spark, site):
    given = site.inputs()
    text = plan(enrich_transactions(given.transactions, given.labels, given.cards, given.users, given.mcc))
    assert text.count("BroadcastHashJoin") >= 3


def test_large_lookups_are_not_broadcast(spark, site):
    given = site.inputs()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(enrich_transactions(given.transactions, given.labels, given.cards, given.users, given.mcc))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") == 4


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_user_is_split_when_profiles_are_too_large_to_broadcast(spark, tmp_path, skew_settings):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 5000))
    facts = stage(
        spark.range(0, 60000, 1, 8).select(
            hot.alias("user_id"), F.col("id").cast("string").alias("card_id"), (F.col("id") * 1.5).alias("amount")
        ),
        str(tmp_path / "facts"),
    )
    lazy = facts.groupBy("user_id").agg(F.max("amount").alias("p99_amount"))
    profile = stage(lazy, str(tmp_path / "profile"))
    joined = facts.join(profile, "user_id", "left")
    assert "SortMergeJoin(skew=true)" in plan(joined, final=True)
    assert joined.where("p99_amount is not null").count() == 60000


def test_hot_transaction_id_is_split_in_the_label_join(spark, tmp_path, skew_settings):
    ids = F.when(F.col("id") % 3 > 0, F.col("id").cast("string"))  # a third has no id
    raw = stage(
        spark.range(0, 60000, 1, 8).select(ids.alias("transaction_id"), F.col("id").alias("amount")),
        str(tmp_path / "raw"),
    )
    labels = spark.range(60000).select(
        F.col("id").cast("string").alias("transaction_id"), (F.col("id") % 2 == 0).alias("is_fraud")
    )
    joined = join_labels(raw, stage(labels, str(tmp_path / "labels")))
    assert "SortMergeJoin(skew=true)" in plan(joined, final=True)
    assert joined.count() == 60000 and joined.where("is_fraud").count() == 20000


def test_user_lookup_reaches_the_scan(site):
    text = plan(users.user_history(site.facts(), "7"))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in text
    assert "TakeOrderedAndProject" in text


def test_report_reads_only_its_columns(site):
    text = plan(catalog.overview.kpis(site.facts()))
    assert "ReadSchema: struct<amount:decimal(12,2),is_fraud:boolean>" in text


def test_months_open_only_their_folders(spark, site, tmp_path):
    write_by_month(site.facts(), str(tmp_path / "m"))
    text = plan(months(spark, str(tmp_path / "m"), (2025, 1), (2025, 2)))
    assert "PartitionFilters: [isnotnull(year" in text


def test_quantile_reads_its_input_once(site):
    text = plan(catalog.profiles.user_p99(site.cleaned()), final=True)
    assert "ReusedExchange" in text.split("== Initial Plan ==")[0]


NO_PYTHON = (
    "enrich_transactions", "transactions_processed", "metrics_global", "user_profiles", "user_p99",
    "velocity_features", "impossible_travel", "novelty_flags", "threshold_sweep", "transaction_summary",
    "load_labels", "merchant_concentration",
)


@pytest.mark.parametrize("name", NO_PYTHON)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(catalog.all_queries()[name](spark, sf_dir))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert node not in text


@pytest.mark.parametrize("name", ["user_profiles", "fraud_by_merchant", "metrics_global", "card_summary"])
def test_facts_are_hashed_not_sorted(spark, sf_dir, name):
    text = plan(catalog.all_queries()[name](spark, sf_dir))
    below_shuffles = text[text.rindex("Exchange"):]
    assert "HashAggregate" in below_shuffles and "SortAggregate" not in below_shuffles


def test_facts_are_clustered_by_user(spark, site, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    spread = site.facts().repartition(4)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:  # without AQE, so that the small table is not put into one file
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        written = warehouse.write_clustered("r", "t", spread, ("user_id", "transaction_date"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    ranges = sorted(
        tuple(r)
        for r in written.selectExpr("_metadata.file_name as f", "user_id as u")
        .groupBy("f").agg({"u": "min", "*": "count"}).select("min(u)").collect()
    )
    assert len(ranges) == 4 and len(set(ranges)) == 4


def test_a_sample_of_everything_is_the_exact_histogram(site):
    from cardwarden.plans.overview import amount_histogram

    whole = {tuple(r) for r in amount_histogram(site.facts()).collect()}
    assert {tuple(r) for r in amount_histogram(site.facts(), fraction=1.0).collect()} == whole
