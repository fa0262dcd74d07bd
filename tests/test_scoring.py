import pytest
from pyspark.sql import functions as F

from cardwarden.config import DEFAULT_RULES
from cardwarden.operators import metrics, quality
from cardwarden.operators.clean import clean_transactions, rejected_rows
from cardwarden.operators.profiles import build_profiles
from cardwarden.operators.scoring import score_transactions
from cardwarden.plans.refresh import merge_inputs, merge_typed
from tests.samples import inputs


@pytest.fixture(scope="module")
def merged(spark):
    return merge_inputs(inputs(spark)).cache()


@pytest.fixture(scope="module")
def facts(merged):
    clean = clean_transactions(merged)
    return score_transactions(clean, build_profiles(clean)).cache()


@pytest.fixture(scope="module")
def rows(facts):
    return {r.transaction_id: r for r in facts.collect()}


def test_rejects(merged):
    got = {r.reason: r.rejected for r in rejected_rows(merged).collect()}
    assert got == {"amount_unreadable": 2, "amount_negative": 1, "date_unreadable": 2}


def test_kept_rows(rows):
    assert len(rows) == 20 and rows["abroad"].amount == 0.0


def test_typed_merge_gives_the_same_facts(spark, facts):
    given = inputs(spark)
    clean = clean_transactions(merge_typed(given, given.labels))
    again = score_transactions(clean, build_profiles(clean))
    assert sorted(map(str, again.select(*facts.columns).collect())) == sorted(map(str, facts.collect()))


def test_labels_default_to_legitimate(rows):
    assert [rows[i].is_fraud for i in ("above100", "plain", "online")] == [True, False, False]


def test_categories(rows):
    assert rows["nochip"].mcc_description == "Unknown"
    assert rows["blank_error"].mcc_description == rows["error"].mcc_description == "Veterinary"


def test_channel(rows):
    assert (rows["online"].is_online, rows["online"].transaction_type) == (True, "Online")
    assert (rows["nochip"].is_online, rows["nochip"].transaction_type) == (None, "Swipe")


def test_flags_are_not_trimmed(rows):
    assert rows["plain"].has_chip is True and rows["dark"].has_chip is False
    assert rows["orphan"].has_chip is None and rows["dark"].card_on_dark_web is True


def test_ratio_needs_income(rows):
    assert rows["plain"].debt_income_ratio is None and rows["dark"].debt_income_ratio == 2.0


def test_distance(rows):
    assert rows["plain"].distance_km < 2 and rows["far"].distance_km > 500
    assert all(rows[i].distance_km is None for i in ("abroad", "lower", "online", "orphan"))


def test_amount_bands_are_strict(rows):
    scores = [rows[f"{s}{n}"].fraud_score for n in (100, 200, 500) for s in ("at", "above")]
    assert scores == [0, 1, 1, 3, 3, 4]


def test_error_signal(rows):
    assert [rows[i].fraud_score for i in ("blank_error", "nan_error", "error")] == [0, 0, 1]


def test_threshold_is_inclusive(rows):
    assert (rows["three"].fraud_score, rows["three"].is_suspicious) == (3, False)
    assert (rows["four"].fraud_score, rows["four"].is_suspicious) == (4, True)


def test_reasons(rows):
    assert rows["four"].suspicion_reasons == "online;error_en_transaccion"
    assert rows["above100"].suspicion_reasons == ""
    assert rows["all"].fraud_score == 3 + 4 + 1 + 5 + 3 + 2
    assert rows["all"].suspicion_reasons == (
        "online;monto_alto;error_en_transaccion;tarjeta_en_dark_web;distancia_inusual"
    )


def test_user_p99_signal(spark):
    given = inputs(spark)
    many = spark.range(150).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit("2010-01-01").alias("date"),
        F.lit("u1").alias("client_id"), F.lit("c1").alias("card_id"),
        F.concat(F.lit("$"), F.col("id").cast("string")).alias("amount"),
        F.lit("Swipe Transaction").alias("use_chip"), F.lit("m").alias("merchant_id"),
        F.lit("X").alias("merchant_city"), F.lit("TX").alias("merchant_state"),
        F.lit("5411").alias("mcc"), F.lit(None).cast("string").alias("errors"),
    )
    typed = merge_typed(type(given)(many, given.users, given.cards, given.mcc, given.labels), given.labels)
    clean = clean_transactions(typed)
    fired = score_transactions(clean, build_profiles(clean)).where("fraud_score >= 3")
    # 99 % of 150 rows are 149 rows, up to amount 148: only 149 lies above.
    assert [r.transaction_id for r in fired.collect()] == ["t149"]


def test_properties(facts):
    top = DEFAULT_RULES.max_score
    assert top == 20
    broken = facts.where(
        f"fraud_score < 0 or fraud_score > {top} or is_suspicious <> (fraud_score >= 4) "
        "or (suspicion_reasons = '') = is_suspicious"
    )
    assert broken.count() == 0


def test_segments_add_up(facts):
    whole = metrics.metrics_global(facts).first()
    assert whole.true_positives + whole.false_positives + whole.true_negatives + whole.false_negatives == 20
    for segment in (metrics.fraud_by_mcc, metrics.fraud_by_card_type, metrics.fraud_by_merchant):
        sums = segment(facts).agg(F.sum("total_transactions"), F.sum("total_fraud")).first()
        assert tuple(sums) == (whole.total_transactions, whole.total_fraud)


def test_null_and_blank_city_stay_apart(facts):
    cities = metrics.fraud_by_merchant(facts).where("merchant_id = 'm3' and mcc_description = 'Veterinary'")
    assert sorted((r.merchant_city, r.total_transactions) for r in cities.collect()) == [("", 1), ("", 2)]


def test_by_state_leaves_out_unknown_channel(facts):
    states = {r.state: r.total_transactions for r in metrics.fraud_by_state(facts).collect()}
    total = facts.where("merchant_state = 'TX'").count()
    assert states["TX"] == total - 1 and set(states) == {"TX", "Italy", "tx", "AK"}


def test_empty_ratios_are_zero(facts):
    row = metrics.metrics_global(facts.where("false")).first()
    assert (row.total_transactions, row.fraud_rate, row.avg_fraud_amount, row.false_negative_rate) == (0, 0, 0, 0)


def test_quality(facts):
    quality.assert_no_negative_amounts(facts)
    with pytest.raises(quality.QualityError, match="20 negative"):
        quality.assert_no_negative_amounts(facts.withColumn("amount", F.lit(-1.0)))
    assert quality.duplicate_ids(facts).count() == 0
    assert quality.duplicate_ids(facts.unionByName(facts)).count() == 20


def test_rows_are_dealt_to_ranges_before_they_are_scored(spark):
    """What stands below a deal by ranges is computed twice."""
    clean = clean_transactions(merge_inputs(inputs(spark)))
    dealt = score_transactions(clean, build_profiles(clean), ranges=("user_id", "transaction_date"))
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    above, below = plan.split("RepartitionByExpression", 1)
    assert "fraud_score" in above and "distance_km" in above
    assert "fraud_score" not in below and "distance_km" not in below
    assert sorted(map(str, dealt.collect())) == sorted(map(str, score_transactions(clean, build_profiles(clean)).collect()))
