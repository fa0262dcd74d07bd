import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardwarden import schemas
from cardwarden.plans import refresh
from cardwarden.plans.explorer import Filters
from cardwarden.plans.incremental import key_index, key_span, load_newer, months, upsert_months, write_by_month
from cardwarden.plans.warehouse import (
    ADDITIONS, FACT_ADDITIONS, SEGMENT_ADDITIONS, Warehouse, add_columns, conform, conform_card_types,
    conform_profiles, insert_if_absent, upsert,
)
from tests.samples import inputs


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    first = refresh.run(spark, inputs(spark), warehouse)
    second = refresh.run(spark, inputs(spark), warehouse)
    return warehouse, first, second


def content(df):
    return sorted(map(str, df.drop("processed_at", "computed_at").collect()))


def test_two_refreshes_give_equal_tables(loaded):
    warehouse, first, second = loaded
    assert warehouse.runs() == [first, second]
    for name in schemas.WAREHOUSE:
        assert content(warehouse.table(name, first)) == content(warehouse.table(name, second))
        assert content(warehouse.table(name)) == content(warehouse.table(name, second))


def test_declared_types(loaded):
    warehouse, *_ = loaded
    for name, schema in schemas.WAREHOUSE.items():
        stored = {f.name: f.dataType for f in warehouse.table(name).schema.fields}
        assert {f.name: f.dataType for f in schema.fields}.items() <= stored.items()


def test_every_table_of_an_old_layout_is_read_in_todays(spark, loaded, tmp_path):
    warehouse, *_ = loaded
    old = Warehouse(spark, str(tmp_path))
    run = old.new_run()
    for name, added in ADDITIONS.items():
        narrow = warehouse.table(name).drop(*added)
        if "total_fraud" in narrow.columns:
            narrow = narrow.withColumn("total_fraud", F.col("total_fraud").cast("int"))
        narrow.write.parquet(old.location(name, run))
    old.record_schemas(run)
    old.publish(run)
    assert set(ADDITIONS) == set(schemas.WAREHOUSE)
    recorded = {(r.table_name, r.column_name) for r in old.schema_record().collect()}
    for name, added in ADDITIONS.items():
        assert not any((name, c) in recorded for c in added)
        read, now = old.table(name), warehouse.table(name)
        assert sorted(read.dtypes) == sorted(now.dtypes)
        assert content(read.select(*[c for c in now.columns if c not in added])) == content(now.drop(*added))
        values = {"total_suspicious": 0, "amount_suspicious": 0}
        assert all(r[c] == values.get(c) for r in read.collect() for c in added)
    stamps = warehouse.table("fraud_by_state").where("computed_at is null").count()
    assert stamps == 0 and warehouse.schema_record().where("column_name = 'computed_at'").count() == 6


def test_staging_goes_when_a_newer_refresh_stands_or_it_failed(spark, loaded, tmp_path):
    warehouse, first, second = loaded
    kept = lambda run: warehouse._fs().exists(warehouse._path(f"{warehouse.root}/staging/{run}"))
    assert not kept(first) and kept(second)


def test_unpublished_refresh_is_not_seen(loaded):
    warehouse, _, second = loaded
    unfinished = warehouse.new_run()
    warehouse.write(unfinished, "fraud_by_mcc", warehouse.table("fraud_by_mcc").limit(0))
    assert warehouse.runs()[-1] == second and warehouse.table("fraud_by_mcc").count() > 0


def test_run_log(loaded):
    warehouse, *_ = loaded
    rows = warehouse.run_log().collect()
    assert [(r.status, r.rows_processed, r.rows_fraud) for r in rows] == [("success", 20, 2)] * 2
    warehouse.log_run("error", notes="input missing")
    assert warehouse.run_log().where("status = 'error' and rows_processed is null").count() == 1


def test_old_refreshes_expire(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    runs = []
    for _ in range(3):
        runs.append(warehouse.new_run())
        warehouse.write(runs[-1], "t", spark.range(1))
        warehouse.publish(runs[-1])
    warehouse.expire_runs(keep=2)
    assert warehouse.runs() == runs[1:]


def test_failed_refresh_is_logged_and_not_published(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    given = inputs(spark)
    broken = type(given)(given.transactions.drop("amount"), given.users, given.cards, given.mcc, given.labels)
    with pytest.raises(Exception, match="amount"):
        refresh.run(spark, broken, warehouse)
    assert warehouse.runs() == [] and warehouse.run_log().first().status == "error"
    left = [str(f.getPath()) for part in ("staging", "runs") if warehouse._fs().exists(warehouse._path(f"{tmp_path}/{part}")) for f in warehouse._fs().listStatus(warehouse._path(f"{tmp_path}/{part}"))]
    assert left == []


def test_no_refresh_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Warehouse(spark, str(tmp_path)).table("fraud_by_mcc")


def test_conform(spark):
    kinds = "transaction_id string, amount double, distance_km double"
    row = conform(spark.createDataFrame([("t", None, 12.345)], kinds), schemas.FACT).first()
    assert len(row) == 30 and row.amount is None and row.user_state is None
    assert str(row.distance_km) in ("12.35", "12.34")


@pytest.mark.parametrize("value", [1e12, float("nan"), float("inf")])
def test_a_value_that_does_not_fit_is_an_error(spark, value):
    df = spark.createDataFrame([("t", value)], "transaction_id string, debt_income_ratio double")
    with pytest.raises(Exception, match=r"debt_income_ratio does not fit decimal\(8,4\)"):
        conform(df, schemas.FACT).collect()


def test_unknown_chip_is_stored_as_false(spark):
    df = spark.createDataFrame([("Visa", "Debit", None), ("Visa", "Debit", False)], "card_brand string, card_type string, has_chip boolean")
    assert [r.has_chip for r in conform_card_types(df).collect()] == [False, False]


def test_profile_nulls(spark):
    df = spark.createDataFrame([("u", float("nan"), None)], "user_id string, yearly_income double, num_cards bigint")
    row = conform_profiles(df).first()
    assert row.yearly_income is None and row.num_cards == 0


def test_insert_if_absent(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    rows = spark.createDataFrame([("a", 9), ("b", 2), ("b", 2)], "k string, v int")
    once = insert_if_absent(target, rows, "k")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, insert_if_absent(once, rows, "k").collect())) == [("a", 1), ("b", 2)]


def test_upsert_keeps_the_newest(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, t int, v string")
    updates = spark.createDataFrame([("a", 3, "new"), ("a", 2, "old"), ("c", 1, "y")], "k string, t int, v string")
    got = sorted(map(tuple, upsert(target, updates, "k", "t").collect()))
    assert got == [("a", 3, "new"), ("b", 1, "x"), ("c", 1, "y")]


def test_add_columns_twice(spark):
    old = spark.createDataFrame([("5411",)], "mcc string")
    new = add_columns(add_columns(old, SEGMENT_ADDITIONS), SEGMENT_ADDITIONS)
    assert tuple(new.first()) == ("5411", 0, 0)
    assert add_columns(old, FACT_ADDITIONS).first().fraud_score is None


def dated(spark, rows):
    return spark.createDataFrame(
        [(k, dt.datetime(*d), v) for k, d, v in rows], "transaction_id string, transaction_date timestamp_ntz, v int"
    )


def test_load_newer(spark):
    target = dated(spark, [("a", (2024, 1, 1), 0), ("b", (2024, 1, 10), 0)])
    source = dated(spark, [("a", (2024, 1, 1), 1), ("b", (2024, 1, 10), 1), ("c", (2024, 1, 11), 1)])
    key, time = "transaction_id", "transaction_date"
    assert {r[0]: r[2] for r in load_newer(target, source, key, time).collect()} == {"a": 0, "b": 0, "c": 1}
    assert {r[0]: r[2] for r in load_newer(target, source, key, time, "3 days").collect()} == {"a": 0, "b": 1, "c": 1}
    assert load_newer(target.limit(0), source, key, time).count() == 3


def test_upsert_months_leaves_other_months_alone(spark, tmp_path):
    path = str(tmp_path / "facts")
    write_by_month(dated(spark, [("a", (2024, 1, 1), 0), ("b", (2024, 2, 1), 0), ("c", (2024, 2, 2), 0)]), path)
    untouched = {p.name for p in (tmp_path / "facts/year=2024/month=1").iterdir()}
    updates = dated(spark, [("b", (2024, 2, 1), 5), ("d", (2024, 3, 1), 5)])
    upsert_months(spark, path, updates, "transaction_id", "transaction_date", str(tmp_path / "staging"))
    assert {r.transaction_id: r.v for r in spark.read.parquet(path).collect()} == {"a": 0, "b": 5, "c": 0, "d": 5}
    assert {p.name for p in (tmp_path / "facts/year=2024/month=1").iterdir()} == untouched
    assert months(spark, path, (2024, 2), (2024, 3)).count() == 3


def test_a_row_that_changes_its_month_exists_once(spark, tmp_path):
    path = str(tmp_path / "facts")
    write_by_month(dated(spark, [("7", (2024, 1, 1), 0), ("8", (2024, 2, 1), 0), ("b", (2024, 2, 2), 0), ("x", (2024, 4, 1), 0)]), path)
    untouched = {p.name for p in (tmp_path / "facts/year=2024/month=4").iterdir()}
    for turn, rows in enumerate([
        [("7", (2024, 3, 1), 5), ("b", (2024, 3, 2), 5), ("b", (2024, 2, 1), 4)],  # 7 was all of January
        [("7", (2024, 2, 9), 6), ("new", (2025, 1, 1), 6)],
        [("7", (2024, 2, 9), 6), ("new", (2025, 1, 1), 6)],  # the same load again
    ]):
        upsert_months(spark, path, dated(spark, rows), "transaction_id", "transaction_date", str(tmp_path / f"staging{turn}"))
    rows = spark.read.parquet(path).collect()
    assert {(r.transaction_id, r.year, r.month, r.v) for r in rows} == {
        ("7", 2024, 2, 6), ("8", 2024, 2, 0), ("b", 2024, 3, 5), ("new", 2025, 1, 6), ("x", 2024, 4, 0)
    }
    assert len(rows) == 5
    assert not (tmp_path / "facts/year=2024/month=1").exists()
    assert {p.name for p in (tmp_path / "facts/year=2024/month=4").iterdir()} == untouched
    assert (tmp_path / "facts_keys/_COMPLETE").exists()
    index = key_index(spark, path).collect()
    assert sorted((r.key, r.year, r.month) for r in index) == sorted((r.transaction_id, r.year, r.month) for r in rows)


def test_key_spans(spark):
    keys = ["0", "9", "10", "25", "007", "-3", "a", "9" * 30, None]
    found = {r.k: r.s for r in spark.createDataFrame([(k,) for k in keys], "k string").select("k", key_span("k", 10).alias("s")).collect()}
    assert [found[k] for k in ("0", "9", "10", "25")] == [0, 0, 1, 2]
    assert all(found[k] < 0 for k in ("007", "-3", "a", "9" * 30, None))


def test_filters(loaded):
    facts = loaded[0].table("transactions_processed")

    def ids(**conditions):
        return {r.transaction_id for r in Filters(**conditions).apply(facts).collect()}

    assert len(ids()) == 20
    assert ids(user="u2", transaction_type="Online", suspicious_only=True) == {"four", "all"}
    assert ids(first_day=dt.date(2012, 12, 30), last_day=dt.date(2012, 12, 30)) == {"dark"}
    assert ids(fraud_only=True) == {"above100", "dark"}
    assert ids(card="c9", state="TX") == {"orphan"} and ids(brand="Amex", category="Grocery Stores") == {"dark", "all"}
