"""Every registered query against its DuckDB SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from cardwarden.catalog import all_queries
from checks.compare import difference, duck

SQL = oracle_sql()
WITHOUT_SQL = {"amount_histogram_sampled", "ml_ensemble"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql_or_a_reason():
    own = {n for n in queries() if n in all_queries()}
    assert own - set(SQL) == WITHOUT_SQL and set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, con, name):
    assert difference(spark, con, sf_dir, queries()[name], SQL[name]) == ""


def test_sample_covers_all_flagged_rows(spark, sf_dir):
    found = queries()
    flagged = {
        n: {r.bin: r.n for r in found[n](spark, sf_dir).where("tipo = 'Fraude'").collect()}
        for n in ("amount_histogram", "amount_histogram_sampled")
    }
    assert flagged["amount_histogram"] == flagged["amount_histogram_sampled"]


def test_ensemble_finds_at_least_what_the_rules_find(spark, sf_dir):
    rows = {r.method: r for r in queries()["ml_ensemble"](spark, sf_dir).collect()}
    rules, either = rows["rules"], rows["rules_or_model"]
    assert either.tp >= rules.tp and either.fp >= rules.fp
    assert len({r.tp + r.fp + r.fn + r.tn for r in rows.values()}) == 1


def test_ensemble_rules_agree_with_the_split(spark, sf_dir):
    found = queries()
    rules = found["ml_ensemble"](spark, sf_dir).where("method = 'rules'").first()
    split = {r.part: r for r in found["ensemble_split"](spark, sf_dir).collect()}
    assert set(split) == {"train", "choose", "test"}
    assert (rules.tp, rules.fp, rules.fn, rules.tn) == tuple(split["test"][c] for c in ("tp", "fp", "fn", "tn"))


def test_the_threshold_is_the_best_of_the_grid(spark):
    from cardwarden.plans.ensemble import choose_threshold

    rows = [(7, i % 4 == 0, (0.62 if i % 4 == 0 else 0.3) + (i % 7) / 100) for i in range(80)] + [(9, True, 0.01)] * 50
    assert choose_threshold(spark.createDataFrame(rows, "bucket int, is_fraud boolean, fraud_probability double")) == 0.4


def test_entry(spark):
    row = entry(spark).first()
    assert (row.total_transactions, row.total_fraud, row.true_positives) == (953, 21, 16)
