import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardwarden.functions.geo import haversine_km
from cardwarden.functions.numbers import fixed_bin, money_sum
from cardwarden.functions.parsing import mcc_key, parse_date, parse_flag, parse_money

DATES = {
    "2010-01-01 00:01:00": dt.datetime(2010, 1, 1, 0, 1),
    "2010-1-5": dt.datetime(2010, 1, 5),
    "3/4/2011 5:06": dt.datetime(2011, 3, 4, 5, 6),
    "03/04/2011": dt.datetime(2011, 3, 4),
    "25/12/2011 7:30": dt.datetime(2011, 12, 25, 7, 30),
    "25/12/2011": dt.datetime(2011, 12, 25),
    "29/2/2012": dt.datetime(2012, 2, 29),
    "29/2/2011": None,
    "13/13/2011": None,
    "2011-3-4 5:06": None,
    "3/4/2011 5:06:07": None,
    "2011/03/04": None,
    "2010-01-01T00:01:00": None,
    "not-a-date": None,
    "": None,
    None: None,
}
MONEY = {
    "$-77.00": -77.0, "$0.00": 0.0, "$1,234.50": 1234.5, " 12.5 ": 12.5, "$ 7": 7.0, "abc": None,
    "12d": None, "": None, None: None,
}
FLAGS = {"YES": True, "yes": True, "TRUE": True, "1": True, " yes": False, "No": False, "": False, None: None}


@pytest.mark.parametrize(
    "parse,cases", [(parse_date, DATES), (parse_money, MONEY), (parse_flag, FLAGS)],
    ids=["date", "money", "flag"],
)
def test_texts(spark, parse, cases):
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: r.v for r in df.select("t", parse(F.col("t")).alias("v")).collect()}
    assert got == cases


def test_flag_of_boolean(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "t boolean")
    assert [r.v for r in df.select(parse_flag(F.col("t")).alias("v")).collect()] == [True, False, None]


def test_mcc_key_drops_leading_zeros(spark):
    df = spark.createDataFrame([("0742",), ("742",), ("x1",), (None,)], "t string")
    assert [r.v for r in df.select(mcc_key(F.col("t")).alias("v")).collect()] == ["742", "742", "x1", None]


def test_haversine(spark):
    rows = [(0.0, 0.0, 0.0, 90.0), (0.0, 0.0, 0.0, 180.0), (1.0, 1.0, 1.0, 1.0), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    km = [r.v for r in df.select(haversine_km(*map(F.col, "abcd")).alias("v")).collect()]
    assert km[0] == pytest.approx(10007.543, abs=0.01)
    assert km[1] == pytest.approx(20015.087, abs=0.01)
    assert km[2] == 0 and km[3] is None


def test_bins_and_sums(spark):
    df = spark.createDataFrame([(0.0,), (39.99,), (40.0,), (2000.0,), (-1.0,)], "a double")
    assert [r.b for r in df.select(fixed_bin(F.col("a"), 0, 40, 50).alias("b")).collect()] == [0, 0, 1, 49, 0]
    assert df.agg(money_sum(F.col("a")).alias("s")).first().s == 2078.99
