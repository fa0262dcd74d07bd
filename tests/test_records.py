"""Quoted line breaks and nested labels, read in many small splits, against the standard library."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from cardwarden.sources import files, records


@pytest.fixture(params=["128m", "300"])
def splits(spark, request):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def cell(rng):
    return rng.choice([
        "plain", "", 'say "hi"', "a,b;c", "one\ntwo", '"\n"', 'x\n\n"y",\n', "\n", '""', '"', "end\n", "straße ü", 'tall "5\nfeet"', "w" * 90,
    ])


@pytest.mark.parametrize("sep", [",", "|"], ids=["comma", "pipe"])
def test_quoted_line_breaks(spark, tmp_path, splits, sep):
    rng = random.Random(len(sep) + len(splits))
    rows = [[str(i), cell(rng), cell(rng), "last"] for i in range(75)]
    for part, chunk in enumerate([rows[:50], rows[50:70], [[r[0], "no", "breaks", "here"] for r in rows[70:]]]):
        text = io.StringIO()
        writer = csv.writer(text, delimiter=sep, lineterminator="\n", quoting=csv.QUOTE_ALL if part == 1 else csv.QUOTE_MINIMAL)
        writer.writerows([["id", "a", "b", "c"], *chunk])
        (tmp_path / f"part-{part}.csv").write_text(text.getvalue())
    want = rows[:70] + [[r[0], "no", "breaks", "here"] for r in rows[70:]]
    got = [[c or "" for c in r] for r in files.read_delimited(spark, str(tmp_path), sep).collect()]
    assert sorted(got) == sorted(want)


def test_a_quote_inside_an_unquoted_cell_opens_nothing(spark, tmp_path, splits):
    lines = ["id,a,b"] + [f'{i},5" pipe,x' for i in range(40)] + ['40,"two', 'lines",x'] + [f'{i},y,7" pipe' for i in range(41, 60)]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    got = {r.id: (r.a, r.b) for r in files.read_delimited(spark, str(tmp_path / "t.csv"), ",").collect()}
    assert len(got) == 60 and got["3"] == ('5" pipe', "x") and got["40"] == ("two\nlines", "x") and got["50"] == ("y", '7" pipe')


def test_an_unclosed_quote_is_an_error_not_a_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "LONGEST", 2000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    (tmp_path / "t.csv").write_text("id,a\n" + '1,"never closed\n' + "2,x\n" * 1500)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        with pytest.raises(Exception, match="unclosed quote in"):
            files.read_delimited(spark, str(tmp_path / "t.csv"), ",").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def labels_of(spark, path):
    found = files.load_labels(spark, str(path)).collect()
    assert len({r.transaction_id for r in found}) == len(found)
    return {r.transaction_id: r.is_fraud for r in found}


def answers(rng, n):
    keys = [rng.choice(["", ",", "a,b", '"', "{", "}}", "\\", "ü", "target", ":", "}{", "[,]"]) + str(i) for i in range(n)]
    return {k: rng.choice(["Yes", "No", "maybe, no", True, None, 3, "{", {"Yes": "Yes", "x": {"y": "Yes"}}, ["Yes", {"7": "Yes"}]]) for k in keys}


@pytest.mark.parametrize("indent,shape", [(None, "target"), (1, "between"), (1, "flat"), (None, "after")])
def test_only_the_target_counts(spark, tmp_path, splits, indent, shape):
    rng = random.Random(7)
    mine, other = answers(rng, 50), {f"o{k}": v for k, v in answers(rng, 20).items()}
    whole = {
        "target": {"target": mine}, "between": {"meta": other, "9": "Yes", "target": mine, "more": {"target": {"z": "Yes"}, "8": "Yes"}},
        "flat": mine, "after": {"target": mine, "note": "target", "list": [1, {"5": "Yes"}, [2, 3]]},
    }[shape]
    (tmp_path / "l.json").write_text(json.dumps(whole, indent=indent, ensure_ascii=bool(indent)))
    assert labels_of(spark, tmp_path / "l.json") == {k: v == "Yes" for k, v in mine.items()}


def test_unquoted_answers_are_dealt_by_split(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    (tmp_path / "l.json").write_text(json.dumps({"target": {str(i): i % 2 == 0 for i in range(1500)}}))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        found = files.load_labels(spark, str(tmp_path / "l.json"))
        assert found.count() == 1500 and found.where("is_fraud").count() == 0
        pieces = records.land_pieces(spark, spark.read.option("lineSep", ",").text(str(tmp_path / "l.json")).select("value"), "test")
        assert pieces.groupBy(*records.SPLIT).count().agg(F.max("count")).first()[0] < 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_several_objects_in_a_file(spark, tmp_path, splits):
    lines = [json.dumps({"target": {f"{i}-{k}": "Yes" if k % 2 else "No" for k in range(9)}, "m": {"q": "Yes"}}) for i in range(5)]
    (tmp_path / "l.json").write_text("\n".join(lines))
    assert labels_of(spark, tmp_path / "l.json") == {f"{i}-{k}": k % 2 == 1 for i in range(5) for k in range(9)}
