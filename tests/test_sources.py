import json

import pytest

from cardwarden.plans.refresh import read_inputs
from cardwarden.sources import files
from cardwarden.sources.validate import MissingColumnError, require_columns

HEADER = ["id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id", "merchant_city",
          "merchant_state", "mcc", "errors"]
ROWS = [
    ["1", "2010-01-01 00:01:00", "5", "9", "$1,234.50", "Swipe Transaction", "7", "New, Town", "TX", "5411", ""],
    ["2", "oops", "x", "9", "bad", "Online Transaction", "7", "A;B|C", "", "5411", "Bad PIN"],
]


def write_delimited(path, sep):
    lines = [sep.join(HEADER)] + [sep.join(f'"{c}"' if c else "" for c in row) for row in ROWS]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"], ids=["comma", "semicolon", "tab", "pipe"])
def test_every_delimiter_is_found(spark, tmp_path, sep):
    path = write_delimited(tmp_path / "t.csv", sep)
    assert files.detect_delimiter(spark, path) == sep
    rows = files.scan_transactions(spark, path).orderBy("transaction_id").collect()
    assert [list(r) for r in rows] == [[c or None for c in row] for row in ROWS]


def test_delimiter_falls_back_to_comma():
    assert files.choose_delimiter([]) == ","
    assert files.choose_delimiter(["single", "column"]) == ","
    assert files.choose_delimiter(["a;b,c;d", "1;2;3"]) == ";"


def test_absent_optional_columns_become_null(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("id,current_age,gender,yearly_income,total_debt,credit_score\n1,30,F,$5,$6,x\n")
    row = files.load_users(spark, str(path)).first()
    assert row.user_id == "1" and row.latitude is None and row.credit_score is None


def test_missing_column_is_named(spark):
    with pytest.raises(MissingColumnError, match="cards has no column 'card_type'.*card_brand"):
        require_columns(spark.createDataFrame([("1", "Visa")], "id string, card_brand string"), "cards")


def labels_of(spark, path):
    return {r.transaction_id: r.is_fraud for r in files.load_labels(spark, str(path)).collect()}


@pytest.mark.parametrize("nested", [True, False], ids=["nested", "flat"])
def test_labels(spark, tmp_path, nested):
    answers = {str(i): ("Yes" if i % 7 == 0 else "No") for i in range(3000)} | {"odd": "maybe"}
    (tmp_path / "l.json").write_text(json.dumps({"target": answers} if nested else answers, indent=1))
    want = {k: v == "Yes" for k, v in answers.items()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:  # small splits: the object is cut in many places
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
        assert labels_of(spark, tmp_path / "l.json") == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_repeated_label_keeps_the_last_answer(spark, tmp_path):
    pairs = ['"a": "Yes"', '"b": "No"', '"a": "No"', '"b": "Yes"'] + [f'"{i}": "No"' for i in range(50)]
    (tmp_path / "l.json").write_text("{" + ", ".join(pairs) + "}")
    got = labels_of(spark, tmp_path / "l.json")
    assert (got["a"], got["b"], len(got)) == (False, True, 52)


def test_mcc(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"0742": "Veterinary, Services", "5812": "Eating \\"Places\\""}')
    got = {r.mcc: r.mcc_description for r in files.load_mcc(spark, str(tmp_path / "m.json")).collect()}
    assert got == {"742": "Veterinary, Services", "5812": 'Eating "Places"'}


def test_read_inputs_checks_columns(spark, tmp_path):
    path = write_delimited(tmp_path / "t.csv", ",")
    with pytest.raises(MissingColumnError):
        read_inputs(spark, path, path, path, path, path)
