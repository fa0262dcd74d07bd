import json

from cardwarden.sources import files


def test_ids_and_answers_with_commas(spark, tmp_path):
    answers = {str(i): ("Yes" if i % 7 == 0 else "No") for i in range(500)}
    answers |= {f"{i},x, ,{i}": ("Yes" if i % 3 == 0 else "No") for i in range(500)}
    answers |= {",": "Yes", ",,a": "Yes", "b,": "Yes", " , ": "Yes", "c,d": "maybe, no", "e": "Yes"}
    want = {k: v == "Yes" for k, v in answers.items()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for i, (size, indent) in enumerate([("128m", None), ("1024", None), ("1024", 1)]):
            path = tmp_path / f"{i}.json"
            path.write_text(json.dumps({"target": answers}, indent=indent))
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert {r.transaction_id: r.is_fraud for r in files.load_labels(spark, str(path)).collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
