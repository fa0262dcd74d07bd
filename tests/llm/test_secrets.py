import base64
import gzip
from urllib.parse import quote

from cardwarden.llm.secrets import all_spans, scan_secrets

SECRET = "password = hunter2hunter2"


def test_plain_finds():
    key = "AKIA" + "Z" * 16
    text = f'é {SECRET} x {key} {"0a" * 12} token:abc'
    base, every = all_spans(text)
    assert base == [("assign", 2, 2 + len(SECRET)), ("access", 30, 50), ("hex", 51, 75)]
    assert every == base


def test_nested_layers_map_to_the_text():
    packed = base64.b64encode(gzip.compress(SECRET.encode(), mtime=0)).decode()
    for hidden in (quote(SECRET, safe=""), base64.b64encode(SECRET.encode()).decode(), packed, quote(base64.b64encode(quote(packed, safe="").encode()).decode(), safe=""), "".join(f"\\u{ord(c):04x}" for c in SECRET)):
        base, every = all_spans(f"before {hidden} after")
        assert base == [] and len(every) == 1
        kind, start, end = every[0]
        assert kind == "assign" and start == 7 and 7 + len(hidden) - 3 <= end <= 7 + len(hidden)


def test_rows(spark):
    rows = scan_secrets(spark.createDataFrame([(1, None, 3), (2, "", 3), (2, SECRET, 3)], "doc_id long, text string, spans int")).collect()
    assert [r["n_assign"] for r in sorted(rows, key=lambda r: r["spans"])] == [0, 0, 1]
    assert scan_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []
