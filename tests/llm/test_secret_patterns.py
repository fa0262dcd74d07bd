"""The patterns of the secret scan against plain searches, on made-up texts that are dense in what they look for."""

import hashlib
import random
import re
import time

import pytest

from cardwarden.llm import secrets
from cardwarden.llm.common import table

CLASS = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")


def base_by_hand(text):
    """Plain finds by walking through the text, without a pattern."""
    found = []

    def run(at, allowed):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    at = 0
    while at < len(text):
        word = next((w for w in WORDS if text[at : at + len(w)].lower() == w and text[at : at + len(w)].isascii()), None)
        end = None
        if word:
            i = at + len(word)
            i += text[i : i + 1] in ("'", '"') and text[i : i + 1] != ""
            i = run(i, " ")
            if text[i : i + 1] in (":", "=") and text[i : i + 1]:
                i = run(i + 1, " ")
                i += text[i : i + 1] in ("'", '"') and text[i : i + 1] != ""
                stop = run(i, CLASS)
                if stop > i:
                    end = stop
                    if stop - i >= 6:
                        found.append(("assign", at, stop))
        at = end or at + 1
    at = 0
    while (at := text.find("AKIA", at)) >= 0:
        stop = run(at + 4, set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
        if stop == at + 4:
            at += 1
            continue
        if stop - at >= 20:
            found.append(("access", at, stop))
        at = stop
    at = 0
    while at < len(text):
        stop = run(at, set("0123456789abcdef"))
        if stop - at >= 24:
            found.append(("hex", at, stop))
        at = max(stop, at + 1)
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0]), s[2]))


PIECES = ["password", "PassWD", "secret", "token", "apikey", "API_KEY", "AKIA", "AKIA" + "Q7" * 9, "0123456789abcdef" * 2, "ab12cd",
          "=", ":", " ", "  ", '"', "'", "\n", "é", "Z" * 5, "hunter2", "%41", "\\u0041", "&#65;", "%", "\\n", "x=y"]


def test_base_finds_equal_those_found_by_hand():
    r = random.Random(4)
    for _ in range(4000):
        text = "".join(r.choice(PIECES) for _ in range(r.randrange(25)))
        assert secrets.all_spans(text)[0] == base_by_hand(text), text


def test_query_on_a_table_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    rows = secrets.op10_decoding_secret_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_by_hand(texts[r.doc_id])
        joined = [f"{k}:{a}:{b}" for k, a, b in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, _, _ in base) for kind in secrets.KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r.spans.split(",")) | {""}


def test_runs_are_those_of_the_patterns_that_try_every_place():
    plain = {
        secrets.URL: r"[!-~]*%[0-9A-Fa-f]{2}[!-~]*",
        secrets.ESCAPED: rf"[!-~]*{secrets.ESCAPES.pattern}[!-~]*",
        secrets.WRAPPED: r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}",
    }
    r = random.Random(5)
    pieces = [*PIECES, "\r\n", "\t", "=", "==", "A" * 16, "b64-_/+0" * 3, "\n ", "%zz", "&#x41;", "\\x41", "\\U0000"]
    for _ in range(6000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(30)))
        for ours, other in plain.items():
            assert [m.span() for m in ours.finditer(text)] == [m.span() for m in re.finditer(other, text)], text


@pytest.mark.parametrize("end", ["\\n", "%", "&#", " x\ny", "%41"])
def test_long_runs_without_white_space_take_linear_time(end):
    for unit in ("ab,c.;", "A"):
        text = unit * (1_000_000 // len(unit)) + end
        began = time.process_time()
        secrets.all_spans(text)
        assert time.process_time() - began < 10  # far below quadratic time
