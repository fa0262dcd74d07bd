import random
from collections import Counter

from cardwarden.llm.exact_dedup import PatriciaTrie, exact_dedup


def test_spilled_below_spilled_is_kept():
    random.seed(3)
    for limit in (0, 2_000, 8_000):
        texts = [bytes(random.choices(b"ab", k=random.choice([5, 40, 300, 700, 2_000]))) for _ in range(300)]
        texts += random.choices(texts, k=100) + [b"x" * 66_000, b"y" * 70_000, b"z" * 20]
        trie, want = PatriciaTrie(lambda a, b: a + b, limit), Counter()
        for text in texts:  # the first text of 64 KiB splits the prefix above the spilled lengths
            key = len(text).to_bytes(8, "big") + text
            trie.insert(key, 1)
            want[key] += 1
        found = list(trie.drain())
        assert len(found) == len(want) and dict(found) == want


def test_split_label_of_a_spilled_node():
    trie, want = PatriciaTrie(lambda a, b: a + b, 3_000), Counter()
    for key in [b"p" + b"m" * 40 + bytes([a, b]) for a in b"stuv" for b in range(20)] + [b"p" + b"m" * n + b"-" for n in range(40, 0, -1)] + [b"q%d" % n for n in range(50)]:
        trie.insert(key, 1)
        want[key] += 1
    found = list(trie.drain())
    assert len(found) == len(want) and dict(found) == want


def test_tiny_limit_against_brute_force(spark):
    random.seed(5)
    texts = ["".join(random.choices("ab", k=random.choice([3, 300, 900]))) for _ in range(300)] + ["l" * 66_000, "l" * 66_000]
    rows = list(enumerate(texts))
    found = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), limit_mb=0).collect()
    last, size = {t: i for i, t in rows}, Counter(texts)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found) == [(i, last[t], size[t], i == last[t]) for i, t in rows]
