import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np

from cardwarden.llm import cross_entropy as module
from cardwarden.llm.cross_entropy import cross_entropy_difference, pack, unpack
from cardwarden.session import staging_root


def brute(rows, ids):
    pairs, words, before = [(Counter(), Counter()) for _ in range(3)]
    texts = []
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        met, side = list(zip([None, *w], w)), int(key in ids)
        pairs[side].update(met)
        words[side].update(w)
        before[side].update(p for p, _ in met)
        texts.append((key, met))
    n, out = len(words[0] | words[1]), []

    def loss(p, w, side):
        after = pairs[side][p, w] / before[side][p] if before[side][p] else 0
        return -math.log(0.7 * after + 0.3 * (words[side][w] + 1) / (words[side].total() + n))

    for key, met in texts:
        mean = [sum(loss(p, w, side) for p, w in met) / len(met) if met else 0 for side in (1, 0)]
        out.append((-1 if key is None else key, len(met), *[round(m, 9) for m in mean]))
    return sorted(out)


def test_equals_brute_force_over_several_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(module, "BUCKET_TOKENS", 500)
    r = random.Random(5)
    rows = [(i // 2, " ".join(r.choice(["of", "the", f"w{r.randrange(60)}"]) for _ in range(r.randrange(60)))) for i in range(200)]
    rows += [(None, "Of the\u00e9 the\tOF"), (900, None), (901, ""), (902, "one"), (903, "of the " * 2000)]
    ids = set(range(0, 90, 3)) | {903}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = cross_entropy_difference(docs, spark.createDataFrame([(i,) for i in ids] * 2 + [(None,)], "doc_id long")).collect()
    got = sorted((-1 if f["doc_id"] is None else f["doc_id"], f["tokens"], round(f["target_loss"], 9), round(f["background_loss"], 9)) for f in found)
    want = brute(rows, ids)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in want], atol=1e-8)


def test_distinct_bigrams_are_not_written_as_rows(spark):
    """Staged texts, bigrams and losses took 12.6 bytes a token here; blocks and totals take 3.1."""
    r, tokens = random.Random(6), 200 * 500
    docs = spark.createDataFrame([(i, " ".join(f"w{r.randrange(3000)}" for _ in range(500))) for i in range(200)], "doc_id long, text string")
    cross_entropy_difference(docs, spark.createDataFrame([(1,)], "doc_id long"), name="lm-disk").collect()
    files = [p for p in Path(f"{staging_root(spark)}/llm").glob("lm-disk-*/*") if p.is_file()]
    assert files and sum(p.stat().st_size for p in files) < 6 * tokens


def test_packed_numbers_come_back():
    for kind in (np.uint32, np.int64, np.uint64):
        for values in ([], [7], list(range(1000))):
            assert unpack(pack(np.array(values, kind)), kind, len(values)).tolist() == values
