import random
import re
import tracemalloc
from pathlib import Path

import pyarrow as pa

from cardwarden.llm import jaccard_join as module
from cardwarden.llm.jaccard_join import jaccard_join, least_matches
from cardwarden.session import staging_root


def brute(rows):
    sets = {}
    for key, text in rows:
        w = re.findall(r"\w+", (text or "").lower())
        sets[key] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    links = {k: set() for k in sets}
    for a in sets:
        for b in sets:
            if a != b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a].add(b)
    label = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            low = min([label[a], *[label[b] for b in links[a]]])
            changed |= low != label[a]
            label[a] = low
    return {k: (label[k], len(links[k])) for k in sets}


def corpus():
    r = random.Random(3)
    words = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    rows, key = [], 0
    for _ in range(25):
        base = [r.choice(words) for _ in range(120)]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 6])):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((key, " ".join(copy)))
            key += 1
    hot = [r.choice(words) for _ in range(200)]
    for _ in range(600):  # more than one block
        copy = list(hot)
        copy[r.randrange(200)] = r.choice(words)
        rows.append((key, " ".join(copy)))
        key += 1
    return [*rows, (key, None), (key + 1, ""), (key + 2, "one two"), (key + 3, "One, two!"), (key + 4, "?!")]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_ROWS", 256)
    rows = corpus()
    found = jaccard_join(spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, links string").repartition(7)).collect()
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in found} == brute(rows)
    assert {r["doc_id"] for r in found if r["kept"]} == {r["class_id"] for r in found}


def test_repeated_rows_null_keys_and_empty_table(spark):
    text = "a b c d e f g"
    found = jaccard_join(spark.createDataFrame([(1, text), (1, text), (None, text), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r["links"], r["kept"]) for r in found) == [(0, True), (2, False), (2, False), (2, True)]
    assert jaccard_join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pruning_keeps_what_may_reach_the_threshold():
    need = least_matches()
    assert need[20] <= 10 and need[120] <= 80 and need[120] > 60


def test_a_wide_batch_is_not_copied_whole():
    n, width = 4000, 8000
    columns = [[i // 2 for i in range(n)], [0] * n, [0] * n, [0] * n, list(range(n)), [1] * n, [[i // 2] for i in range(n)]]
    columns += [[bytes(4 * module.HASHES)] * n, [i.to_bytes(8, "little") * (width // 8) for i in range(n)]]
    names = ["bucket", "i", "j", "block", "mid", "weight", "bands", "signature", "shingles"]
    batch = pa.RecordBatch.from_pydict(dict(zip(names, columns)))
    del columns
    tracemalloc.start()
    list(module._tiles(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * width // 3


def unrelated(count, words):
    r = random.Random(5)
    return [(i, " ".join("%x" % r.getrandbits(40) for _ in range(words))) for i in range(count)]


def test_rows_without_candidates_leave_no_wide_values_on_disk(spark):
    rows = unrelated(300, 2000)
    rows.append((300, rows[7][1] + " more"))
    found = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), name="test-narrow").collect()
    assert {r["doc_id"]: r["links"] for r in found if r["links"]} == {7: 1, 300: 1}
    written = sum(p.stat().st_size for p in Path(staging_root(spark), "llm").glob("test-narrow-*/*.parquet"))
    assert written < 300 * 2000 * 8 // 4  # a quarter of all shingles


def test_texts_are_filtered_before_the_shuffle_however_large_the_candidates_are(spark, monkeypatch):
    plans, stage = {}, module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or stage(df, name))
    rows = unrelated(30, 50)
    rows.append((30, rows[7][1] + " more"))
    with module.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1"}):
        found = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), name="test-filter").collect()
    assert {r["doc_id"]: r["links"] for r in found if r["links"]} == {7: 1, 30: 1}
    assert "might_contain" in plans["test-filter-found"]


def test_copies_of_a_candidate_count_once_each(spark):
    text = unrelated(1, 100)[0][1]
    rows = [(i, text) for i in range(40)] + [(40 + i, f"{text} {i}") for i in range(3)] + [(43, text.upper()), (None, None), (44, "")]
    found = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {(r["doc_id"], r["class_id"], r["links"]) for r in found} == {(i, 0, 43) for i in range(44)} | {(None, None, 0), (44, 44, 0)}
