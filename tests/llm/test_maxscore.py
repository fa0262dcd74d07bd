import numpy as np

from cardwarden.llm.maxscore import top_k


def test_equals_brute_force(spark):
    r = np.random.default_rng(5)
    vectors = r.standard_normal((600, 12)) / 4
    vectors[100:140] = vectors[100]  # ties
    vectors[300:] = -np.abs(vectors[300:])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    extra = [(1000, None), (1050, [float("nan")] * 12), (1100, [None] * 12), (None, rows[0][1]), (1150, [])]
    found = top_k(spark.createDataFrame(rows + extra, "vec_id long, embedding array<double>"), shard_rows=150, query_rows=5).collect()
    q = np.floor(256 * vectors).astype(int)
    expected = set()
    for i in range(0, 600, 50):
        scores = q @ q[i]
        best = sorted((-s, j) for j, s in enumerate(scores) if j != i)[:5]
        expected |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    assert {(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in found} == expected


def test_empty(spark):
    assert top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []
