import numpy as np

from cardwarden.llm.maxscore import Shard


def test_a_block_of_queries_equals_brute_force():
    r = np.random.default_rng(8)
    for scale in (3, 200, 1 << 40):  # ties, usual sizes, sums too large for exact floats
        vectors = r.integers(-scale, scale + 1, (300, 9))
        vectors[50:60] = vectors[50]
        vectors[200:] = -np.abs(vectors[200:])
        ids = r.permutation(300)
        if scale == 1 << 40:
            vectors >>= 12
        shard = Shard(ids, np.arange(300), vectors)
        places = np.arange(0, 300, 2)
        for q, (found, scores) in zip(places, shard.best(vectors[places], places, 5)):
            all_scores = vectors @ vectors[q]
            expected = sorted((-s, i) for n, (s, i) in enumerate(zip(all_scores.tolist(), ids.tolist())) if n != q)[:5]
            assert [(-s, i) for s, i in zip(scores.tolist(), ids[found].tolist())] == expected


def test_few_rows():
    shard = Shard(np.array([7, 9]), np.array([0, 1]), np.array([[1, 2], [3, -4]]))
    (places, scores), (none, _) = shard.best(np.array([[1, 2], [0, 0]]), np.array([0, 5]), 5)
    assert places.tolist() == [1] and scores.tolist() == [-5]
    assert none.tolist() == [0, 1]
