import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import toxicity


def test_sampled_ids_are_the_smallest_hashes_of_each_class(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 != 3, (F.col("id") % 5 == 0).cast("int")).alias("toxic"))
    labels = labels.union(labels.limit(40)).union(spark.createDataFrame([(None, 1)], "doc_id long, toxic int"))
    for sample in (0, 1, 50, 10_000):
        want = []
        for c in (0, 1):
            ids = [i for i in range(5000) if i % 7 != 3 and (i % 5 == 0) == bool(c)]
            want += [(i, c) for i in sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:sample]]
        assert toxicity.sampled_ids(docs, labels, sample) == want


def test_training_rows_with_repeated_ids_and_nulls(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (None, 1)], "doc_id long, toxic int")
    assert sorted(toxicity.sampled_ids(docs, labels, 9)) == [(1, 1), (2, 0)]
    model = toxicity.train(docs, labels, 9)
    assert [r.score for r in toxicity.score_toxicity(docs, model).collect() if not 0 <= r.score <= 1] == []
    empty = toxicity.train(docs.limit(0), labels)
    assert toxicity.score_toxicity(docs, empty).count() == 5


@pytest.mark.parametrize("name", ["Wf", "Ub", "bf", "A", "v", "w", "c", "Uf"])
def test_gradient_equals_finite_differences(name):
    r = np.random.default_rng(1)
    m = {k: v.astype(np.float64) if k != "known" else v for k, v in toxicity.new_model({"a": 1}).items()}
    x = r.standard_normal((5, 3, toxicity.WORD_DIM + toxicity.CHAR_DIM))
    mask = np.ones((5, 3), bool)
    mask[3:, 1] = False
    x[~mask] = 0
    weights = r.standard_normal(3)
    logit, kept = toxicity.forward(m, x, mask, keep=True)
    grad = np.asarray(toxicity.backward(m, x, mask, kept, weights)[0][name])
    for at in list(np.ndindex(m[name].shape))[:: max(1, m[name].size // 9)]:
        values = []
        for step in (1e-3, -1e-3):
            changed = {k: v.copy() if k != "known" else v for k, v in m.items()}
            changed[name][at] += step
            values.append(toxicity.forward(changed, x, mask)[0] @ weights)
        assert grad[at] == pytest.approx((values[0] - values[1]) / 2e-3, rel=0.02, abs=2e-3)
