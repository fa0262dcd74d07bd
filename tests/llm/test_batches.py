import random

import pyarrow as pa
from pyspark.sql import functions as F

from cardwarden.llm import common, toxicity


def _sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])


def test_batches_of_whole_texts_are_bounded_by_bytes(spark):
    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("abcdefgh"), 1250).alias("text"))
    found = common.arrow_map(texts, _sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in found) == 3000
    assert max(r["bytes"] for r in found) < 2 * common.BATCH_BYTES


def test_a_bound_of_the_session_stays(spark):
    before = spark.conf.get(common.BATCH_LIMIT, None)
    spark.conf.set(common.BATCH_LIMIT, str(1 << 20))
    try:
        common.bound_batches(spark)
        assert spark.conf.get(common.BATCH_LIMIT) == str(1 << 20)
    finally:
        spark.conf.unset(common.BATCH_LIMIT) if before is None else spark.conf.set(common.BATCH_LIMIT, before)


def test_scores_do_not_depend_on_the_size_of_batches():
    r = random.Random(2)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    texts = [None if i % 50 == 0 else " ".join(r.choices(words, k=r.randint(0, 200))) for i in range(700)]
    model = toxicity.fit(["bad awful text", "good nice text"] * 20, [1, 0] * 20, rounds=1)
    table = pa.table({"doc_id": list(range(700)), "text": texts})

    def scores(rows):
        found = pa.Table.from_batches(toxicity._scorer(model)(iter(table.to_batches(max_chunksize=rows))))
        assert found["doc_id"].to_pylist() == list(range(700))
        return found["score"].to_pylist()

    assert scores(700) == scores(37) == scores(1)
