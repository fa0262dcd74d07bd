import pytest

import corpus_pipeline
from cardwarden.llm import cross_entropy, jaccard_join

KEYS = {"spark.sql.files.openCostInBytes": ("0", "0"), "spark.sql.files.minPartitionNum": ("1", "1"), "spark.sql.files.maxPartitionBytes": ("100m", "2000")}


@pytest.fixture()
def resplit(spark, monkeypatch):
    """Files are split anew after the first written table, as where executors come or go between jobs."""
    before = {k: spark.conf.get(k, None) for k in KEYS}
    for k, (first, _) in KEYS.items():
        spark.conf.set(k, first)

    def patch(module):
        real = module.stage

        def stage(df, name):
            out = real(df, name)
            for k, (_, then) in KEYS.items():
                spark.conf.set(k, then)
            return out

        monkeypatch.setattr(module, "stage", stage)

    yield patch
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_losses_stay_with_their_documents(spark, tmp_path, resplit):
    rows = [(i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(5 + i % 40))) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "d"))
    docs, ids = spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame([(i,) for i in range(0, 300, 3)], "doc_id long")
    out = lambda: {r["doc_id"]: (r["tokens"], round(r["target_loss"], 6), round(r["background_loss"], 6)) for r in cross_entropy.cross_entropy_difference(docs, ids).collect()}
    want = out()
    resplit(cross_entropy)
    assert out() == want and len(want) == 300


def test_near_copies_are_dropped_and_nothing_else(spark, tmp_path, resplit):
    text = lambda i: " ".join(f"x{i}y{j}" for j in range(60))
    rows = [(i, text(i)) for i in range(200)] + [(1000 + i, text(i) + " more") for i in range(0, 200, 4)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "d"))
    resplit(jaccard_join)
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "d")), "").collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(200))
