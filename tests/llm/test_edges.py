import pytest

from cardwarden.llm.cross_entropy import cross_entropy_difference
from cardwarden.llm.exact_dedup import exact_dedup
from cardwarden.llm.mixing import fair_mix
from cardwarden.llm.packing import pack_documents
from cardwarden.llm.sharding import shard_documents
from cardwarden.llm.toxicity import fit, score_toxicity

SCHEMA = "doc_id long, text string, source string, score string, kept int"
ROWS = [(1, "good words here", "a", "x", 1), (1, "good words here", "a", "x", 1), (2, None, None, None, None), (3, "", "b", "", 2), (None, "bad words there " * 4000, "a", "y", 3)]


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame([], SCHEMA)


def test_exact_dedup(frames):
    full, empty = frames
    found = exact_dedup(full).collect()
    assert sorted((r["keep_id"] or -1, r["group_size"], r["kept"]) for r in found) == [(-1, 1, True), (1, 2, False), (1, 2, True), (3, 2, False), (3, 2, True)]
    assert exact_dedup(empty).collect() == []


def test_shards_mix_and_packing(frames):
    full, empty = frames
    assert len(shard_documents(full).collect()) == 5 and shard_documents(empty).collect() == []
    mixed = fair_mix(full).collect()
    assert len(mixed) == 5 and all(r["taken"] <= 3 * r["size"] for r in mixed) and fair_mix(empty).collect() == []
    pieces = pack_documents(full).collect()
    assert all(r["offset"] + r["length"] <= 1024 for r in pieces)
    assert {r["doc_id"] for r in pieces} == {1, 2, 3, None} and pack_documents(empty).collect() == []


def test_toxicity(frames):
    full, empty = frames
    clean = [f"calm note number {i} about the garden and the sea" for i in range(40)]
    toxic = [f"calm note number {i} about the vile rotten garden" for i in range(40)]
    model = fit(clean + toxic, [0] * 40 + [1] * 40, rounds=80)  # 80 texts are two steps a round
    found = score_toxicity(full, model).collect()
    assert len(found) == 5 and all(0 <= r["score"] <= 1 for r in found) and score_toxicity(empty, model).collect() == []
    pair = full.sparkSession.createDataFrame([(1, clean[0]), (2, toxic[0])], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in score_toxicity(pair, model).collect()}
    assert scores[1] < 0.3 <= scores[2]


def test_cross_entropy(frames, spark):
    full, empty = frames
    found = cross_entropy_difference(full, spark.createDataFrame([(1,)], "doc_id long")).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 5 and by_id[1]["difference"] < 0 < by_id[None]["difference"]
    assert by_id[2]["tokens"] == 0 and by_id[2]["difference"] == 0 and by_id[None]["tokens"] == 12000
    assert cross_entropy_difference(empty, spark.createDataFrame([(1,)], "doc_id long")).collect() == []
