import hashlib
import random
import zlib

import pytest

from cardwarden.llm import merkle
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, up string, hash int"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields)


def climb_levels(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute(rows):
    """The contract, row by row, with everything in memory."""
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, order = {}, {}
    for s in sources:
        mine = [r for r in rows if r["source"] == s]
        mine.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        order[s] = mine
        trees[s] = climb_levels([leaf_of(r, r["text"]) for r in mine])
    top = climb_levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(order[s]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            text = r["text"].replace("\n", "") if hit and r["text"] is not None else r["text"]
            folded, proof = leaf_of(r, text), []
            for levels, at in ((trees[s], i), (top, k)):
                for level in levels[:-1]:
                    run = level[at // 3 * 3 : at // 3 * 3 + 3]
                    proof += run[: at % 3] + run[at % 3 + 1 :]
                    folded = h(run[: at % 3] + [folded] + run[at % 3 + 1 :])
                    at //= 3
            root = top[-1][0]
            out.append((r["doc_id"], leaf_of(r, r["text"]), trees[s][-1][0], root, h(proof), folded, folded == root))
    return out


def got(df):
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in df.collect()]


def climbed(docs):
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    fields = {f: F.col(f) for f in merkle.FIELDS} | {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return merkle.climb(merkle.build_manifest(docs, altered=F.when(hit, merkle._digest(merkle.record(fields)))))


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


def rows_of(rng, n, sources):
    rows = [
        (rng.choice([None, *range(4 * n)]), rng.choice([None, "", "one\ntwo\n", "straße\n" * 3, "word " * rng.randrange(1, 9)]), rng.choice([None, "de"]), rng.choice(sources), rng.choice([None, 7]), "x", 1)
        for _ in range(n)
    ]
    return rows + rows[: n // 5]  # repeated rows


@pytest.mark.parametrize("n,sources", [(1, ["a"]), (2, [None, "a"]), (40, ["a"]), (160, ["hot"] * 9 + [None, "", "é", "z", "b", "c", "d"]), (60, [f"s{i}" for i in range(50)])])
def test_against_brute_force(spark, n, sources, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = rows_of(random.Random(n), n, sources)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    assert same(got(climbed(spark.createDataFrame(rows, SCHEMA).repartition(3))), brute([dict(zip(names, r)) for r in rows]))


def test_empty(spark):
    assert climbed(spark.createDataFrame([], SCHEMA)).collect() == []


def test_very_long_text_and_changed_fields(spark):
    rows = [(i, "line\n" * (200_000 if i == 3 else 2), "en", "a", i, "x", 1) for i in range(5)]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    found = got(climbed(spark.createDataFrame(rows, SCHEMA)))
    assert same(found, brute([dict(zip(names, r)) for r in rows]))
    assert {r[0]: r[-1] for r in found} == {i: zlib.crc32(str(i).encode()) % 2 == 1 for i in range(5)}
    assert all(r[-1] for r in got(merkle.climb(merkle.build_manifest(spark.createDataFrame(rows, SCHEMA)))))


def test_no_join_key_of_the_climb_holds_more_rows_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 16)
    docs = spark.range(700).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("hot").alias("source"), F.lit(1).alias("n_chars"))
    made = merkle.build_manifest(docs)
    wide = made.nodes.select(F.explode(F.sequence((F.col("first") / 16).cast("long"), (F.col("last") / 16).cast("long"))), "node")
    assert wide.distinct().count() == wide.count() and made.leaves.groupBy((F.col("at") / 16).cast("long")).count().agg(F.max("count")).first()[0] == 16
    assert made.nodes.groupBy("node").count().where("count > 1").count() == 0
