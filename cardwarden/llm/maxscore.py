"""Exact top-k by inner product, by MaxScore.

A vector's component is a posting of the term (dimension, sign). A query weighs the terms that agree with its
own signs positively; the others can only lower a score. In each shard the positive terms are put in order of
their score bounds. Terms are essential until the bounds of the rest sum to less than the k-th best score so
far: only rows on essential postings can still win. Those postings are traversed, for some queries at once as a
product of matrices; the rest is probed, a few terms at a time, for rows that stay competitive. Shards and query blocks have bounded sizes and meet pairwise;
a query's best rows of all shards are merged at the end.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import ship, stage, table

TOP = 5
EVERY = 50
SHARD_ROWS = 16_384
QUERY_ROWS = 1_024
PROBE = 8
SEEDS = 65
TOGETHER = 64
_OUT = "query_row long, query_id long, row long, vec_id long, score long"


class Shard:
    """Postings of some rows: for each dimension and sign the rows and the sizes of their components."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray):
        self.ids, self.rows, self.vectors = ids, rows, vectors
        self.postings = {(d, s): np.flatnonzero(vectors[:, d] * s > 0) for d in range(vectors.shape[1]) for s in (1, -1)}
        self.strong: dict[tuple[int, int], np.ndarray] = {}
        self.floats: np.ndarray | None = None
        self.bounds = {s: np.maximum(vectors * s, 0).max(axis=0, initial=0) for s in (1, -1)}

    def seeds(self, d: int, s: int) -> np.ndarray:
        """The rows with the largest components on a posting, at most ``SEEDS``."""
        if (d, s) not in self.strong:
            on = self.postings[d, s]
            take = min(len(on), SEEDS)
            self.strong[d, s] = on[np.argpartition(-np.abs(self.vectors[on, d]), take - 1)[:take]] if take else on
        return self.strong[d, s]

    def least(self, query: np.ndarray, term: int | None, own: int, k: int) -> int | None:
        """A score that ``k`` other rows reach; none where so few are tried."""
        seed = np.arange(len(self.ids)) if term is None or len(self.ids) <= k + 1 else self.seeds(term, 1 if query[term] > 0 else -1)
        known = self.vectors[seed[self.rows[seed] != own]] @ query
        return int(np.partition(known, -k)[-k]) if len(known) >= k else None

    def best(self, queries: np.ndarray, owns: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (places, scores) of the ``k`` highest scores, ties to the smaller id; the query's own row is
        left out. The essential terms of several queries are traversed in one product of matrices."""
        bounds = np.where(queries > 0, queries * self.bounds[1], -queries * self.bounds[-1])
        order = np.argsort(-bounds, axis=1, kind="stable")
        sorted_bounds = np.take_along_axis(bounds, order, axis=1)
        rest = np.hstack([np.cumsum(sorted_bounds[:, ::-1], axis=1)[:, ::-1], np.zeros((len(queries), 1), bounds.dtype)])  # rest[q, i]: bounds of terms i and later
        least = [self.least(q, o[0] if len(o) else None, own, k) for q, o, own in zip(queries, order, owns)]
        # a row on no positive posting may be among the best where the least score is not above zero: all terms count
        upto = [int(np.argmax(r < v)) if v is not None and v > 0 and (r < v).any() else queries.shape[1] for r, v in zip(rest, least)]
        essential = np.zeros_like(queries)
        for e, q, o, n in zip(essential, queries, order, upto):
            e[o[:n]] = q[o[:n]]
        width = float(np.abs(queries).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * max(1, queries.shape[1])
        if self.floats is None and width < 2.0**52:  # such sums are exact
            self.floats = self.vectors.T.astype(np.float64)
        out = []
        for at in range(0, len(queries), TOGETHER):
            part = essential[at : at + TOGETHER]
            totals = part.astype(np.float64) @ self.floats if width < 2.0**52 else part @ self.vectors.T
            for i, total in enumerate(totals, at):
                query, own, terms = queries[i], owns[i], order[i]
                alive = np.flatnonzero(total + rest[i, upto[i]] >= least[i]) if least[i] is not None else np.arange(len(self.ids))
                alive = alive[self.rows[alive] != own]
                partial = total[alive].astype(np.int64)
                for n in range(upto[i], len(terms), PROBE):
                    ds = terms[n : n + PROBE]
                    partial += self.vectors[np.ix_(alive, ds)] @ query[ds]
                    good = partial + rest[i, min(n + PROBE, len(terms))] >= least[i]
                    alive, partial = alive[good], partial[good]
                first = np.lexsort((self.rows[alive], self.ids[alive], -partial))[:k]
                out.append((alive[first], partial[first]))
        return out


def _cell(k: int) -> Callable:
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            length = rows["vector"].map(len).to_numpy()
            for size in np.unique(length):
                part = rows[length == size]
                shard = Shard(part["vec_id"].to_numpy(), part["row"].to_numpy(), np.stack(part["vector"].to_list()).astype(np.int64))
                asked = queries[queries["vector"].map(len) == size]
                if len(asked):
                    best = shard.best(np.stack(asked["vector"].to_list()).astype(np.int64), asked["row"].to_numpy(), k)
                    for q, own, (places, scores) in zip(asked["vec_id"], asked["row"], best):
                        out += [(own, q, shard.rows[p], shard.ids[p], s) for p, s in zip(places, scores)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")])

    return run


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, vector of longs): floor(256 x). Rows with a null id or vector, no components, or a null or
    non-finite component are left out."""
    parts = F.col(vector).cast("array<double>")
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad)
    return good.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"), F.transform(parts, lambda x: F.floor(x * 256).cast("long")).alias("vector"))


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` best rows of each row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Vectors meet only those of their own length; rows with equal ids are rows of their own; no rows give no rows."""
    ship(vectors.sparkSession)
    rows = stage(quantised(vectors), "quantised")
    queries = rows.where(F.col("vec_id") % every == 0)
    shards, blocks = max(1, -(-rows.count() // shard_rows)), max(1, -(-queries.count() // query_rows))
    to = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select("*", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), to(shards).alias("shard"))
    given = rows.select("*", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(shards)).cast("int").alias("shard"), to(blocks).alias("block"))
    found = asked.groupBy("block", "shard").cogroup(given.groupBy("block", "shard")).applyInPandas(_cell(k), _OUT)
    best = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op5_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""
