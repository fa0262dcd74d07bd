"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word is read twice: by its own vector, where the training sample holds it often enough, and by the mean of
the vectors of its character trigrams. Both directions run over windows of ``WIDTH`` words that overlap by
half and cover the whole text; attention pools a window's states and the document scores as its worst
window. Labels mark documents, so training alternates between scoring the windows of the sampled documents
and learning from the worst window of each.

The fit sees at most ``SAMPLE`` labelled documents of each class, those with the smallest md5 of their id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import arrow_map, stage, table

WIDTH = 32
STEP = 16
HIDDEN = 8
WORD_DIM = 8
CHAR_DIM = 8
TRIGRAMS = 2048
MIN_DOCUMENTS = 4
SAMPLE = 600
ROUNDS = 6
THRESHOLD = 0.3
CACHE_WORDS = 200_000
CHUNK = 2048
TOGETHER = 10_000

Model = dict


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def words_of(text: str | None) -> list[str]:
    """Words in lower case without the punctuation around them."""
    return [w.strip(".,;:!?\"'()[]") or w for w in (text or "").lower().split()]


class Lexicon:
    """Words to row numbers, in the order of first sight; row 0 is padding. ``known`` are rows of trained vectors."""

    def __init__(self, known: dict[str, int]):
        self.known, self.rows = known, {}
        self.word_ids, self.words = [0], [""]

    def __getitem__(self, word: str) -> int:
        row = self.rows.get(word)
        if row is None:
            row = self.rows[word] = len(self.word_ids)
            self.word_ids.append(self.known.get(word, 0))
            self.words.append(word)
        return row


def windows(n: int) -> list[int]:
    """Starts of the windows that cover ``n`` words; the last one ends with the text."""
    if n <= WIDTH:
        return [0]
    starts = list(range(0, n - WIDTH, STEP))
    return [*starts, n - WIDTH]


def window_rows(words: list[str], lexicon: Lexicon) -> np.ndarray:
    ids = np.fromiter((lexicon[w] for w in words), dtype=np.int32, count=len(words))
    if len(ids) < WIDTH:
        ids = np.concatenate([ids, np.zeros(WIDTH - len(ids), np.int32)])
    return np.lib.stride_tricks.sliding_window_view(ids, WIDTH)[windows(len(words))]


def new_model(known: dict[str, int], seed: int = 7) -> Model:
    r = np.random.default_rng(seed)
    inputs = WORD_DIM + CHAR_DIM
    draw = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
    m: Model = {"known": known, "E": draw(len(known) + 1, WORD_DIM, scale=0.3), "C": draw(TRIGRAMS, CHAR_DIM, scale=0.3)}
    m["E"][0] = 0
    for d in "fb":
        m["W" + d] = draw(inputs, 3 * HIDDEN, scale=0.3)
        m["b" + d] = np.zeros(3 * HIDDEN, np.float32)
        m["U" + d] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
    m["A"], m["a"] = draw(2 * HIDDEN, HIDDEN, scale=0.3), np.zeros(HIDDEN, np.float32)
    m["v"], m["w"], m["c"] = draw(HIDDEN, scale=0.3), draw(2 * HIDDEN, scale=0.3), np.zeros(1, np.float32)
    return m


def word_inputs(m: Model, lexicon: Lexicon, rows: np.ndarray) -> np.ndarray:
    """Input vectors of lexicon rows."""
    out = np.zeros((len(rows), WORD_DIM + CHAR_DIM), np.float32)
    out[:, :WORD_DIM] = m["E"][np.asarray(lexicon.word_ids, np.int64)[rows]]
    flat, counts = flat_grams(lexicon, rows)
    if len(flat):
        starts = np.cumsum(counts) - counts
        real = counts > 0
        out[real, WORD_DIM:] = np.add.reduceat(m["C"][flat], starts[real], axis=0) / counts[real][:, None]
    return out


def flat_grams(lexicon: Lexicon, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the character trigrams of lexicon rows, one after another, and how many each row has."""
    marked = [f"^{lexicon.words[row]}$" if row else "" for row in rows]
    lengths = np.fromiter((len(w) for w in marked), dtype=np.int64, count=len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
    numbers = (codes[:-2] * 961 + codes[1:-1] * 31 + codes[2:]) % TRIGRAMS
    counts = np.maximum(lengths - 2, 0)
    starts = (np.cumsum(lengths) - lengths)[counts > 0]
    inside = np.arange(int(counts.sum())) - np.repeat((np.cumsum(counts) - counts)[counts > 0], counts[counts > 0])
    return numbers[np.repeat(starts, counts[counts > 0]) + inside], counts


def run_direction(m: Model, d: str, projected: np.ndarray, mask: np.ndarray, keep: bool):
    """States (T, B, H) of one direction over ``projected`` (T, B, 3H); with ``keep`` also the gates."""
    steps, batch, _ = projected.shape
    U, H = m["U" + d], HIDDEN
    h = np.zeros((batch, H), np.float32)
    states, saved = np.empty((steps, batch, H), np.float32), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        hu = h @ U
        gates = sigmoid(projected[t, :, : 2 * H] + hu[:, : 2 * H])
        z, r = gates[:, :H], gates[:, H:]
        n = np.tanh(projected[t, :, 2 * H :] + r * hu[:, 2 * H :])
        on = mask[t][:, None]
        new = n + z * (h - n)
        new = np.where(on, new, h)
        if keep:
            saved.append((t, h, z, r, n, hu[:, 2 * H :], on))
        h = new
        states[t] = h
    return states, saved


def forward(m: Model, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows; ``x`` (T, B, inputs), ``mask`` (T, B)."""
    pf, pb = x @ m["Wf"] + m["bf"], x @ m["Wb"] + m["bb"]
    hf, sf = run_direction(m, "f", pf, mask, keep)
    hb, sb = run_direction(m, "b", pb, mask, keep)
    hs = np.concatenate([hf, hb], axis=2)
    u = np.tanh(hs @ m["A"] + m["a"])
    e = np.where(mask, u @ m["v"], -1e9)
    e = np.exp(e - e.max(axis=0)) * mask
    att = e / (e.sum(axis=0) + 1e-9)
    pooled = np.einsum("tb,tbh->bh", att, hs)
    return pooled @ m["w"] + m["c"][0], (sf, sb, hs, u, att, pooled)


def backward(m: Model, x: np.ndarray, mask: np.ndarray, kept, dlogit: np.ndarray) -> tuple[dict, np.ndarray]:
    sf, sb, hs, u, att, pooled = kept
    H, g = HIDDEN, {}
    g["w"], g["c"] = pooled.T @ dlogit, np.array([dlogit.sum()])
    dpool = dlogit[:, None] * m["w"]
    dhs = att[:, :, None] * dpool
    datt = np.einsum("tbh,bh->tb", hs, dpool)
    de = att * (datt - (att * datt).sum(axis=0))
    g["v"] = np.einsum("tb,tbh->h", de, u)
    du = de[:, :, None] * m["v"] * (1 - u * u)
    g["A"], g["a"] = np.einsum("tbi,tbj->ij", hs, du), du.sum(axis=(0, 1))
    dhs += du @ m["A"].T
    dx = np.zeros_like(x)
    for d, saved, part in (("f", sf, dhs[:, :, :H]), ("b", sb, dhs[:, :, H:])):
        U, dh = m["U" + d], np.zeros((x.shape[1], H), np.float32)
        gU, dproj = np.zeros_like(U), np.zeros((*x.shape[:2], 3 * H), np.float32)
        for t, h, z, r, n, hn, on in reversed(saved):
            dh = dh + part[t]
            dnew = np.where(on, dh, 0)
            dn = dnew * (1 - z) * (1 - n * n)
            dz = dnew * (h - n) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            dhu = np.concatenate([dz, dr, dn * r], axis=1)
            dproj[t] = np.concatenate([dz, dr, dn], axis=1)
            gU += h.T @ dhu
            dh = np.where(on, dnew * z + dhu @ U.T, dh)
        g["U" + d] = gU
        g["W" + d], g["b" + d] = np.einsum("tbi,tbj->ij", x, dproj), dproj.sum(axis=(0, 1))
        dx += dproj @ m["W" + d].T
    return g, dx


def fit(texts: list[str | None], labels: list[int], rounds: int = ROUNDS, seed: int = 7) -> Model:
    """Train on whole texts. With one class only, or none, the model is untrained and scores near its share."""
    split = [words_of(t) for t in texts]
    seen = Counter(w for words in split for w in set(words))
    known = {w: i + 1 for i, w in enumerate(sorted(w for w, n in seen.items() if n >= MIN_DOCUMENTS))}
    m, r = new_model(known, seed), np.random.default_rng(seed)
    if not texts:
        return m
    lexicon = Lexicon(known)
    per = [window_rows(words, lexicon) for words in split]
    owner = np.repeat(np.arange(len(per)), [len(p) for p in per])
    stacked, y = np.concatenate(per), np.asarray(labels, np.float32)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in m.items() if k != "known"}
    step = 0
    for turn in range(rounds):
        if turn == 0:  # before anything is learnt, a window counts as its document does
            chosen = r.permutation(len(stacked))[: 12 * len(per)]
        else:
            scores = score_rows(m, Projections(m, lexicon), stacked)
            worst = np.lexsort((scores, owner))
            chosen = worst[np.append(owner[worst][1:] != owner[worst][:-1], True)]
            chosen = r.permutation(np.concatenate([chosen] * 2))
        for at in range(0, len(chosen), 64):
            pick = chosen[at : at + 64]
            rows, target = stacked[pick].T, y[owner[pick]]
            unique, inverse = np.unique(rows, return_inverse=True)
            x = word_inputs(m, lexicon, unique)[inverse.reshape(rows.shape)]
            mask = rows > 0
            logit, kept = forward(m, x, mask, keep=True)
            g, dx = backward(m, x, mask, kept, ((sigmoid(logit) - target) / len(pick)).astype(np.float32))
            g["E"], g["C"] = np.zeros_like(m["E"]), np.zeros_like(m["C"])
            per_word = np.zeros((len(unique), dx.shape[2]), np.float32)
            np.add.at(per_word, inverse.reshape(-1), dx.reshape(-1, dx.shape[2]))
            np.add.at(g["E"], np.asarray(lexicon.word_ids)[unique], per_word[:, :WORD_DIM])
            flat, counts = flat_grams(lexicon, unique)
            np.add.at(g["C"], flat, np.repeat(per_word[:, WORD_DIM:] / np.maximum(counts, 1)[:, None], counts, axis=0))
            g["E"][0] = 0
            step += 1
            rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, grad in g.items():
                a, b = moments[k]
                a += 0.1 * (grad - a)
                b += 0.001 * (grad * grad - b)
                m[k] -= (rate * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
    return m


def _attended(m: Model, tables: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Logits of windows ``rows`` (T, B) as ``forward`` gives them, with the batch as the inner axis; ``tables``
    hold each lexicon row's projection for both directions."""
    steps, batch = rows.shape
    H, mask = HIDDEN, rows > 0
    full = mask.all(axis=1)
    states = np.empty((steps, 2 * H, batch), np.float32)
    for d, projected, at in (("f", tables[0], 0), ("b", tables[1], H)):
        U = np.ascontiguousarray(m["U" + d].T)
        h = np.zeros((H, batch), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = np.ascontiguousarray(projected[rows[t]].T)
            hu = U @ h
            gates = x[: 2 * H] + hu[: 2 * H]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            n = hu[2 * H :]
            n *= gates[H:]
            n += x[2 * H :]
            np.tanh(n, out=n)
            new = h - n
            new *= gates[:H]
            new += n
            h = new if full[t] else np.where(mask[t], new, h)
            states[t, at : at + H] = h
    flat = np.ascontiguousarray(states.transpose(1, 0, 2)).reshape(2 * H, -1)
    u = m["A"].T @ flat
    u += m["a"][:, None]
    np.tanh(u, out=u)
    e = np.where(mask, (m["v"] @ u).reshape(steps, batch), -1e9)
    e = np.exp(e - e.max(axis=0)) * mask
    e /= e.sum(axis=0) + 1e-9
    return ((m["w"] @ flat).reshape(steps, batch) * e).sum(axis=0) + m["c"][0]


class Projections:
    """Projected inputs of all rows of a lexicon, extended as the lexicon grows."""

    def __init__(self, m: Model, lexicon: Lexicon):
        self.m, self.lexicon, self.done = m, lexicon, 0
        self.tables = [np.zeros((1024, 3 * HIDDEN), np.float32) for _ in "fb"]

    def __call__(self) -> list[np.ndarray]:
        n = len(self.lexicon.word_ids)
        if n > self.done:
            x = word_inputs(self.m, self.lexicon, np.arange(self.done, n))
            for i, d in enumerate("fb"):
                if n > len(self.tables[i]):
                    self.tables[i] = np.concatenate([self.tables[i][: self.done], np.zeros((2 * n - self.done, 3 * HIDDEN), np.float32)])
                self.tables[i][self.done : n] = x @ self.m["W" + d] + self.m["b" + d]
            self.done = n
        return self.tables


def score_rows(m: Model, projections: Projections, stacked: np.ndarray) -> np.ndarray:
    """Probability of each window; a word is projected once, not once per place."""
    tables, out = projections(), np.empty(len(stacked), np.float32)
    for at in range(0, len(stacked), CHUNK):
        out[at : at + CHUNK] = _attended(m, tables, stacked[at : at + CHUNK].T)
    return sigmoid(out)


def _scorer(m: Model) -> Callable:
    """Windows are scored together until there are ``CHUNK``, and after ``TOGETHER`` rows, wherever a batch ends: the last
    digits of a score depend on what it is computed with, so they don't depend on the size of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(m["known"])
        projections = Projections(m, lexicon)
        waiting: list[pa.RecordBatch] = []
        scores: list[float] = []
        per, held, rows = [], 0, 0

        def flush() -> None:
            nonlocal per, held
            if per:
                found = score_rows(m, projections, np.concatenate(per))
                scores.extend(float(s) for s in np.maximum.reduceat(found, np.cumsum([0, *[len(p) for p in per[:-1]]])))
            per, held = [], 0

        def scored() -> Iterator[pa.RecordBatch]:
            while waiting and len(scores) >= waiting[0].num_rows:
                b = waiting.pop(0)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores[: b.num_rows], pa.float64())], names=[*b.schema.names, "score"])
                del scores[: b.num_rows]

        for b in batches:
            waiting.append(b)
            for text in b.column(b.num_columns - 1):
                per.append(window_rows(words_of(text.as_py()), lexicon))
                held += len(per[-1])
                rows += 1
                if held >= CHUNK or rows % TOGETHER == 0:
                    flush()
                if rows % TOGETHER == 0 and len(lexicon.rows) > CACHE_WORDS:
                    lexicon = Lexicon(m["known"])
                    projections = Projections(m, lexicon)
            yield from scored()
        flush()
        yield from scored()

    return run


def sampled_ids(docs: DataFrame, labels: DataFrame, sample: int) -> list[tuple]:
    """(id, class) of at most ``sample`` labelled documents of each class, those with the smallest md5 of their id.

    Ids only: a histogram of the first four digits of the md5 tells where a class has enough, and what lies beyond
    is not sorted.
    """
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    keyed = marked.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("o", F.md5(F.col("doc_id").cast("string")))
    keyed = stage(keyed.where(F.col("toxic").isin(0, 1)).withColumn("bin", F.substring("o", 1, 4)), "toxic-ids")
    bins = keyed.groupBy("toxic", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("toxic").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))  # 65,536 bins at most
    cuts = bins.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < sample).groupBy("toxic").agg(F.max("bin").alias("cut"))
    near = keyed.join(F.broadcast(cuts), "toxic").where(F.col("bin") <= F.col("cut"))
    return [(r["doc_id"], r["toxic"]) for c in (0, 1) for r in near.where(F.col("toxic") == c).orderBy("o", "doc_id").limit(sample).collect()]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents of each class. Of rows that share an id the smallest text counts."""
    chosen = sampled_ids(docs, labels, sample)
    if not chosen:
        return fit([], [])
    ids = docs.sparkSession.createDataFrame([(i,) for i, _ in chosen], docs.select("doc_id").schema)
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    texts = {r["doc_id"]: r["text"] for r in found}
    return fit([texts[i] for i, _ in chosen], [c for _, c in chosen])


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, 0 to 1, of its whole text. A null text is empty and scores as a window without
    words; repeated rows score alike; a column named ``score`` is replaced; no rows give no rows."""
    rest = [c for c in docs.columns if c != "score"]
    prepared = docs.select(*rest, F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prepared.schema.fields) + ", score double"
    return arrow_map(prepared, _scorer(model), schema).drop("__text")


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained_on_tables(spark: SparkSession, sf_dir: str) -> Model:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return train(documents, labels.where(~held_out()))


def op6_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), trained_on_tables(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
