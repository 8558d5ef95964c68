"""Toxic passages by maximum-scoring segments.

A bounded sample of labelled rows gives each word a log-odds between toxic and
clean documents under an informative Dirichlet prior (the pooled word counts,
scaled), shrunk by its standard error. Every token then scores its log-odds less
a drift, so ordinary prose drifts down and a passage stands out as a segment
whose sum is maximal. A linear-time scan over the cumulative sums finds all
maximal segments of a text. The sums follow an extreme-value law: a segment of
sum S is expected E = K n exp(-lambda S) times by chance in n tokens of clean
prose. lambda and K are fitted to the best segments of clean labelled documents;
passages with E below ``significance`` are significant. A document's excesses
over chance (the best one's, and the sum of the significant ones') go through a
logistic fit on labelled rows, which gives the score.

Labelled rows: at most ``max_labelled`` of those whose crc32(doc_id as text) mod
5 is not 0, those of least hash, are used. Everything else covers all documents.

Defined cases: null text is empty; a text without known words has the score of
"no passage"; a doc_id labelled more than once is toxic if any label is; null
labels are left out; without toxic or clean labels every score is 0; repeated
rows each give a row. The scan is map-only; the model (words of the bounded
sample) is broadcast.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import drop_materialized, map_rows, materialize, ship, texts

MAX_LABELLED = 20_000
WORD = re.compile(r"[^\W\d_]+")
PRIOR = 0.02  # prior tokens for each token counted
DRIFT = 0.6
MIN_COUNT = 4
SIGNIFICANCE = 0.05


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def maximal_segments(items: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments of (score, start, end) items in order: (sum, start, end).

    One pass: candidates keep the cumulative sums at their left and right ends and
    a pointer to the nearest earlier candidate with a lower left sum.
    """
    found: list[list] = []  # [left sum, right sum, start, end, pointer]
    total = 0.0
    for s, a, b in items:
        if s <= 0:
            total += s
            continue
        cur = [total, total + s, a, b, -1]
        total += s
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= cur[0]:
                j = found[j][4]
            if j < 0 or found[j][1] >= cur[1]:
                cur[4] = j
                found.append(cur)
                break
            cur = [found[j][0], cur[1], found[j][2], cur[3], -1]
            del found[j:]
            j = len(found) - 1
    return [(x[1] - x[0], x[2], x[3]) for x in found]


def segments(text: str, weights: dict[str, float], drift: float) -> tuple[int, list[tuple[float, int, int]]]:
    """Number of tokens, and the maximal segments over token positions [start, end)."""
    tokens = words(text)
    items, at = [], 0
    for i, w in enumerate(tokens):
        v = weights.get(w)
        if v is not None:
            if i > at:
                items.append((-drift * (i - at), at, i))
            items.append((v - drift, i, i + 1))
            at = i + 1
    return len(tokens), maximal_segments(items)


def features(n: int, segs: list[tuple[float, int, int]], lam: float, log_k: float) -> tuple[float, float]:
    """Excess over chance of the best segment, and of all significant ones together."""
    base = log_k + np.log(max(n, 1))
    over = [lam * s - base for s, _, _ in segs]
    cut = -np.log(SIGNIFICANCE)
    return max(over, default=-cut), sum(x for x in over if x >= cut)


def score_of(n: int, segs: list, model: dict) -> float:
    if not model["weights"]:
        return 0.0
    x, y = features(n, segs, model["lam"], model["log_k"])
    b = model["beta"]
    z = b[0] + b[1] * max(-6.0, min(x, 12.0)) + b[2] * min(np.log1p(y), 6.0)
    return float(1 / (1 + np.exp(-max(-40.0, min(z, 40.0)))))


def held_out(col) -> F.Column:
    return F.crc32(col.cast("string").cast("binary")) % 5 == 0


def _labelled(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """(doc_id, text, toxic, part) of the bounded sample, written once."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
           .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(2)).cast("int")))
    return materialize(texts(docs).join(F.broadcast(lab), "doc_id"), "toxic-sample")  # broadcast: max_labelled rows


def _counts(sample: DataFrame) -> DataFrame:
    """(word, t0, c0, t1, c1): toxic and clean documents with the word, by half of the sample.

    A word counts once for each document, so a text that repeats itself is one witness.
    """
    names = ("t0", "c0", "t1", "c1")

    def make():
        def step(b):
            sums = {k: Counter() for k in names}
            for t, y, part in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(),
                                  b.column("part").to_pylist(), strict=True):
                sums[f"{'t' if y > 0 else 'c'}{part}"].update(set(words(t)))
            vocab = list(set().union(*sums.values()))
            return {"word": vocab} | {k: [sums[k][w] for w in vocab] for k in names}
        return step

    rows = map_rows(sample.select("text", "toxic", "part"), make, "word string, t0 long, c0 long, t1 long, c1 long")
    return rows.groupBy("word").agg(*[F.sum(k).alias(k) for k in names])


def _shrunk_odds(t: F.Column, c: F.Column, n_t: float, n_c: float) -> F.Column:
    """Log-odds of a word under the informative prior, moved one standard error towards 0."""
    a_t, a_c = PRIOR * n_t, PRIOR * n_c  # prior mass on each side, spread as the pooled counts
    share = (t + c) / F.lit(n_t + n_c)
    t, c = t + a_t * share, c + a_c * share
    odds, error = F.log(t / (n_t + a_t - t)) - F.log(c / (n_c + a_c - c)), F.sqrt(1 / t + 1 / c)
    return F.when(odds > 0, F.greatest(odds - error, F.lit(0.0))).otherwise(F.least(odds + error, F.lit(0.0)))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict:
    """Word weights and calibration as a plain dict (bounded by the sample).

    The calibration scores each half with the weights of the other; the model's own weights are of both.
    """
    sample = _labelled(docs, labels, max_labelled)
    try:
        counts = _counts(sample).cache()
        n = counts.agg(*[F.coalesce(F.sum(k), F.lit(0)).cast("double").alias(k) for k in ("t0", "c0", "t1", "c1")]).first()
        weights = []
        for halves in (("0",), ("1",), ("0", "1")):
            n_t, n_c = (sum(n[k + h] for h in halves) for k in "tc")
            t, c = (sum((F.col(k + h) for h in halves), F.lit(0)) for k in "tc")
            if not n_t or not n_c:
                weights.append({})
                continue
            rows = counts.where(t + c >= MIN_COUNT).select("word", F.round(_shrunk_odds(t, c, n_t, n_c), 6).alias("w"))
            weights.append({r.word: r.w for r in rows.where(F.abs("w") >= 0.2).collect()})  # words of the bounded sample
        counts.unpersist()
        if not weights[2]:
            return {"weights": {}, "lam": 1.0, "log_k": 0.0, "beta": [0.0, 0.0, 0.0], "drift": DRIFT}
        return _calibrate(sample, weights)
    finally:
        drop_materialized(sample)


def _calibrate(sample: DataFrame, weights: list[dict[str, float]]) -> dict:
    shared = sample.sparkSession.sparkContext.broadcast(weights[:2])

    def make():
        def step(b):
            out = [segments(t, shared.value[1 - p], DRIFT)
                   for t, p in zip(b.column("text").to_pylist(), b.column("part").to_pylist(), strict=True)]
            return {"doc_id": b.column("doc_id"), "toxic": b.column("toxic"), "n": [n for n, _ in out],
                    "sums": [sorted((s for s, _, _ in segs), reverse=True) for _, segs in out]}
        return step

    rows = (map_rows(sample.select("doc_id", "text", "toxic", "part"), make,
                     "doc_id long, toxic int, n long, sums array<double>").orderBy("doc_id", "n").collect())  # bounded sample
    clean = [(r.n, r.sums[0]) for r in rows if not r.toxic and r.sums]
    lam, log_k = 1.0, 0.0
    if len(clean) >= 20 and np.std([s for _, s in clean]) > 0:
        # best segment of n clean tokens: location (ln K + ln n) / lambda, by moments, without the mislabelled tail
        best = np.array([s for _, s in clean])
        best = np.minimum(best, np.quantile(best, 0.98))
        lam = float(min(5.0, np.pi / max(np.std(best) * np.sqrt(6), 1e-6)))
        log_k = float(np.mean(lam * best - np.log([max(n, 1) for n, _ in clean])) - np.euler_gamma)
    f = [features(r.n, [(s, 0, 0) for s in r.sums], lam, log_k) for r in rows]
    y = np.array([float(r.toxic > 0) for r in rows])
    x = np.array([[1.0, max(-6.0, min(a, 12.0)), min(np.log1p(b), 6.0)] for a, b in f]).reshape(-1, 3)
    return {"weights": weights[2], "lam": lam, "log_k": log_k, "beta": _logistic(x, y), "drift": DRIFT}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> list[float]:
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return [float(round(v, 9)) for v in b]


def passages(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, end, score, e_value): every significant passage, in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def step(b):
            out = {k: [] for k in ("doc_id", "start", "end", "score", "e_value")}
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                low = t.lower()
                at = [x.span() for x in WORD.finditer(low if len(low) == len(t) else t)]
                n, segs = segments(t, m["weights"], m["drift"])
                for s, i, j in segs:
                    e = float(np.exp(m["log_k"] + np.log(n) - m["lam"] * s))
                    if e <= SIGNIFICANCE and j <= len(at):
                        for k, v in (("doc_id", d), ("start", at[i][0]), ("end", at[j - 1][1]), ("score", s), ("e_value", e)):
                            out[k].append(v)
            return out
        return step

    return map_rows(texts(docs, id_col, text_col), make, "doc_id long, start long, end long, score double, e_value double")


def score_documents(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def step(b):
            scores, found = [], []
            for t in b.column("text").to_pylist():
                n, segs = segments(t, m["weights"], m["drift"])
                scores.append(score_of(n, segs, m))
                least = -np.log(SIGNIFICANCE) + m["log_k"] + np.log(max(n, 1))
                found.append(sum(m["lam"] * s >= least for s, _, _ in segs))
            return {"doc_id": b.column("doc_id"), "score": scores, "n_passages": found}
        return step

    out = map_rows(texts(docs, id_col, text_col), make, "doc_id long, score double, n_passages long")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages")


def without_toxic(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The documents whose score is under 0.5, all columns as they were."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_labelled))

    def run(batches):
        m = shared.value
        for b in batches:
            keep = [score_of(*segments(t or "", m["weights"], m["drift"]), m) < 0.5 for t in b.column("text").to_pylist()]
            yield b.filter(_mask(keep))

    return docs.mapInArrow(run, docs.schema)


def _mask(keep: list[bool]):
    import pyarrow as pa

    return pa.array(keep, pa.bool_())
