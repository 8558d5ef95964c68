"""Exact top-k inner products by block-at-a-time pruning.

Vectors become whole numbers, floor(1024 x). Documents are dealt into ranges of
vec_id and each range into blocks; a block keeps its vectors as one matrix (its
forward index) and, for each dimension, the largest and the least value (its term
maxima, the least for negative weights). For a query, the sum over dimensions of
the larger of q_d max_d and q_d min_d bounds every score in the block. Blocks are
taken in the order of their bounds and scored whole, until the bounds fall below
the query's k-th best score so far.

The queries are a stated set and grow with the table, so they are not broadcast
whole: chunks of ``QUERY_CHUNK`` queries (a proven size) are broadcast, a pass
over the blocks for each. The k-th best scores of a pass's first blocks (a bounded
seed) give every task a bound to start from. Each task returns k rows at most for
a query; the best k of all follow from a window whose limit runs before the
shuffle.

Defined cases: vectors that are null, or hold null or non-finite components, take
no part, nor do empty ones; vectors of each length are searched among their own; equal
scores go to the smaller vec_id; repeated rows of a vec_id are each a candidate
(and each a query, whose own vec_id is never its candidate; such queries share
their ranks); fewer than k candidates are all returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import drop_materialized, map_rows, materialize, ship

SCALE = 1024
BLOCK = 512
QUERY_CHUNK = 8192
RANGE_ROWS = 16 * BLOCK
NONE = np.iinfo(np.int64).min + 1  # its negative is a whole number too


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part."""
    v = F.col(vec_col)
    good = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))

    def whole(x):
        scaled = F.lit(float(SCALE)) * x.cast("double")
        # non-finite ones are null here, since the filter above may run after this
        return F.when(F.abs(scaled) < F.lit(2.0**63), F.floor(scaled)).when(
            F.abs(x.cast("double")) < F.lit(float("inf")), F.raise_error(F.lit("a component does not fit into 64 bits")).cast("long"))

    rows = table.where(good).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, whole).alias("v"))
    return rows.where(F.size("v") > 0)


def _blocks(rows: DataFrame) -> DataFrame:
    """(part, ids, vectors, high, low): a row for each block, of vec_ids that follow each other."""
    schema = "part long, ids array<long>, vectors binary, high array<long>, low array<long>"

    def run(part, batch):
        batch = batch.sort_by("vec_id")
        ids = batch.column("vec_id").to_numpy()
        x = np.array(batch.column("v").to_pylist(), np.int64).reshape(len(ids), -1)
        out = {"part": [], "ids": [], "vectors": [], "high": [], "low": []}
        for a in range(0, len(ids), BLOCK):
            b = x[a:a + BLOCK]
            for k, v in (("part", part[0].as_py()), ("ids", ids[a:a + BLOCK]), ("vectors", b.tobytes()), ("high", b.max(0)), ("low", b.min(0))):
                out[k].append(v)
        return pa.table([pa.array(out["part"], pa.int64()), pa.array(out["ids"], pa.list_(pa.int64())), pa.array(out["vectors"], pa.binary()),
                         pa.array(out["high"], pa.list_(pa.int64())), pa.array(out["low"], pa.list_(pa.int64()))],
                        names=["part", "ids", "vectors", "high", "low"])

    span = rows.agg(F.min("vec_id").alias("a"), F.max("vec_id").alias("b"), F.count("*").alias("n")).first()
    width = max(1, (span.b - span.a + 1) * RANGE_ROWS // max(span.n, 1)) if span.n else 1
    # ranges of vec_id of about RANGE_ROWS rows; a crowded range is dealt further by a hash, which only loosens its blocks
    part = F.floor((F.col("vec_id") - F.lit(span.a or 0)) / width)
    crowd = rows.groupBy(part.alias("__part")).agg(F.ceil(F.count("*") / (2 * RANGE_ROWS)).alias("__ways"))
    dealt = rows.withColumn("__part", part).join(crowd, "__part").select(
        "vec_id", "v", F.xxhash64("__part", F.pmod(F.xxhash64("vec_id", "v"), F.col("__ways"))).alias("part"))
    return dealt.groupBy("part").applyInArrow(run, schema)


def _matrix(vectors: bytes, n: int) -> np.ndarray:
    return np.frombuffer(vectors, np.int64).reshape(n, -1)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; through doubles where they hold every sum exactly."""
    if not a.size or not b.size:
        return a @ b.T
    most = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    if most < 2**52:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    sums = a.astype(object) @ b.astype(object).T
    if max(sums.max(), -sums.min()) >= 2**63 - 1:
        raise OverflowError("an inner product does not fit into 64 bits")
    return sums.astype(np.int64)


class Best:
    """The k best (score, vec_id) of each query so far."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.k, self.query_ids = k, ids
        self.score = np.full((len(ids), k), NONE)
        self.ids = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = np.full(len(ids), NONE) if floor is None else floor

    def kth(self) -> np.ndarray:
        return np.maximum(self.score[:, -1], self.floor)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: of the queries in rows against the vectors ids."""
        own = self.query_ids[rows][:, None] == ids[None, :]
        scores = np.where(own, NONE, scores)
        s = np.hstack([self.score[rows], scores])
        i = np.hstack([self.ids[rows], np.where(own, np.iinfo(np.int64).max, np.broadcast_to(ids, scores.shape))])
        top = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[rows], self.ids[rows] = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)


def search_blocks(blocks: list[dict], q: np.ndarray, best: Best) -> int:
    """Scores blocks in the order of their bounds while these reach a query's k-th best; returns the pairs scored."""
    high = np.array([b["high"] for b in blocks], np.float64)
    low = np.array([b["low"] for b in blocks], np.float64)
    up, down = np.maximum(q, 0).astype(np.float64), np.minimum(q, 0).astype(np.float64)
    bounds = up @ high.T + down @ low.T  # whole numbers, exact under 2**53
    size = up @ np.abs(high).T - down @ np.abs(low).T
    if size.size and size.max() >= 2**52:
        bounds = bounds + size * (q.shape[1] + 4) * 2.0**-51
    order = np.argsort(-bounds, axis=1, kind="stable")
    alive, done = np.arange(len(q)), 0
    for turn in range(len(blocks)):
        at = order[alive, turn]
        alive = alive[bounds[alive, at] >= best.kth()[alive]]  # equal bounds may hold a smaller vec_id
        if not len(alive):
            break
        at = order[alive, turn]
        for b in np.unique(at).tolist():
            rows = alive[at == b]
            ids = np.asarray(blocks[b]["ids"], np.int64)
            x = _matrix(blocks[b]["vectors"], len(ids))
            best.add(rows, _exact(q[rows], x), ids)
            done += len(rows) * len(ids)
    return done


def _pass(blocks: DataFrame, ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray) -> DataFrame:
    """(query_no, vec_id, score): each task's best k for each query of the chunk."""
    shared = blocks.sparkSession.sparkContext.broadcast((ids, q, floor))

    def make():
        ids, q, floor = shared.value

        def step(b):
            best = Best(ids, k, floor)
            rows = b.to_pylist()
            if rows:
                search_blocks(rows, q, best)
            real = (best.ids < np.iinfo(np.int64).max) & (best.score >= floor[:, None])
            no = np.broadcast_to(np.arange(len(ids))[:, None], real.shape)
            return {"query_no": no[real], "vec_id": best.ids[real], "score": best.score[real]}
        return step

    return map_rows(blocks.select("ids", "vectors", "high", "low"), make, "query_no int, vec_id long, score long")


def top_k(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose id is divisible by ``every``, the k best others."""
    spark = table.sparkSession
    ship(spark)
    rows = whole_vectors(table, id_col, vec_col)
    results = None
    for r in rows.groupBy(F.size("v").alias("n")).count().orderBy("n").collect():  # a row for each length
        out = _top_k_of_length(rows.where(F.size("v") == r.n), k, every)
        results = out if results is None else results if out is None else results.unionByName(out)
    if results is None:
        return spark.range(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score"))
    return results


def _top_k_of_length(rows: DataFrame, k: int, every: int) -> DataFrame | None:
    """The result for vectors of one length; none without queries."""
    blocks = materialize(_blocks(rows), "topk-blocks")
    queries = materialize(rows.where(F.col("vec_id") % every == 0).withColumn(
        "chunk", F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, -(-rows.where(F.col("vec_id") % every == 0).count() // (QUERY_CHUNK // 2)))))),
        "topk-queries")
    seed_rows = blocks.orderBy("part").limit(2).collect()  # two blocks
    results = None
    for chunk in sorted(r.chunk for r in queries.select("chunk").distinct().collect()):
        found = queries.where(F.col("chunk") == chunk).orderBy("vec_id", "v").collect()  # QUERY_CHUNK rows, about half that
        for a in range(0, len(found), QUERY_CHUNK):
            part = found[a:a + QUERY_CHUNK]
            ids = np.array([r.vec_id for r in part], np.int64)
            q = np.array([r.v for r in part], np.int64)
            seed = Best(ids, k)
            for b in seed_rows:
                x = np.asarray(b["ids"], np.int64)
                seed.add(np.arange(len(ids)), _exact(q, _matrix(bytes(b["vectors"]), len(x))), x)
            best = Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
            hits = _pass(blocks, ids, q, k, seed.score[:, -1].copy())
            hits = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            # a chunk's query numbers as vec_ids, without a lookup table
            number = F.element_at(F.lit(ids.tolist()), F.col("query_no") + 1)
            out = materialize(hits.select(number.alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "topk-part")
            results = out if results is None else results.unionByName(out)
    drop_materialized(queries)
    return results


SQL = """
WITH v AS (SELECT vec_id::BIGINT AS vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
