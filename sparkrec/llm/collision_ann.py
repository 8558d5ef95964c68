"""Approximate nearest neighbours by counting collisions of query-centred windows.

Vectors of one length are dealt into shards of bounded size. Each of ``PROJECTIONS``
random directions (a rule of the length, the same in every task) gives a shard a sorted
array: the order of its vectors along that direction. A query's window on an array is
centred on the query's own projection, so no bucket borders are fixed in advance. Windows
have half-width ``HALF_WIDTH`` x r on every array; virtual rehashing widens r in steps,
and each step reads only what the windows gained on both sides. A vector that has been
read in ``threshold()`` windows is verified: its exact distance is taken. The search of a
shard ends when r reaches the query's k-th best distance, since every vector within r has
then collided often enough but for a known probability: a projection of a difference of
length r is normal with deviation r, so it stays in its window with probability
p = 2 Phi(HALF_WIDTH) - 1, independently on each array, and ``threshold()`` is the largest
count that a Binomial(PROJECTIONS, p) reaches with probability ``CERTAINTY``. Nearer vectors
collide more often. There is no cap on verified vectors.

Each query starts with a bound on its k-th best distance from one shard of its length
(a stated number of rows, used for the bound only); r starts at a share of it and never
passes it. Queries are a stated set that grows with the table: they are dealt into chunks
of bounded size, and every chunk meets every shard of its length through a join (chunks up
to ``BROADCAST_BYTES`` are broadcast, more are shuffled to salted groups of shards).

Distances are Euclidean, in doubles, of the original vectors. Defined cases: vectors that
are null, empty, zero, or hold null or non-finite components take no part; vectors of each
length are searched among their own; equal distances go to the smaller vec_id; equal rows
of a vec_id are each a candidate, while a query never meets rows of its own vec_id; rows of
a query's vec_id with different vectors are queries that share their ranks; fewer
candidates than k are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import drop_materialized, map_rows, materialize, ship, shuffle_parts

PROJECTIONS = 64
HALF_WIDTH = 1.0
CERTAINTY = 0.98
START, STEP = 0.5, 1.25  # of the bound; growth of r
SHARD_ROWS = 2048
CHUNK_ROWS = 4096
BROADCAST_BYTES = 8 << 20
OPEN_CHUNKS = 16  # chunks whose bounds a task holds at a time
SEED = 20_240


@functools.cache
def threshold(projections: int = PROJECTIONS, half_width: float = HALF_WIDTH, certainty: float = CERTAINTY) -> int:
    """The largest count that a vector at distance r reaches with the given probability."""
    p = math.erf(half_width / math.sqrt(2))
    below = 0.0
    for c in range(projections + 1):
        below += math.comb(projections, c) * p**c * (1 - p) ** (projections - c)
        if 1 - below < certainty:
            return c
    return projections


@functools.cache
def directions(dim: int) -> np.ndarray:
    """(dim, PROJECTIONS) normal deviates, the same for every task."""
    return np.random.default_rng([SEED, dim]).standard_normal((dim, PROJECTIONS))


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of one vector to rows, also where squares would leave the range of doubles."""
    d = x - q
    most = np.abs(d).max(axis=1, initial=0.0)
    odd = (most > 1e150) | ((most < 1e-140) & (most > 0))
    if not odd.any():
        return np.sqrt((d * d).sum(axis=1))
    scale = np.where(odd, most, 1.0)
    d = d / scale[:, None]
    return scale * np.sqrt((d * d).sum(axis=1))


# ---------------------------------------------------------------- index


def vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>, dim) of the vectors that take part."""
    v = F.col(vec_col)
    good = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = table.where(good).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: x.cast("double")).alias("v"))
    return rows.where(F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def build_index(rows: DataFrame) -> DataFrame:
    """Written rows (dim, part, ids, copies, vectors, order): a shard's vectors and their order along each direction."""
    schema = "dim int, part long, ids array<long>, copies array<long>, vectors binary, order binary"
    ship(rows.sparkSession)

    def run(key, t):
        t = t.sort_by("vec_id")
        dim = key[0].as_py()
        x = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        order = np.argsort(x @ directions(dim), axis=0, kind="stable").T.astype(np.int32)
        return pa.table([pa.array([dim], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([t.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                         pa.array([t.column("copies").to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary()),
                         pa.array([np.ascontiguousarray(order).tobytes()], pa.binary())],
                        names=["dim", "part", "ids", "copies", "vectors", "order"])

    # equal rows are one with a count, combined before the shuffle; so no key is hot
    once = materialize(rows.groupBy("vec_id", "v", "dim").agg(F.count("*").alias("copies")), "ann-rows")
    tasks = max(shuffle_parts(rows.sparkSession), once.count() // (8 * SHARD_ROWS))
    sizes = once.groupBy("dim").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("parts"))
    dealt = once.join(sizes, "dim").withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")))
    dealt = dealt.select("vec_id", "v", "copies", "dim", "part").repartition(tasks, "dim", "part")
    out = materialize(dealt.groupBy("dim", "part").applyInArrow(run, schema), "ann-index")
    drop_materialized(once)
    return out


class Shard:
    """Sorted arrays over a shard's vectors."""

    def __init__(self, dim: int, ids, copies, vectors: bytes, order: bytes):
        self.ids, self.copies = np.asarray(ids, np.int64), np.asarray(copies, np.int64)
        self.x = np.frombuffer(vectors, np.float64).reshape(len(self.ids), dim)
        self.order = np.frombuffer(order, np.int32).reshape(PROJECTIONS, -1).astype(np.intp)
        self.along = np.take_along_axis((self.x @ directions(dim)).T, self.order, axis=1)
        self.wild = not np.isfinite(self.along).all()  # sums beyond doubles: such a shard is verified whole
        # two equal vectors may differ in the last bits of their projections
        self.slack = 1e-9 * (np.abs(self.along).max(initial=0.0) + 1.0)


class Finding:
    """One query's search of one shard: windows read so far, collisions, verified vectors and the best of them."""

    def __init__(self, shard: Shard, query_id: int, q: np.ndarray, at: np.ndarray, bound: float, k: int):
        self.shard, self.q, self.at, self.k, self.kth = shard, q, at, k, bound
        self.counts = np.zeros(len(shard.ids), np.int16)
        self.checked = shard.ids == query_id
        self.d, self.places, self.verified = np.zeros(0), np.zeros(0, np.int64), 0
        if math.isfinite(bound):
            self.r = bound * START
        else:  # wide enough for some k vectors on half of the arrays
            gaps = np.sort(np.abs(shard.along - at[:, None]), axis=1)
            self.r = float(np.median(gaps[:, min(k, len(shard.ids)) - 1]))
        self.low = self.high = None
        if shard.wild or not np.isfinite(at).all():
            self.counts[:], self.kth, self.r = threshold(), 0.0, math.inf

    def widen(self, low: np.ndarray, high: np.ndarray) -> bool:
        """Reads what the windows gained, verifies new vectors over the threshold; whether r must grow further."""
        order, need = self.shard.order, threshold()
        if self.low is None:
            self.low = self.high = low
        read = [order[i, a:b] for i, (a, b) in enumerate(zip(low.tolist(), self.low.tolist(), strict=True)) if a < b]
        read += [order[i, a:b] for i, (a, b) in enumerate(zip(self.high.tolist(), high.tolist(), strict=True)) if a < b]
        self.low, self.high = low, high
        if read:
            self.counts += np.bincount(np.concatenate(read), minlength=len(self.counts)).astype(np.int16)
        over = self.counts >= need
        fresh = np.flatnonzero(over & ~self.checked)
        if len(fresh):
            self.checked |= over
            self.verified += len(fresh)
            d, i = np.concatenate([self.d, distances(self.q, self.shard.x[fresh])]), np.concatenate([self.places, fresh])
            top = np.lexsort((self.shard.ids[i], d))[:self.k]
            self.d, self.places = d[top], i[top]
            if len(top) == self.k:
                self.kth = min(self.kth, float(self.d[-1]))
        if self.r >= self.kth or over.all():
            return False
        self.r = min(self.r * STEP, self.kth) if self.r else self.kth
        return True


def search_shard(shard: Shard, query_ids, q: np.ndarray, bounds, k: int) -> list[Finding]:
    """Every query's finding: the queries' windows are placed together, array by array, step by step."""
    at = q @ directions(q.shape[1])
    found = [Finding(shard, i, v, p, b, k) for i, v, p, b in zip(query_ids, q, at, bounds, strict=True)]
    alive = np.arange(len(found))
    while len(alive):
        reach = np.array([found[j].r for j in alive]) * HALF_WIDTH + shard.slack
        low = np.array([a.searchsorted(c - reach, "left") for a, c in zip(shard.along, at[alive].T, strict=True)]).T
        high = np.array([a.searchsorted(c + reach, "right") for a, c in zip(shard.along, at[alive].T, strict=True)]).T
        alive = np.array([j for n, j in enumerate(alive.tolist()) if found[j].widen(low[n], high[n])], np.int64)
    return found


# ---------------------------------------------------------------- search


def _chunks(rows: DataFrame, every: int) -> tuple[DataFrame, int, int]:
    """Written (dim, chunk, ids, q) of the queries, the largest number of chunks of a length, and bytes."""
    schema = "dim int, chunk long, ids array<long>, q binary"
    ship(rows.sparkSession)

    def run(key, t):
        t = t.sort_by("vec_id")
        x = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([t.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                         pa.array([x.tobytes()], pa.binary())], names=["dim", "chunk", "ids", "q"])

    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    sizes = asked.groupBy("dim").agg(F.ceil(F.count("*") / CHUNK_ROWS).alias("n"))
    dealt = asked.join(sizes, "dim").withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), F.col("n")))
    out = materialize(dealt.select("vec_id", "v", "dim", "chunk").groupBy("dim", "chunk").applyInArrow(run, schema), "ann-queries")
    size = out.agg(F.max("chunk").alias("n"), F.sum(F.octet_length("q") + 8 * F.size("ids")).alias("b")).first()
    return out, (size.n or 0) + 1, size.b or 0


def _bounds(chunks: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """chunks with each query's k-th distance within one shard of its length."""
    first = index.where(F.col("part") == F.col("least")).select("dim", F.col("ids").alias("x_ids"), F.col("copies").alias("x_copies"), F.col("vectors").alias("x"))

    def make():
        def step(b):
            out = {c: [] for c in ("dim", "chunk", "ids", "q", "bounds")}
            for row in b.to_pylist():
                dim = row["dim"]
                x, ids, copies = np.frombuffer(row["x"], np.float64).reshape(-1, dim), np.asarray(row["x_ids"]), np.asarray(row["x_copies"])
                bounds = []
                for i, v in zip(row["ids"], np.frombuffer(row["q"], np.float64).reshape(-1, dim), strict=True):
                    d = np.sort(np.repeat(distances(v, x), np.minimum(copies, k) * (ids != i)))
                    bounds.append(float(d[k - 1]) if len(d) >= k else math.inf)
                for c, v in (("dim", dim), ("chunk", row["chunk"]), ("ids", row["ids"]), ("q", row["q"]), ("bounds", bounds)):
                    out[c].append(v)
            return out
        return step

    return map_rows(chunks.join(first, "dim"), make, "dim int, chunk long, ids array<long>, q binary, bounds array<double>")


def _paired(index: DataFrame, chunks: DataFrame, n_chunks: int, n_bytes: int) -> DataFrame:
    """Every chunk beside every shard of its length."""
    def up_to(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    if n_bytes <= BROADCAST_BYTES:
        return index.join(F.broadcast(chunks.withColumnRenamed("ids", "query_ids")), "dim")
    groups = 4 * shuffle_parts(index.sparkSession)
    shards = index.withColumn("chunk", up_to(n_chunks)).withColumn("group", F.pmod(F.xxhash64("dim", "part"), F.lit(groups)))
    return shards.join(chunks.withColumnRenamed("ids", "query_ids").withColumn("group", up_to(groups)).hint("merge"), ["dim", "chunk", "group"])


def search(index: DataFrame, queries: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for rows of ``queries`` whose id is divisible by ``every``."""
    ship(index.sparkSession)
    chunks, n_chunks, n_bytes = _chunks(queries, every)
    least = index.groupBy("dim").agg(F.min("part").alias("least"))
    asked = materialize(_bounds(chunks, index.join(least, "dim"), k), "ann-asked")

    def make():
        held: dict = {}

        def step(b):
            out = {c: [] for c in ("query_id", "vec_id", "score")}
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                dim = row["dim"]
                shard = Shard(dim, row["ids"], row["copies"], row["vectors"], row["order"])
                q = np.frombuffer(row["q"], np.float64).reshape(-1, dim)
                key = (dim, row["chunk"])
                if key not in held:  # k-th bests of a few chunks, tightened from shard to shard
                    if len(held) == OPEN_CHUNKS:
                        held.pop(next(iter(held)))
                    held[key] = row["bounds"]
                bounds = held[key]
                for j, f in enumerate(search_shard(shard, row["query_ids"], q, bounds, k)):
                    many = np.repeat(np.arange(len(f.d)), np.minimum(shard.copies[f.places], k))[:k]
                    if len(many) == k:
                        bounds[j] = min(bounds[j], float(f.d[many[-1]]))
                    out["query_id"] += [row["query_ids"][j]] * len(many)
                    out["vec_id"] += shard.ids[f.places[many]].tolist()
                    out["score"] += f.d[many].tolist()
            return out
        return step

    hits = map_rows(_paired(index, asked, n_chunks, n_bytes), make, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    found = materialize(ranked, "ann-found")
    for t in (chunks, asked):
        drop_materialized(t)
    return found


def nearest(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The table's rows of ids divisible by ``every`` against all others, through an index that is deleted again."""
    rows = vectors(table, id_col, vec_col)
    index = build_index(rows)
    found = search(index, rows, k, every)
    drop_materialized(index)
    return found
