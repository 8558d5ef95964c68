"""Matrix factorisation by stratified stochastic gradient descent (H2).

Model: ``mu + b_u + b_i + q_i . p_u``. Every epoch visits every rating once and steps, with
error e = stars - estimate, rate ``lr`` and penalty ``reg``:
``b_u += lr (e - reg b_u)``, ``b_i += lr (e - reg b_i)``, ``p_u += lr (e q_i - reg p_u)`` and
``q_i += lr (e p_u - reg q_i)`` with the old p_u. Biases start at 0, factors at small normal
deviates that are a rule of the id.

How it runs on Spark. Users and items are dealt into ``blocks`` blocks each by a hash, and so
are the ratings, into blocks x blocks cells (a cell is one written group). An epoch is
``blocks`` strata: stratum s holds the cells (user block a, item block (a + s) mod blocks),
which share neither users nor items, so its cells run at the same time and give what running
them one after another would give. A stratum is one cogroup of the cells with the user and
item parameters that they need. A cell's steps follow the fixed order of a hash of (epoch,
user, item) and are taken in groups that share neither users nor items. So the result is that
of one serial run in the order (epoch, stratum, user block, hash). It depends on ``blocks`` as
a parameter, and not on the cluster, the number of partitions or the dealing of rows; more
blocks are a different order of the same steps.

Blocks should be large enough that a cell and its parameters fit in a task: the ratings of a
cell are about all / blocks^2. A user with a third of all ratings is spread over the item
blocks, a cell then holds at most that share divided by ``blocks``; ``fit`` chooses ``blocks``
from the count of ratings and ``CELL_RATINGS``, and looks at the largest cell as well.

Prediction: an unknown side drops its terms; the estimate is clamped to the rating scale.
Defined cases: ratings without user, item or stars take no part; a pair rated more than once
is stepped once for each row; without ratings the estimate is null.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.functions.columns import attach_row, clamp
from sparkrec.session import drop_materialized, materialize, ship

CELL_RATINGS = 2_000_000
ONE_CELL = 50_000  # no more than this is left undivided
AT_ONCE = 256  # steps of a wave taken together: their factors stay in a core's cache
INIT_STD = 0.1


@dataclass(frozen=True)
class Params:
    """Rates as in the reference; the number of factors is its library's default."""

    rank: int = 100
    epochs: int = 25
    lr: float = 0.01
    reg: float = 0.2
    blocks: int = 0  # 0: from the number of ratings
    seed: int = 0


@dataclass
class Model:
    mean: DataFrame    # global_mean (one row)
    users: DataFrame   # user_id, b, v
    items: DataFrame   # item_id, b, v


def start_factors(ident: str, side: str, rank: int, seed: int) -> np.ndarray:
    """Normal deviates by a rule of the id: the same wherever they are made."""
    key = int.from_bytes(hashlib.blake2b(f"{seed}:{side}:{ident}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return np.random.default_rng(key).standard_normal(rank) * INIT_STD


def waves(u: np.ndarray, i: np.ndarray) -> list[np.ndarray]:
    """Ratings in groups that share neither user nor item, each after all earlier ones that it shares one with.

    Steps of a group touch different parameters, so they can be taken at once and give what the serial order gives.
    """
    next_u, next_i = [0] * (int(u.max(initial=-1)) + 1), [0] * (int(i.max(initial=-1)) + 1)
    wave = []
    for a, b in zip(u.tolist(), i.tolist(), strict=True):
        w = max(next_u[a], next_i[b])
        next_u[a] = next_i[b] = w + 1
        wave.append(w)
    order = np.argsort(np.array(wave, np.int64), kind="stable")
    return np.split(order, np.cumsum(np.bincount(wave))[:-1]) if wave else []


def steps(u: np.ndarray, i: np.ndarray, stars: np.ndarray, mean: float, bu, bi, pu, qi, p: Params) -> None:
    """The steps of ratings in their order (indices into the parameter arrays, which are changed in place)."""
    lr, reg = p.lr, p.reg
    for wave in waves(u, i):
        for lo in range(0, len(wave), AT_ONCE):
            w = wave[lo:lo + AT_ONCE]
            a, b = u[w], i[w]
            x, y = pu[a], qi[b]
            e = stars[w] - (mean + bu[a] + bi[b] + np.einsum("ij,ij->i", x, y))
            bu[a] += lr * (e - reg * bu[a])
            bi[b] += lr * (e - reg * bi[b])
            e = (lr * e)[:, None]
            pu[a] = (1 - lr * reg) * x + e * y
            qi[b] = (1 - lr * reg) * y + e * x


def _packed(x: np.ndarray) -> pa.BinaryArray:
    """The bytes of each row: factors move and are written as they lie, not number by number."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * 8)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(x, float).tobytes())])


def _unpacked(column: pa.Array) -> np.ndarray:
    """``_packed`` back, as one long array that may be changed."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].copy().view(float) if len(column) else np.empty(0)


def _as_lists(params: DataFrame) -> DataFrame:
    """(id, b, v) with v as a list."""
    def run(batches):
        for b in batches:
            v = _unpacked(b.column("v"))
            ends = np.linspace(0, len(v), b.num_rows + 1).round().astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("b"), pa.ListArray.from_arrays(pa.array(ends), pa.array(v))], names=["id", "b", "v"])

    return params.select("id", "b", "v").mapInArrow(run, f"id {params.schema['id'].dataType.simpleString()}, b double, v array<double>")


def _start(ids: DataFrame, name: str, p: Params) -> DataFrame:
    """(side, block, id, b, v) of one side at the start."""
    rank, seed = p.rank, p.seed

    def run(batches):
        for b in batches:
            found = np.empty((b.num_rows, rank))
            for n, x in enumerate(b.column("key").to_pylist()):
                found[n] = start_factors(x, name, rank, seed)
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("id"), pa.array(np.zeros(b.num_rows)), _packed(found)],
                                             names=["block", "id", "b", "v"])

    kind = ids.schema["id"].dataType.simpleString()
    return ids.withColumn("key", F.col("id").cast("string")).mapInArrow(run, f"block int, id {kind}, b double, v binary")


def _block(col: str, blocks: int, seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), F.col(col).cast("string")), F.lit(blocks)).cast("int")


def choose_blocks(ratings: DataFrame, p: Params) -> int:
    """Blocks for which the mean cell holds ``CELL_RATINGS`` at most, doubled while the largest holds more than four times as many.

    A cell of a single hot pair of blocks shrinks with both counts until one user and one item block hold one id each.
    """
    if p.blocks:
        return p.blocks
    n = ratings.count()
    blocks = max(2 if n > ONE_CELL else 1, int(np.ceil(np.sqrt(n / CELL_RATINGS))))
    while blocks > 1:
        cells = ratings.groupBy(_block("user_id", blocks, p.seed).alias("a"), _block("item_id", blocks, p.seed + 1).alias("b")).count()
        if cells.agg(F.max("count").alias("m")).first().m <= 4 * CELL_RATINGS or blocks >= 1024:
            break
        blocks *= 2
    return blocks


def fit(train: DataFrame, params: Params | None = None) -> Model:
    """Biases and factors of every user and item, as written tables."""
    p = params or Params()
    ship(train.sparkSession)
    rows = train.select("user_id", "item_id", F.col("stars").cast("double").alias("stars")).dropna()
    blocks = choose_blocks(rows, p)
    cells = materialize(rows.select(_block("user_id", blocks, p.seed).alias("ub"), _block("item_id", blocks, p.seed + 1).alias("ib"),
                                    "user_id", "item_id", "stars"), "sgd-cells")
    mean = materialize(cells.agg(F.avg("stars").alias("global_mean")), "sgd-mean")
    mu = mean.first().global_mean

    def ids(block: str, col: str) -> DataFrame:
        return cells.select(F.col(block).alias("block"), F.col(col).alias("id")).distinct()

    users = materialize(_start(ids("ub", "user_id"), "u", p), "sgd-users")
    items = materialize(_start(ids("ib", "item_id"), "i", p), "sgd-items")
    if mu is not None:
        for epoch in range(p.epochs):
            for s in range(blocks):
                new_users, new_items = _stratum(cells, users, items, epoch, s, blocks, mu, p)
                drop_materialized(users)
                drop_materialized(items)
                users, items = new_users, new_items
    drop_materialized(cells)
    return Model(mean, *(_as_lists(t).withColumnRenamed("id", name) for t, name in ((users, "user_id"), (items, "item_id"))))


def _stratum(cells: DataFrame, users: DataFrame, items: DataFrame, epoch: int, s: int, blocks: int, mu: float, p: Params) -> tuple[DataFrame, DataFrame]:
    """The parameters after the cells (a, (a + s) mod blocks), each cell a task of its own."""
    u_kind, i_kind = (t.schema["id"].dataType.simpleString() for t in (users, items))
    here = cells.where(F.col("ib") == F.pmod(F.col("ub") + s, F.lit(blocks))).select(
        F.col("ub").alias("cell"), "user_id", "item_id", "stars", F.xxhash64(F.lit(epoch), F.col("user_id").cast("string"), F.col("item_id").cast("string")).alias("turn"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("item_id", i_kind), ("b", "double"), ("v", "binary"))]
    known = users.select(F.col("block").alias("cell"), F.col("id").alias("user_id"), nothing[0], "b", "v").unionByName(
        items.select(F.pmod(F.col("block") - s, F.lit(blocks)).cast("int").alias("cell"), F.lit(None).cast(u_kind).alias("user_id"), F.col("id").alias("item_id"), "b", "v"))
    schema = f"cell int, user_id {u_kind}, item_id {i_kind}, b double, v binary"

    def run(key, rated, given):
        is_user = given.column("user_id").is_valid().to_numpy()
        order = np.r_[np.flatnonzero(is_user), np.flatnonzero(~is_user)]
        given, n = given.take(pa.array(order)), int(is_user.sum())
        u_ids, i_ids = given.column("user_id").slice(0, n).combine_chunks(), given.column("item_id").slice(n).combine_chunks()
        bias = given.column("b").to_numpy().copy()
        factors = _unpacked(given.column("v").combine_chunks()).reshape(len(bias), -1)
        rated = rated.sort_by([("turn", "ascending"), ("stars", "ascending")])
        u, i = (pc.index_in(rated.column(c), value_set=ids).to_numpy().astype(np.int64) for c, ids in (("user_id", u_ids), ("item_id", i_ids)))
        steps(u, i, rated.column("stars").to_numpy(), mu, bias[:n], bias[n:], factors[:n], factors[n:], p)
        cols = [pa.array(np.full(len(bias), key[0].as_py(), np.int32)), given.column("user_id"), given.column("item_id"), pa.array(bias), _packed(factors)]
        return pa.table(cols, names=["cell", "user_id", "item_id", "b", "v"])

    done = materialize(here.groupBy("cell").cogroup(known.groupBy("cell")).applyInArrow(run, schema), "sgd-stratum")
    new_users = done.where(F.col("user_id").isNotNull()).select(F.col("cell").alias("block"), F.col("user_id").alias("id"), "b", "v")
    new_items = done.where(F.col("user_id").isNull()).select(F.pmod(F.col("cell") + s, F.lit(blocks)).cast("int").alias("block"), F.col("item_id").alias("id"), "b", "v")
    new_users._sparkrec_path = done._sparkrec_path  # one table holds both sides
    return new_users, new_items


def predict(m: Model, cand: DataFrame, clamp_range=(1.0, 5.0)) -> DataFrame:
    """(user_id, item_id, prediction) of the distinct pairs."""
    pairs = cand.select("user_id", "item_id").distinct()
    j = (attach_row(pairs, m.mean)
         .join(m.users.select("user_id", F.col("b").alias("bu"), F.col("v").alias("pu")), "user_id", "left")
         .join(m.items.select("item_id", F.col("b").alias("bi"), F.col("v").alias("qi")), "item_id", "left"))
    dot = F.aggregate(F.zip_with("pu", "qi", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    pred = F.col("global_mean") + F.coalesce("bu", F.lit(0.0)) + F.coalesce("bi", F.lit(0.0)) + F.coalesce(dot, F.lit(0.0))
    if clamp_range is not None:
        pred = clamp(pred, *clamp_range)
    return j.select("user_id", "item_id", pred.alias("prediction"))
