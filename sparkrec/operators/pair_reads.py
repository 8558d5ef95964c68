"""Sums of item pairs, and the reading of pairs' statistics for candidates, over arrays in tasks.

A candidate (u, t) reads the statistics of t with each item j that u rated. Row by row, that is a shuffled row for each (u, t, j).
Here items are numbered with the rarest first (``numbered``), and a target travels as one row with the array of u's rated items
behind it in this order, a rated item with the array of u's targets behind it (``asks``). So each pair is met where its rarer item
is dealt, where the statistics of that item's pairs are too (``read``), and what was found goes back to the user as arrays.
Lists are cut into pieces of ``PIECE``, an item of many rows is dealt over several cells with a copy of its statistics each, and
a task's share follows the number of pairs, so what a task holds is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sparkrec.operators.baselines import dense_index
from sparkrec.session import drop_materialized, materialize, ship

PIECE = 128           # longer lists of one user are cut
CHUNK = 1 << 18       # pairs expanded at once
CELL_PAIRS = 500_000
HOT_ROWS = 1 << 16    # an item of more rows is dealt over several cells
SUMS = ["n", "a", "b", "ab", "aa", "bb"]


def flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The lengths of a batch's lists, and all their values."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), column.flatten()


def lists(n: np.ndarray, values: np.ndarray | pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(values))


# ---------------------------------------------------------------- sums of pairs


def _grouped(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (k, o, sums...) added up by (k, o)."""
    order = np.lexsort((cols[1], cols[0]))
    k, o = cols[0][order], cols[1][order]
    first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (o[1:] != o[:-1])]) if len(k) else np.empty(0, np.int64)
    return [k[first], o[first], *(np.add.reduceat(c[order], first) if len(first) else c for c in cols[2:])]


def _pairs_of(k: np.ndarray, k_v, n: np.ndarray, o: np.ndarray, o_v) -> list[np.ndarray]:
    """(k, o, n, a, b, ab, aa, bb) and how many values are behind a, b and ab, since a sum of nulls only is null."""
    known_k, known_o = (np.asarray(x.is_valid()) for x in (k_v, o_v))
    known_k = np.repeat(known_k, n)
    x, y = (v.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for v in (k_v, o_v))
    most = max(np.abs(x).max(initial=0), np.abs(y).max(initial=0))
    if float(most) ** 2 * max(1, len(o)) >= 2.0**62:
        raise OverflowError("ratings are too large for sums of their squares")
    x, both = np.repeat(x, n), known_k & known_o
    xy, xx, yy = x * y, x * x, y * y
    return _grouped([np.repeat(k, n), o, np.ones(len(o), np.int64), x, y, xy, xx, yy, *(c.astype(np.int64) for c in (known_k, known_o, both))])


def sums_by_arrays(rows: DataFrame, tasks: int) -> DataFrame:
    """(k, o, n, a, b, ab, aa, bb) of rows (k, k_v, es, vs): k's value with each of vs, those of es; whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[np.ndarray] | None = None
        waiting: list[list[np.ndarray]] = []

        def added():
            return _grouped([np.concatenate(c) for c in zip(*([done] if done else []), *waiting, strict=True)])

        for b in batches:
            if not b.num_rows:
                continue
            n, o = flat(b.column("es"))
            _, o_v = flat(b.column("vs"))
            o = o.to_numpy(zero_copy_only=False).astype(np.int64)
            k, k_v, ends, lo = b.column("k").to_numpy(zero_copy_only=False).astype(np.int64), b.column("k_v"), np.cumsum(n), 0
            while lo < b.num_rows:
                before = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
                upto = int(ends[hi - 1])
                waiting.append(_pairs_of(k[lo:hi], k_v.slice(lo, hi - lo), n[lo:hi], o[before:upto], o_v.slice(before, upto - before)))
                lo = hi
                if sum(len(w[0]) for w in waiting) > max(CHUNK, len(done[0]) if done else 0):
                    done, waiting = added(), []
        if waiting:
            done = added()
        for lo in range(0, len(done[0]) if done else 0, 1 << 16):
            k, o, n, a, b_, ab, aa, bb, of_a, of_b, of_ab = (c[lo:lo + (1 << 16)] for c in done)
            out = [pa.array(c, pa.int64(), mask=m == 0) for c, m in ((a, of_a), (b_, of_b), (ab, of_ab), (aa, of_a), (bb, of_b))]
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(o), pa.array(n), *out], names=["k", "o", *SUMS])

    ship(rows.sparkSession)
    return rows.repartition(tasks, "k").mapInArrow(run, ", ".join(f"{c} bigint" for c in ["k", "o", *SUMS]))


# ---------------------------------------------------------------- what candidates read


@dataclass
class Numbered:
    items: DataFrame    # item_id, at (rarest first), pos (by id), _deg
    ratings: DataFrame  # user_id, at, pos, stars; at and pos are -1 for a null item
    n_items: int

    def by_number(self) -> DataFrame:
        """The ratings of items with an id, (user_id, item_id, stars), where item_id is ``at``."""
        return self.ratings.filter(F.col("at") >= 0).select("user_id", F.col("at").alias("item_id"), "stars")

    def drop(self) -> None:
        drop_materialized(self.items)
        drop_materialized(self.ratings)


def numbered(train: DataFrame) -> Numbered:
    degree = train.filter(F.col("item_id").isNotNull()).groupBy("item_id").agg(F.count(F.lit(1)).alias("_deg"))
    degree = materialize(degree.select("item_id", "_deg", F.struct("_deg", "item_id").alias("_k")), "pair-degrees")
    items = degree.join(dense_index(degree, "_k", "at"), "_k").join(dense_index(degree, "item_id", "pos"), "item_id")
    items = materialize(items.select("item_id", "at", "pos", "_deg"), "pair-items")
    drop_materialized(degree)
    rows = train.select("user_id", "item_id", F.col("stars").cast("double").alias("stars")).join(items.select("item_id", "at", "pos"), "item_id", "left")
    none = F.lit(-1).cast("long")
    rows = materialize(rows.select("user_id", F.coalesce("at", none).alias("at"), F.coalesce("pos", none).alias("pos"), "stars"), "pair-ratings")
    return Numbered(items, rows, items.count())


def _lists(rows: DataFrame, entry, name: str) -> DataFrame:
    """(user_id, name_piece, name): each user's rows, in pieces where a user has more than ``PIECE``."""
    rows = rows.filter(F.col("user_id").isNotNull())
    most = rows.groupBy("user_id").count().agg(F.max("count")).first()[0] or 0
    piece = F.floor((F.row_number().over(Window.partitionBy("user_id").orderBy("at")) - 1) / PIECE) if most > PIECE else F.lit(0)
    return rows.withColumn("_piece", piece.cast("int")).groupBy("user_id", "_piece").agg(F.collect_list(entry).alias(name)).withColumnRenamed("_piece", f"{name}_piece")


def _cross(n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with lists of n and of m values: indices into both flat lists, for each value of the first with each of the second."""
    size = np.repeat(m, n)  # for each value of the first
    start = np.repeat(np.cumsum(m) - m, n)
    before = np.cumsum(size) - size
    one = np.repeat(np.arange(len(size)), size)
    return one, np.arange(size.sum()) - before[one] + start[one]


def _asks(own: bool) -> Callable:
    """Rows (user_id, asked, rated) as rows of a target or rated item (k) with what lies behind it (es); ``own``: with the ratings
    and places by id of the rated items too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = flat(b.column("asked"))[0], flat(b.column("rated"))[0]
            ends, lo = np.cumsum(n * m), 0
            while lo < b.num_rows:
                before = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
                for out in _asks_of(b.slice(lo, hi - lo)):
                    yield out if own else out.drop_columns(["rs", "ps"])
                lo = hi
    return run


def _asks_of(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    n, t = flat(b.column("asked"))
    m, rated = flat(b.column("rated"))
    t = t.to_numpy(zero_copy_only=False)
    j, pos = (rated.field(c).to_numpy(zero_copy_only=False) for c in ("at", "pos"))
    r = rated.field("stars")
    row_t, row_j = np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)

    def batch(rows, k, mine, size, es, rs, ps):
        keep = size > 0
        return pa.RecordBatch.from_arrays([b.column("user_id").take(pa.array(rows[keep])), b.column("asked_piece").take(pa.array(rows[keep])), pa.array(k[keep]),
                                           pa.array(np.full(int(keep.sum()), mine)), lists(size[keep], es.astype(np.int32)), rs(keep), ps(keep)],
                                          names=["user_id", "p", "k", "mine", "es", "rs", "ps"])

    # a target with the rated items behind it; a null item (-1) counts as the target itself
    one, two = _cross(n, m)
    behind = (j[two] < 0) | (j[two] >= t[one])
    one, two = one[behind], two[behind]
    size = np.bincount(one, minlength=len(t))
    yield batch(row_t, t, True, size, np.where(j[two] < 0, t[one], j[two]), lambda keep: lists(size[keep], r.take(pa.array(two))), lambda keep: lists(size[keep], pos[two].astype(np.int32)))
    # a rated item with the targets behind it
    one, two = _cross(m, n)
    behind = (j[one] >= 0) & (t[two] > j[one])
    one, two = one[behind], two[behind]
    of = np.bincount(one, minlength=len(j))
    yield batch(row_j, j, False, of, t[two], lambda keep: lists(np.ones(int(keep.sum()), np.int64), r.filter(pa.array(keep))),
                lambda keep: lists(np.ones(int(keep.sum()), np.int64), pos[keep].astype(np.int32)))


def read(given: Numbered, known: DataFrame, stats: DataFrame, values: list[str], found: Callable, schema: str, own: bool = True) -> DataFrame:
    """What the candidates ``known`` (user_id, at) read from ``stats`` (x, y, values; x <= y by number, one row for each pair).

    ``found(asked, at, values)`` makes the table of a cell's answer (``schema``): ``asked`` has user_id, p (the piece of the user's
    targets; each target is in one), and flat arrays of the pairs with statistics, ``at`` the row of ``asked`` for each. With
    ``own`` they have the user's rating of the rated item and its place by id, -1 for a null item.
    """
    if given.n_items >= 1 << 31:
        raise ValueError("items are numbered with 32 bits")
    spark = known.sparkSession
    ship(spark)
    user = known.schema["user_id"].dataType.simpleString()
    asked = materialize(known.select("user_id", "at"), "pair-asked")
    load = given.items.select("at", "_deg").join(asked.groupBy("at").agg(F.count(F.lit(1)).alias("_c")), "at", "left")
    hot = load.select(F.col("at").alias("k"), F.ceil((F.col("_deg") + F.coalesce("_c", F.lit(0))) / HOT_ROWS).cast("int").alias("ways")).filter("ways > 1")
    hot = materialize(hot, "pair-hot")
    per = [t.groupBy("user_id").agg(F.count(F.lit(1)).alias(c)) for t, c in ((asked, "_c"), (given.ratings, "_r"))]
    pairs = per[0].join(per[1], "user_id").agg(F.coalesce(F.sum(F.col("_c") * F.col("_r")), F.lit(0)).alias("n")).first().n
    cells = int(max(spark.sparkContext.defaultParallelism, -(-pairs // CELL_PAIRS)))
    both = _lists(asked, F.col("at"), "asked").join(_lists(given.ratings, F.struct("at", "pos", "stars"), "rated").drop("rated_piece"), "user_id")
    asks = both.select("user_id", "asked_piece", "asked", "rated").mapInArrow(
        _asks(own), f"user_id {user}, p int, k bigint, mine boolean, es array<int>" + ", rs array<double>, ps array<int>" * own)
    cell = F.pmod(F.xxhash64("k"), F.lit(cells)).cast("int")
    answers = stats.select(F.col("x").alias("k"), F.col("y").alias("o"), *values)
    if hot.isEmpty():
        asks, answers = (t.withColumn("salt", F.lit(0)) for t in (asks, answers))
    else:  # some hundred-thousandths of all rows at most have an item each, so this table is small
        ways = F.coalesce("ways", F.lit(1))
        asks = asks.join(F.broadcast(hot), "k", "left").withColumn("salt", F.pmod(F.xxhash64("user_id"), ways).cast("int")).drop("ways")
        answers = answers.join(F.broadcast(hot), "k", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), ways - 1))).drop("ways")
    asks, answers = asks.withColumn("cell", cell), answers.withColumn("to_cell", cell).withColumnRenamed("salt", "to_salt")

    empty = to_arrow_schema(spark.createDataFrame([], schema).schema).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        n, o = flat(left.column("es"))
        wanted_k, wanted_o = np.repeat(left.column("k").to_numpy(), n), o.to_numpy(zero_copy_only=False).astype(np.int64)
        k, o = right.column("k").to_numpy(), right.column("o").to_numpy()
        wide = max(int(o.max(initial=0)), int(wanted_o.max(initial=0))) + 1
        key = k * wide + o
        order = np.argsort(key)
        key, want = key[order], wanted_k * wide + wanted_o
        spot = np.minimum(np.searchsorted(key, want), len(key) - 1)
        hit = np.flatnonzero(key[spot] == want)
        row, spot = np.repeat(np.arange(len(n)), n)[hit], order[spot[hit]]
        mine = left.column("mine").to_numpy(zero_copy_only=False)
        got = {c: right.column(c).combine_chunks().take(pa.array(spot)) for c in values}
        pair = {"t": np.where(mine[row], wanted_k[hit], wanted_o[hit]), "j": np.where(mine[row], wanted_o[hit], wanted_k[hit])}
        if own:
            (of_r, r), (_, ps) = flat(left.column("rs")), flat(left.column("ps"))
            start, place = np.cumsum(of_r) - of_r, np.repeat(np.cumsum(n) - n, n)[hit]
            at = start[row] + np.where(mine[row], hit - place, 0)  # a rated item's own value, or that of the entry
            pair |= {"pos": ps.to_numpy(zero_copy_only=False)[at], "stars": r.take(pa.array(at))}
        return found(left, row, pair, got)

    key, to = ["cell", "salt"], ["to_cell", "to_salt"]
    return (asks.repartition(cells, *key).groupBy(*key).cogroup(answers.repartition(cells, *to).groupBy(*to)).applyInArrow(run, schema)
            .repartition(cells, "user_id", "p"))
