"""Item-item collaborative filtering (H1) and its parts.

Semantics (the reference's): ``w(t, j)`` is Pearson-like over the users who
rated both items, but each item is centred by its mean over *all* its raters.
Pairs with fewer than ``min_co`` co-raters or a zero denominator weigh 0;
weights are amplified ``w * |w|^(p-1)``. A prediction for (u, t) takes u's
rated items with positive weight, the ``k`` largest (ties: item id
ascending), and averages u's raw ratings with those weights.

Fallbacks: unknown item -> user mean (2.5 if the user is unknown too); known
item, unknown user -> item mean; no positive neighbour -> user mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkrec.functions.columns import ORDER_DECIMALS, amplify, clamp
from sparkrec.operators.baselines import UNKNOWN_USER_MEAN
from sparkrec.operators.pair_reads import CHUNK, flat, lists, numbered, read
from sparkrec.operators.pairs import BROADCAST_PAIRS, DEFAULT_LIGHT_MAX, UNIT, frequent_pairs, mirrored, needed_by_baskets, pair_sums
from sparkrec.session import materialize, ship

# Totals of so many items at most are broadcast.
BROADCAST_ITEMS = 1 << 19
# Products under it are whole longs, four of which can be added.
SMALL = float(1 << 60)


def _r(train: DataFrame) -> DataFrame:
    return train.select("user_id", "item_id", F.col("stars").cast("double").alias("stars"))


def item_stats(train: DataFrame) -> DataFrame:
    return _r(train).groupBy("item_id").agg(F.avg("stars").alias("item_mean"),
                                            F.count(F.lit(1)).alias("item_count"))


def user_stats(train: DataFrame) -> DataFrame:
    return _r(train).groupBy("user_id").agg(F.avg("stars").alias("user_mean"),
                                            F.count(F.lit(1)).alias("user_count"))


def candidate_expand(pairs: DataFrame, train: DataFrame) -> DataFrame:
    """C4: each (user, target) with every item the user rated: (user_id,
    item_id, other, r_other)."""
    r = _r(train).select("user_id", F.col("item_id").alias("other"), F.col("stars").alias("r_other"))
    return pairs.select("user_id", "item_id").join(r, "user_id")


def _eligible_expand(known: DataFrame, train: DataFrame, ist: DataFrame, min_co: int) -> DataFrame:
    """``candidate_expand`` over items with at least ``min_co`` raters on both sides:
    others can't reach the threshold with anything, so they leave before the expansion."""
    if min_co <= 0:
        return candidate_expand(known, train)
    enough = ist.filter(F.col("item_count") >= min_co).select("item_id")
    return candidate_expand(known.join(enough, "item_id", "left_semi"), train.join(enough, "item_id", "left_semi"))


def canonical_needed(expand: DataFrame, eligible: DataFrame | None = None) -> DataFrame:
    """Distinct unordered item pairs (x <= y) some prediction reads.

    ``eligible`` (item_id) restricts both ends, e.g. to items with at least
    ``min_co`` raters: an item with fewer raters can never reach the threshold.
    """
    a, b = F.col("item_id"), F.col("other")
    p = expand.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct()
    if eligible is not None:
        e = eligible.select("item_id")
        p = (p.join(e.withColumnRenamed("item_id", "x"), "x", "left_semi")
             .join(e.withColumnRenamed("item_id", "y"), "y", "left_semi"))
    return p


def by_pair(expand: DataFrame) -> DataFrame:
    """``expand`` with the unordered pair (x <= y) of each row: statistics of pairs are joined as they lie, not once a direction."""
    a, b = F.col("item_id"), F.col("other")
    return expand.withColumn("x", F.least(a, b)).withColumn("y", F.greatest(a, b))


def needed(known: DataFrame, train: DataFrame) -> DataFrame:
    """``canonical_needed`` of all the known pairs' expansion, which isn't shuffled pair by pair (``needed_by_baskets``)."""
    return needed_by_baskets(known, train, "item_id", "user_id")


def frequent_needed(expand: DataFrame, train: DataFrame, min_co: int, eligible: DataFrame | None = None,
                    light_max: int | None = DEFAULT_LIGHT_MAX, exact: bool = True) -> tuple[DataFrame, bool]:
    """``canonical_needed`` without pairs that can't reach ``min_co`` co-raters, where they are known (``frequent_pairs``), and
    whether those left may be broadcast: then the expansion isn't shuffled to find them. Without ``exact`` frequent pairs that no
    prediction reads may stay, for a caller whose own join leaves them out."""
    kept = train if eligible is None else train.join(eligible.select("item_id"), "item_id", "left_semi")
    often = frequent_pairs(kept, "item_id", "user_id", min_co, light_max) if min_co > 1 else None
    if often is None:
        return canonical_needed(expand, eligible), False
    a, b = F.col("item_id"), F.col("other")
    same = expand.filter(a == b).select(a.alias("x"), b.alias("y")).distinct()
    if not exact:
        kept_pairs = materialize(often.unionByName(same), "needed-pairs")
        return kept_pairs, kept_pairs.count() <= BROADCAST_PAIRS
    if often.count() > BROADCAST_PAIRS:
        return canonical_needed(expand).join(often, ["x", "y"], "left_semi").unionByName(same), False
    met = expand.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"))
    needed = materialize(met.join(F.broadcast(often), ["x", "y"], "left_semi").distinct().unionByName(same), "needed-pairs")
    return needed, needed.count() <= BROADCAST_PAIRS


def co_rating_stats(train: DataFrame, pairs_xy: DataFrame, stats: DataFrame | None = None,
                    light_max: int | None = DEFAULT_LIGHT_MAX, few: bool = False, exact: bool = True,
                    rarest_first: bool = False, n_items: int | None = None) -> DataFrame:
    """Per unordered pair (x, y): co-rater count and centred sums
    ``sab = sum(a'b')``, ``saa = sum(a'^2)``, ``sbb = sum(b'^2)``.

    The sums are whole numbers, centred by the items' totals in whole numbers too
    (times both items' counts), and divided last: a sum that is 0 is exactly 0, and
    the order of rows doesn't matter. They are added up in arrays: as longs where all
    terms are small, else as Python's integers. ``n_items``, if known, tells whether the totals may be broadcast.
    """
    stats = stats if stats is not None else item_stats(train)
    deg = stats.select("item_id", F.col("item_count").alias("_deg"))
    j = pair_sums(_r(train), pairs_xy, "item_id", "user_id", degree=deg, light_max=light_max, few=few, exact=exact, rarest_first=rarest_first)
    total = _r(train).groupBy("item_id").agg(F.count(F.lit(1)).alias("cnt"),
                                             F.sum(F.round(F.col("stars") * UNIT).cast("long")).alias("tot"))
    of_x = total.select(F.col("item_id").alias("x"), F.col("cnt").alias("nx"), F.col("tot").alias("tx"))
    of_y = total.select(F.col("item_id").alias("y"), F.col("cnt").alias("ny"), F.col("tot").alias("ty"))
    if n_items is not None and n_items <= BROADCAST_ITEMS:
        of_x, of_y = F.broadcast(of_x), F.broadcast(of_y)
    j = j.join(of_x, "x").join(of_y, "y")
    ship(train.sparkSession)
    keys = ", ".join(f"{c} {j.schema[c].dataType.simpleString()}" for c in ("x", "y"))
    return j.select("x", "y", *TOTALS).mapInArrow(_centred, f"{keys}, n_co bigint, sab double, saa double, sbb double")


TOTALS = ["n", "a", "b", "ab", "aa", "bb", "nx", "ny", "tx", "ty"]


def _centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The centred sums of rows (x, y, ``TOTALS``); a null among the sums they need makes them null."""
    for batch in batches:
        n, a, b, ab, aa, bb, nx, ny, tx, ty = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in TOTALS)
        size = [np.abs(c.astype(float)) for c in (n, a, b, ab, aa, bb, nx, ny, tx, ty)]
        most_n, most_t = np.maximum.reduce([size[0], size[6], size[7]]), np.maximum(size[8], size[9])
        small = np.maximum.reduce([most_n * most_n * np.maximum.reduce(size[3:6]), most_n * most_t * np.maximum(size[1], size[2]), most_n * most_t * most_t]) < SMALL

        def terms(n, a, b, ab, aa, bb, nx, ny, tx, ty):
            return (nx * ny * ab - nx * ty * a - ny * tx * b + n * tx * ty, nx * nx * aa - 2 * nx * tx * a + n * tx * tx, ny * ny * bb - 2 * ny * ty * b + n * ty * ty)

        cols = (n, a, b, ab, aa, bb, nx, ny, tx, ty)
        sums = [x.astype(float) for x in terms(*(np.where(small, c, 0) for c in cols))]
        if not small.all():
            for out, exact in zip(sums, terms(*(c[~small].astype(object) for c in cols)), strict=True):
                out[~small] = exact.astype(float)
        fx, fy, unit = nx.astype(float), ny.astype(float), float(UNIT * UNIT)
        missing = {c: ~np.asarray(batch.column(c).is_valid()) for c in TOTALS}
        found = [(s / (p * q) / unit, np.logical_or.reduce([missing[c] for c in needs]))
                 for s, p, q, needs in zip(sums, (fx, fx, fy), (fy, fx, fy), (["ab", "a", "b", "tx", "ty"], ["aa", "a", "tx"], ["bb", "b", "ty"]), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), batch.column("n"), *(pa.array(v, mask=m) for v, m in found)],
                                         names=["x", "y", "n_co", "sab", "saa", "sbb"])


def weight_from_stats(s: DataFrame, min_co: int, p: float) -> DataFrame:
    ok = (F.col("n_co") >= min_co) & (F.col("saa") > 0) & (F.col("sbb") > 0)
    w = F.when(ok, F.col("sab") / (F.sqrt("saa") * F.sqrt("sbb"))).otherwise(F.lit(0.0))
    return s.withColumn("weight", amplify(w, p))


def both_orientations(w: DataFrame) -> DataFrame:
    """(x, y) canonical weights -> (item_id, other) in both directions."""
    return mirrored(w, "item_id", "other", {"n_co": 1, "weight": 1})


def topk_neighbors(expand_w: DataFrame, k: int) -> DataFrame:
    """Keep the ``k`` largest positive weights per (user, target).

    ``row_number() <= k`` is planned as a WindowGroupLimit that also runs
    *before* the shuffle, so a heavy user is cut to k rows per partition
    before its group is gathered.
    """
    w = Window.partitionBy("user_id", "item_id").orderBy(
        F.desc(F.round("weight", ORDER_DECIMALS)), F.asc("other"))
    return (expand_w.filter(F.col("weight") > 0)
            .withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def _settled(pairs: DataFrame, ust: DataFrame, ist: DataFrame, top: DataFrame) -> DataFrame:
    """Pairs with the means of both sides and what their neighbours say, null where missing."""
    return (pairs.join(ust.select("user_id", "user_mean"), "user_id", "left")
            .join(ist.select("item_id", "item_mean"), "item_id", "left").join(top, ["user_id", "item_id"], "left"))


def item_cf(train: DataFrame, cand: DataFrame, k: int = 20, min_co: int = 35, p: float = 2.5,
            clamp_range: tuple[float, float] | None = (1.0, 5.0),
            light_max: int | None = DEFAULT_LIGHT_MAX) -> DataFrame:
    """Predict every distinct (user_id, item_id) of ``cand`` from ``train``.

    Returns (user_id, item_id, prediction, route).
    """
    ist = item_stats(train)
    ust = user_stats(train)
    pairs = cand.select("user_id", "item_id").distinct()
    known = (pairs.join(ust.select("user_id"), "user_id", "left_semi")
             .join(ist.select("item_id"), "item_id", "left_semi"))
    expand = _eligible_expand(known, train, ist, min_co)
    asked, few = frequent_needed(expand, train, min_co, ist.filter(F.col("item_count") >= min_co), light_max, exact=False)
    weights = both_orientations(weight_from_stats(co_rating_stats(train, asked, ist, light_max, few), min_co, p))
    weights = weights.filter(F.col("weight") > 0)
    nb = expand.join(F.broadcast(weights) if few else weights, ["item_id", "other"])
    top = (topk_neighbors(nb, k).groupBy("user_id", "item_id")
           .agg((F.sum(F.col("r_other") * F.col("weight")) / F.sum("weight")).alias("nb_pred"),
                F.count(F.lit(1)).alias("n_neighbors")))
    j = _settled(pairs, ust, ist, top)
    route = (F.when(F.col("item_mean").isNull() & F.col("user_mean").isNull(), "both_cold")
             .when(F.col("item_mean").isNull(), "cold_item")
             .when(F.col("user_mean").isNull(), "cold_user")
             .when(F.col("nb_pred").isNotNull(), "neighbors")
             .otherwise("no_neighbor"))
    pred = (F.when(F.col("item_mean").isNull(), F.coalesce("user_mean", F.lit(UNKNOWN_USER_MEAN)))
            .when(F.col("user_mean").isNull(), F.col("item_mean"))
            .when(F.col("nb_pred").isNotNull(), F.col("nb_pred"))
            .otherwise(F.col("user_mean")))
    if clamp_range is not None:
        pred = clamp(pred, *clamp_range)
    return j.select("user_id", "item_id", pred.alias("prediction"), route.alias("route"))


def nested_topk(expand_w: DataFrame, thresholds: list[int], k: int, cut: bool = True) -> DataFrame:
    """The rows of ``expand_w`` (with n_co and weight) that are among the ``k`` largest weights of (user_id, item_id) under
    some threshold, with ``rank_<t>`` for each threshold t: the place among the rows of n_co >= t, null outside the k.

    Thresholds are nested, so a row belongs to the bands up to its highest one, and no row is copied for each. Rows of one
    band compete under every threshold that either passes: one behind k others of its own band is in no top, which cuts
    the rows to k for each (user, item, band) before they are shuffled. What is left is ranked for all thresholds in one
    window of ``k * len(thresholds)`` rows at most. Where no group is large, ``cut=False`` saves that step's shuffle;
    the result is the same.
    """
    ts = sorted(thresholds)
    order = [F.desc(F.round("weight", ORDER_DECIMALS)), F.asc("other")]
    band = sum(((F.col("n_co") >= t).cast("int") for t in ts), F.lit(0))
    rows = expand_w.filter((F.col("weight") > 0) & (F.col("n_co") >= ts[0])).withColumn("band", band)
    if cut:
        own = Window.partitionBy("user_id", "item_id", "band").orderBy(*order)
        rows = rows.withColumn("place", F.row_number().over(own)).filter(F.col("place") <= k).drop("place")
    so_far = Window.partitionBy("user_id", "item_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for n, t in enumerate(ts, 1):
        before = F.count(F.when(F.col("band") >= n, 1)).over(so_far)
        rows = rows.withColumn(f"rank_{t}", F.when(F.col("band") >= n, before))
    for t in ts:
        rows = rows.withColumn(f"rank_{t}", F.when(F.col(f"rank_{t}") <= k, F.col(f"rank_{t}")))
    return rows.filter(F.coalesce(*[F.col(f"rank_{t}") for t in ts]).isNotNull()).drop("band")


def _weighed(left: pa.Table, row: np.ndarray, pair: dict, got: dict) -> pa.Table:
    """For each row that asked, what the tops are made of: targets, places of the neighbours by id, their ratings, weights, co-raters."""
    rows, size = np.unique(row, return_counts=True)
    users, pieces = (left.column(c).take(pa.array(rows)) for c in ("user_id", "p"))
    cols = [pair["t"].astype(np.int32), pair["pos"], pair["stars"], got["weight"], got["n_co"]]
    return pa.table([users, pieces, *(lists(size, c) for c in cols)], names=["user_id", "p", *NEIGHBOUR])


NEIGHBOUR = ["ts", "ps", "rs", "ws", "ns"]


def _tops(thresholds: list[int], ks: list[int], user: pa.DataType):
    """From ``_weighed`` rows, those of a user in one task, to (user_id, at, num, den): sums of r w and of w over the ``k`` largest
    weights of n_co >= threshold, for each threshold and each k of it. Rows in no top leave as soon as ``CHUNK`` others have come."""
    kmax = max(ks)

    def ordered(held: list[np.ndarray]):
        u, t, pos, _, _, w, _ = held
        order = np.lexsort((pos, -np.round(w, ORDER_DECIMALS), t, u))
        held = [c[order] for c in held]
        first = np.flatnonzero(np.r_[True, (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])])
        return held, first, np.repeat(first, np.diff(np.r_[first, len(u)]))

    def place(n: np.ndarray, first: np.ndarray, threshold: int):
        ok = n >= threshold
        before = np.cumsum(ok) - ok
        return np.where(ok, before - before[first], kmax)

    def cut(held: list[np.ndarray]) -> list[np.ndarray]:
        held, _, start = ordered(held)
        keep = np.zeros(len(start), bool)
        for x in thresholds:
            keep |= place(held[6], start, x) < kmax
        return [c[keep] for c in held]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        waiting: list[list[np.ndarray]] = []
        done = 0
        for b in batches:
            if not b.num_rows:
                continue
            size, t = flat(b.column("ts"))
            code = np.repeat(np.array([seen.setdefault(x, len(seen)) for x in b.column("user_id").to_pylist()], np.int64), size)
            pos, r, w, n = (flat(b.column(c))[1] for c in NEIGHBOUR[1:])
            waiting.append([code, t.to_numpy(zero_copy_only=False), pos.to_numpy(zero_copy_only=False), r.fill_null(0.0).to_numpy(zero_copy_only=False),
                            np.asarray(r.is_valid()), w.to_numpy(zero_copy_only=False), n.to_numpy(zero_copy_only=False)])
            if sum(len(x[0]) for x in waiting[done:]) > max(2 * CHUNK, len(waiting[0][0]) if done else 0):
                waiting, done = [cut([np.concatenate(c) for c in zip(*waiting, strict=True)])], 1
        held = [np.concatenate(c) for c in zip(*waiting, strict=True)] if waiting else []
        if not held or not len(held[0]):
            return
        (u, t, _, r, rated, w, n), first, start = ordered(held)
        num, den = [], []
        for x in thresholds:
            at = place(n, start, x)
            for k in ks:
                top = at < k
                with_r = np.add.reduceat((top & rated).astype(np.int64), first)
                num.append(np.where(with_r > 0, np.add.reduceat(np.where(top, r * w, 0.0), first), np.nan))
                den.append(np.add.reduceat(np.where(top, w, 0.0), first))
        num, den, names = np.stack(num, axis=1), np.stack(den, axis=1), pa.array(list(seen), user)
        for lo in range(0, len(first), 1 << 14):
            here = slice(lo, lo + (1 << 14))
            size = np.full(len(first[here]), num.shape[1])
            sums = [pa.array(c[here].ravel(), mask=~m[here].ravel()) for c, m in ((num, ~np.isnan(num)), (den, den > 0))]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(u[first[here]])), pa.array(t[first[here]], pa.int64()), *(lists(size, c) for c in sums)],
                                             names=["user_id", "at", "num", "den"])
    return run


def item_cf_sweep(train: DataFrame, cand: DataFrame, thresholds: list[int], ks: list[int],
                  p: float = 2.5, clamp_range: tuple[float, float] | None = (0.0, 5.0), labels: DataFrame | None = None) -> DataFrame:
    """H9: predictions for every (min_co, k) setting in one job.

    The co-rating statistics are computed once and read over arrays (``pair_reads``): a neighbour travels to its
    candidate once, whatever the thresholds, and is ranked there for each of them. (``nested_topk`` does so in one
    window.) Returns (min_co, k, user_id, item_id, prediction). With ``labels`` (user_id, item_id, label) the rows are those of
    the predictions joined with them, which happens before a row is made for each setting.
    """
    ist = item_stats(train)
    ust = user_stats(train)
    given = numbered(train)
    least = min(thresholds)
    pairs = cand.select("user_id", "item_id").distinct()
    asked = materialize(pairs.join(ust.select("user_id", "user_mean", F.lit(True).alias("_rated")), "user_id", "left")
                        .join(given.items.select("item_id", "at", "_deg"), "item_id", "left"), "sweep-asked")
    # an item of fewer raters reaches no threshold
    known = asked.filter("_rated and at is not null").filter(F.col("_deg") >= least)
    if least > 0:
        enough = given.items.filter(F.col("_deg") >= least).select("at")
        given = replace(given, ratings=given.ratings.join(enough, "at", "left_semi"))
    by_number = given.by_number()
    stats = co_rating_stats(by_number, needed(known.select("user_id", F.col("at").alias("item_id")), by_number) if _any_heavy(by_number) else None,
                            exact=False, rarest_first=True, n_items=given.n_items)
    weights = weight_from_stats(stats, least, p).filter((F.col("weight") > 0) & (F.col("n_co") >= least)).select("x", "y", "weight", "n_co")
    kind = train.schema["user_id"].dataType.simpleString()
    found = read(given, known, weights, ["weight", "n_co"], _weighed,
                 f"user_id {kind}, p int, ts array<int>, ps array<int>, rs array<double>, ws array<double>, ns array<bigint>")
    user = to_arrow_type(train.schema["user_id"].dataType)
    top = found.drop("p").mapInArrow(_tops([int(t) for t in thresholds], [int(k) for k in ks], user), f"user_id {kind}, at bigint, num array<double>, den array<double>")
    j = (asked.join(ist.select("item_id", "item_mean"), "item_id", "left").join(top, ["user_id", "at"], "left"))
    if labels is not None:
        j = j.join(labels.select("user_id", "item_id", "label"), ["user_id", "item_id"])
    more = [] if labels is None else ["label"]
    settings = F.array(*[F.struct(F.lit(int(t)).alias("min_co"), F.lit(int(k)).alias("k")) for t in thresholds for k in ks])
    den = F.coalesce("den", F.array_repeat(F.lit(None).cast("double"), len(thresholds) * len(ks)))
    e = (j.select("user_id", "item_id", "user_mean", "item_mean", "num", *more, F.posexplode(den).alias("_n", "_den"))
         .withColumn("_o", F.get(settings, F.col("_n"))).withColumn("_num", F.get("num", F.col("_n"))))
    pred = (F.when(F.col("item_mean").isNull(), F.coalesce("user_mean", F.lit(UNKNOWN_USER_MEAN)))
            .when(F.col("user_mean").isNull(), F.col("item_mean"))
            .when(F.col("_den").isNotNull(), F.col("_num") / F.col("_den"))
            .otherwise(F.col("user_mean")))
    if clamp_range is not None:
        pred = clamp(pred, *clamp_range)
    return e.select(F.col("_o.min_co").alias("min_co"), F.col("_o.k").alias("k"), "user_id", "item_id", pred.alias("prediction"), *more)


def _any_heavy(ratings: DataFrame) -> bool:
    return not ratings.groupBy("user_id").count().filter(F.col("user_id").isNotNull() & (F.col("count") > DEFAULT_LIGHT_MAX)).isEmpty()
