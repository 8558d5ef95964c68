"""Demand-driven co-rating joins, shared by item-item CF, Slope One and user kNN.

The textbook way to get co-rating statistics is a self-join of the ratings
on the shared side (all item pairs inside every user's basket). That costs
``sum(deg(u)^2)`` rows and a single heavy user makes it quadratic in one
task. Instead:

1. the *needed* pairs are derived from the candidates (C9): only pairs some
   prediction will read;
2. for each needed pair the entity with fewer ratings drives: its ratings are
   joined in, and the other entity's rating is looked up by the unique key
   (by, other). The work is ``sum over needed pairs of min(deg x, deg y)`` —
   a hot entity is only scanned when paired with an even hotter one;
3. statistics are sums of whole numbers (``pair_sums``): exact, so independent of
   the order of rows.

Both joins are plain equi-joins: AQE turns them into broadcast joins when a
side is small at runtime, and splits a skewed key's partition otherwise.

Heavy/light split (``light_max``). Scanning the driver's raters finds
co-raters at a cost of ``min(deg x, deg y)`` per pair even when only a few
raters are shared. So raters are split by their own degree: a *light*
rater (at most ``light_max`` ratings) contributes the pairs of its own
basket — at most ``light_max^2`` rows for that rater, a bounded group — kept
only where the pair is needed; a *heavy* rater is never expanded pairwise:
its co-ratings come from the demand-driven scan above, which then reads
only heavy raters. Light and heavy raters are disjoint, so the union is
exact. A rater holding a third of all rows is heavy by construction. Without
heavy raters nothing is scanned.

Frequent pairs (``frequent_pairs``). Where only pairs of ``min_n`` common raters
or more matter, the light baskets' pairs are counted first, by their keys alone:
most pairs of a large table have a few common raters, so neither their sums nor
the candidates' expansion need to be shuffled.

Baskets travel as arrays. A basket of n ratings has n (n + 1) / 2 pairs, but is shuffled as n rows: each entity with the array
of those behind it in the order of (number of raters, id). So all rows of a pair meet where the rarer of its two entities is
dealt, its sums need no shuffle of their own, and a hot entity is dealt only the pairs with still hotter ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sparkrec.operators.pair_reads import sums_by_arrays
from sparkrec.session import materialize


def needed_pairs(cand: DataFrame, ratings: DataFrame, by_col: str, target_col: str,
                 other_col: str = "other") -> DataFrame:
    """Distinct (target, other) pairs: for every candidate (by, target), every
    entity ``by`` rated in ``ratings``. Names the second column ``other_col``."""
    r = ratings.select(by_col, F.col(target_col).alias(other_col))
    return cand.select(by_col, target_col).join(r, by_col).select(target_col, other_col).distinct()


DEFAULT_LIGHT_MAX = 128


def common_raters(ratings: DataFrame, pairs: DataFrame, entity_col: str, by_col: str,
                  values: list[str], x_col: str = "x", y_col: str = "y",
                  degree: DataFrame | None = None, light_max: int | None = DEFAULT_LIGHT_MAX) -> DataFrame:
    """For each pair (x, y) in ``pairs`` and each ``by`` that rated both, one
    row ``(x, y, by, x_<v>, y_<v> for v in values)``.

    ``ratings`` must be unique on (entity, by). ``degree`` may pass precomputed
    (entity, _deg) counts to save an aggregation. With ``light_max`` the
    pairs must be canonical (x <= y); see the module notes.
    """
    if light_max is None:
        return _scan_common(ratings, pairs, entity_col, by_col, values, x_col, y_col, degree)
    by_deg = ratings.groupBy(by_col).agg(F.count(F.lit(1)).alias("_bdeg"))
    light = by_deg.filter(F.col("_bdeg") <= light_max).select(by_col)
    heavy = by_deg.filter(F.col("_bdeg") > light_max).select(by_col)
    r_light = ratings.join(light, by_col, "left_semi")
    r_heavy = ratings.join(heavy, by_col, "left_semi")
    a = r_light.select(by_col, F.col(entity_col).alias(x_col), *[F.col(v).alias(f"x_{v}") for v in values])
    b = r_light.select(by_col, F.col(entity_col).alias(y_col), *[F.col(v).alias(f"y_{v}") for v in values])
    basket_pairs = (a.join(b, by_col).filter(F.col(x_col) <= F.col(y_col))
                    .join(pairs.select(x_col, y_col), [x_col, y_col], "left_semi"))
    out_cols = [x_col, y_col, by_col] + [c for v in values for c in (f"x_{v}", f"y_{v}")]
    scanned = _scan_common(r_heavy, pairs, entity_col, by_col, values, x_col, y_col, degree)
    return basket_pairs.select(*out_cols).unionByName(scanned.select(*out_cols))


# Ratings enter the pair sums as whole thousandths, so every sum is exact.
UNIT = 1000


# So many pairs of keys at most are broadcast.
BROADCAST_PAIRS = 1 << 18

# About so many rows of pairs are summed in a task.
TASK_PAIRS = 4_000_000
ARRAY_PAIRS = 1_000_000  # where Python's arrays hold them

# Longer lists of one rater are joined in pieces.
PIECE = 128


def frequent_pairs(ratings: DataFrame, entity_col: str, by_col: str, min_n: int,
                   light_max: int | None = DEFAULT_LIGHT_MAX) -> DataFrame | None:
    """(x, y), x < y: the pairs with ``min_n`` common raters or more, written as a table. None where a rater is heavy, since its
    basket isn't expanded."""
    if light_max is None:
        return None
    size = _basket_size(ratings, by_col, light_max)
    if size.most > light_max:
        return None
    counts = _met(ratings, entity_col, by_col, size.pairs).groupBy("k", "o").agg(F.count(F.lit(1)).alias("n"))
    often = counts.filter((F.col("n") >= min_n) & (F.col("k") != F.col("o")))
    return materialize(often.select(F.least("k", "o").alias("x"), F.greatest("k", "o").alias("y")), "frequent-pairs")


def _basket_size(ratings: DataFrame, by_col: str, light_max: int) -> Row:
    """The largest basket, and how many rows the pairs of light baskets are."""
    n = F.col("_bdeg")
    by_deg = ratings.filter(F.col(by_col).isNotNull()).groupBy(by_col).agg(F.count(F.lit(1)).alias("_bdeg"))
    return by_deg.agg(F.coalesce(F.max(n), F.lit(0)).alias("most"),
                      F.coalesce(F.sum(F.when(n <= light_max, n * (n + 1) / 2)), F.lit(0)).cast("long").alias("pairs")).first()


def _tasks(ratings: DataFrame, pairs: int) -> int:
    return max(ratings.sparkSession.sparkContext.defaultParallelism, -(-pairs // TASK_PAIRS))


def _ranked(ratings: DataFrame, entity_col: str, degree: DataFrame) -> DataFrame:
    """``ratings`` with ``_deg``, the number of raters; null counts as the most frequent entity."""
    most = F.lit((1 << 63) - 1)
    return ratings.join(degree.select(entity_col, "_deg"), entity_col, "left").withColumn(
        "_deg", F.when(F.col(entity_col).isNull(), most).otherwise(F.coalesce("_deg", F.lit(0))))


def _degree(ratings: DataFrame, entity_col: str) -> DataFrame:
    return ratings.groupBy(entity_col).agg(F.count(F.lit(1)).alias("_deg"))


def _basket_rows(light: DataFrame, entity_col: str, by_col: str, value: str | None = None, rarest_first: bool = False) -> DataFrame:
    """(k, es) and with ``value`` (k, k_v, es, vs): each rating with those behind it in its basket, and itself. ``rarest_first``: the
    entities are numbered so."""
    values = [] if value is None else [F.col(value).alias("v")]
    kept = light.filter(F.col(by_col).isNotNull() & F.col(entity_col).isNotNull())
    ranked = kept.withColumn("_deg", F.lit(0)) if rarest_first else _ranked(kept, entity_col, _degree(kept, entity_col))
    entry = F.struct("_deg", F.col(entity_col).alias("e"), *values)
    baskets = ranked.groupBy(by_col).agg(F.sort_array(F.collect_list(entry)).alias("all")).select("all", F.explode("all").alias("one"))
    # from the first of its equals on: a pair rated more than once counts as often as a join would find it
    first, size = F.array_position("all.e", F.col("one.e")).cast("int"), F.size("all")
    return baskets.select(F.col("one.e").alias("k"), *[F.col("one.v").alias("k_v") for _ in values], F.slice("all.e", first, size).alias("es"),
                          *[F.slice("all.v", first, size).alias("vs") for _ in values])


def _met(light: DataFrame, entity_col: str, by_col: str, pairs: int, value: str | None = None) -> DataFrame:
    """(k, o) and with ``value`` (k, o, k_v, o_v): each pair of a basket once, in the direction of the order, dealt by k; an entity
    meets itself too. ``light``: ratings of raters with few only, since a basket is one row here."""
    rows = _basket_rows(light, entity_col, by_col, value).repartition(_tasks(light, pairs), "k")
    if value is None:
        return rows.select("k", F.explode("es").alias("o"))
    return rows.select("k", "k_v", "vs", F.posexplode("es").alias("at", "o")).select("k", "o", "k_v", F.get("vs", F.col("at")).alias("o_v"))


def _pieces(rows: DataFrame, entity_col: str, by_col: str, name: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(by_col).orderBy(entity_col)) - 1
    cut = rows.filter(F.col(by_col).isNotNull()).withColumn("_piece", F.floor(place / PIECE))
    return cut.groupBy(by_col, "_piece").agg(F.collect_list(F.struct("_deg", F.col(entity_col).alias("e"))).alias(name)).drop("_piece")


def needed_by_baskets(cand: DataFrame, ratings: DataFrame, entity_col: str, by_col: str) -> DataFrame:
    """(x, y), x <= y: the distinct unordered pairs of a candidate (by, entity) and an entity that ``by`` rated; with a null only,
    the other entity twice. Lists of candidates and of ratings are joined in pieces, and a candidate travels with the array of the
    ratings behind it, a rating with that of the candidates behind it, so each pair is found where its rarer entity is dealt."""
    cand = materialize(cand.select(by_col, entity_col), "asked")
    degree = _degree(ratings, entity_col)
    asked, rated = (t.groupBy(by_col).agg(F.count(F.lit(1)).alias(c)) for t, c in ((cand, "_c"), (ratings, "_r")))
    pairs = asked.join(rated, by_col).agg(F.coalesce(F.sum(F.col("_c") * F.col("_r")), F.lit(0)).alias("n")).first().n
    lists = _pieces(_ranked(cand, entity_col, degree), entity_col, by_col, "asked").join(
        _pieces(_ranked(ratings.select(by_col, entity_col), entity_col, degree), entity_col, by_col, "rated"), by_col)
    sides = F.concat(F.transform("asked", lambda e: F.struct(e.alias("one"), F.lit(True).alias("asks"))),
                     F.transform("rated", lambda e: F.struct(e.alias("one"), F.lit(False).alias("asks"))))
    rows = lists.select("asked", "rated", F.explode(sides).alias("s")).select("asked", "rated", F.col("s.one").alias("one"), F.col("s.asks").alias("asks"))
    behind = F.when(F.col("asks"), F.filter("rated", lambda r: r >= F.col("one"))).otherwise(F.filter("asked", lambda a: a > F.col("one")))
    rows = rows.select(F.col("one.e").alias("k"), behind.alias("b")).select("k", F.col("b.e").alias("es")).filter(F.size("es") > 0)
    met = rows.repartition(_tasks(ratings, pairs), "k").select("k", F.explode("es").alias("o"))
    met = met.select("k", F.coalesce("o", "k").alias("o")).distinct()
    return met.select(F.least("k", "o").alias("x"), F.greatest("k", "o").alias("y"))


def whole_units(value: str) -> Column:
    """A rating in whole units; one that is finer raises."""
    whole = F.round(F.col(value).cast("double") * UNIT)
    off = F.abs(F.col(value).cast("double") * UNIT - whole) > 1e-6
    return F.when(off, F.raise_error(F.lit(f"a rating is finer than 1/{UNIT}")).cast("long")).otherwise(whole.cast("long"))


def pair_sums(ratings: DataFrame, pairs: DataFrame, entity_col: str, by_col: str, value: str = "stars",
              degree: DataFrame | None = None, light_max: int | None = DEFAULT_LIGHT_MAX, few: bool = False,
              exact: bool = True, rarest_first: bool = False) -> DataFrame:
    """(x, y, n, a, b, ab, aa, bb): for each pair with common raters their number
    and the sums of r_x, r_y, r_x r_y, r_x^2, r_y^2 in whole units (``UNIT`` to a star).

    A rating finer than a unit raises. Pairs of light raters are summed where the rarer entity is dealt (``_met``), then
    kept where the pair is needed; the sums of heavy raters' scans are added. With ``few``, at most ``BROADCAST_PAIRS`` pairs are
    needed, and others leave before they are summed. Without ``exact`` pairs that aren't needed may stay, for a caller whose own
    join leaves them out: where all raters are light, the needed ones are then not worked out. ``rarest_first``: entities are numbers
    in the order of (number of raters, id); their pairs are summed over arrays in tasks (``sums_by_arrays``).
    """
    r = ratings.select(entity_col, by_col, whole_units(value).alias("v"))
    if light_max is None:
        return _sums(_scan_common(r, pairs, entity_col, by_col, ["v"], "x", "y", degree))
    size = _basket_size(r, by_col, light_max)
    all_light = size.most <= light_max
    if all_light:
        light = heavy = r
    else:
        by_deg = r.groupBy(by_col).agg(F.count(F.lit(1)).alias("_bdeg"))
        r = r.join(by_deg, by_col)
        light, heavy = r.filter(F.col("_bdeg") <= light_max), r.filter(F.col("_bdeg") > light_max)
    if few:
        one = light.select(by_col, F.col(entity_col).alias("x"), F.col("v").alias("x_v"))
        two = light.select(by_col, F.col(entity_col).alias("y"), F.col("v").alias("y_v"))
        met = one.join(two, by_col).filter(F.col("x") <= F.col("y"))
        baskets = _sums(met.join(F.broadcast(pairs.select("x", "y")), ["x", "y"], "left_semi"))
    else:
        if rarest_first:
            rows = _basket_rows(light, entity_col, by_col, "v", True)
            baskets = _as_xy(sums_by_arrays(rows, _tasks(light, size.pairs * TASK_PAIRS // ARRAY_PAIRS)))
        else:
            baskets = _as_xy(_sums(_met(light, entity_col, by_col, size.pairs, "v"), "k", "o"))
        if not all_light or exact:
            baskets = baskets.join(pairs.select("x", "y"), ["x", "y"], "left_semi")
    if all_light:
        return baskets
    scanned = _sums(_scan_common(heavy, pairs, entity_col, by_col, ["v"], "x", "y", degree))
    names = ["n", "a", "b", "ab", "aa", "bb"]
    return baskets.unionByName(scanned).groupBy("x", "y").agg(*[F.sum(c).alias(c) for c in names])


def _sums(j: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    xv, yv = F.col(f"{x}_v"), F.col(f"{y}_v")
    return j.groupBy(x, y).agg(F.count(F.lit(1)).alias("n"), F.sum(xv).alias("a"), F.sum(yv).alias("b"),
                               F.sum(xv * yv).alias("ab"), F.sum(xv * xv).alias("aa"), F.sum(yv * yv).alias("bb"))


def _as_xy(sums: DataFrame) -> DataFrame:
    """Sums of (k, o) as those of (x, y), x <= y."""
    same = F.col("k") <= F.col("o")

    def of(c: str, back: str, name: str) -> Column:
        return F.when(same, F.col(c)).otherwise(F.col(back)).alias(name)
    return sums.select(of("k", "o", "x"), of("o", "k", "y"), "n", of("a", "b", "a"), of("b", "a", "b"), "ab", of("aa", "bb", "aa"), of("bb", "aa", "bb"))


def mirrored(df: DataFrame, left: str, right: str, values: dict[str, int]) -> DataFrame:
    """Rows (x, y, ...) in both directions as (left, right, ...), one row where x = y.
    ``values``: the columns that go along, with the sign they have in the mirrored row."""
    there = F.struct(F.col("x").alias("l"), F.col("y").alias("r"), F.lit(False).alias("back"))
    back = F.struct(F.col("y").alias("l"), F.col("x").alias("r"), F.lit(True).alias("back"))
    ways = F.explode(F.when(F.col("x") == F.col("y"), F.array(there)).otherwise(F.array(there, back))).alias("_w")
    return df.select(*values, ways).select(
        F.col("_w.l").alias(left), F.col("_w.r").alias(right),
        *[F.col(c) if sign > 0 else F.when(F.col("_w.back"), -F.col(c)).otherwise(F.col(c)).alias(c) for c, sign in values.items()])


def _scan_common(ratings: DataFrame, pairs: DataFrame, entity_col: str, by_col: str,
                 values: list[str], x_col: str, y_col: str, degree: DataFrame | None) -> DataFrame:
    if degree is None:
        degree = ratings.groupBy(entity_col).agg(F.count(F.lit(1)).alias("_deg"))
    dx = degree.select(F.col(entity_col).alias(x_col), F.col("_deg").alias("_dx"))
    dy = degree.select(F.col(entity_col).alias(y_col), F.col("_deg").alias("_dy"))
    p = pairs.select(x_col, y_col).join(dx, x_col).join(dy, y_col)
    x_drives = (F.col("_dx") < F.col("_dy")) | ((F.col("_dx") == F.col("_dy")) & (F.col(x_col) <= F.col(y_col)))
    p = p.select(x_col, y_col, x_drives.alias("_xd"),
                 F.when(x_drives, F.col(x_col)).otherwise(F.col(y_col)).alias("_drv"),
                 F.when(x_drives, F.col(y_col)).otherwise(F.col(x_col)).alias("_oth"))
    drv = ratings.select(F.col(entity_col).alias("_drv"), by_col,
                         *[F.col(v).alias(f"_d_{v}") for v in values])
    oth = ratings.select(F.col(entity_col).alias("_oth"), by_col,
                         *[F.col(v).alias(f"_o_{v}") for v in values])
    j = p.join(drv, "_drv").join(oth, ["_oth", by_col])
    out = [x_col, y_col, by_col]
    for v in values:
        out.append(F.when(F.col("_xd"), F.col(f"_d_{v}")).otherwise(F.col(f"_o_{v}")).alias(f"x_{v}"))
        out.append(F.when(F.col("_xd"), F.col(f"_o_{v}")).otherwise(F.col(f"_d_{v}")).alias(f"y_{v}"))
    return j.select(*out)
