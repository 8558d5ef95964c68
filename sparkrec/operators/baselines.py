"""Means, counts, centring, cold-start routing, indexing and the bias baseline.

Everything is one or two aggregations; Spark combines partially on the map
side, so a user or item holding a third of all rows costs no more than the
others after the partial step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.functions.columns import attach_row, key_hash

# Fixed values the reference uses when a user or item has no history.
UNKNOWN_USER_MEAN = 2.5


def dedupe_latest(df: DataFrame, keys: list[str], value: str, order: list[str],
                  name: str | None = None) -> DataFrame:
    """One row per key, the value of the row that is last in ``order``.

    The reference keeps whichever duplicate a dict saw last (arbitrary);
    here the order is declared. ``max_by`` is an aggregate, so it combines
    map-side and a hot key never lands whole in one task.
    """
    name = name or value
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.struct(*order)).alias(name))


def user_means(ratings: DataFrame, user_col="user_id", rating_col="stars") -> DataFrame:
    return ratings.groupBy(user_col).agg(
        F.avg(F.col(rating_col).cast("double")).alias("user_mean"),
        F.count(F.lit(1)).alias("user_count"))


def item_means(ratings: DataFrame, item_col="item_id", rating_col="stars") -> DataFrame:
    return ratings.groupBy(item_col).agg(
        F.avg(F.col(rating_col).cast("double")).alias("item_mean"),
        F.count(F.lit(1)).alias("item_count"))


def global_mean(ratings: DataFrame, rating_col="stars") -> DataFrame:
    """One-row frame; attach it with ``functions.columns.attach_row``."""
    return ratings.agg(F.avg(F.col(rating_col).cast("double")).alias("global_mean"))


def center_by_item(ratings: DataFrame, item_col="item_id", rating_col="stars") -> DataFrame:
    """Adds ``item_mean`` (over all raters of the item) and ``centered``.

    Aggregate then join back rather than a window: a window would hold a hot
    item's rows in one task, the aggregate combines map-side and AQE splits
    the hot key of the join.
    """
    means = ratings.groupBy(item_col).agg(F.avg(F.col(rating_col).cast("double")).alias("item_mean"))
    return (ratings.join(means, item_col)
            .withColumn("centered", F.col(rating_col).cast("double") - F.col("item_mean")))


def training_counts(pairs: DataFrame, train: DataFrame, user_col="user_id",
                    item_col="item_id") -> DataFrame:
    """Per-user and per-item rating counts from ``train``; 0 when absent."""
    uc = train.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_user"))
    ic = train.groupBy(item_col).agg(F.count(F.lit(1)).alias("n_item"))
    return (pairs.join(uc, user_col, "left").join(ic, item_col, "left")
            .withColumn("n_user", F.coalesce("n_user", F.lit(0)))
            .withColumn("n_item", F.coalesce("n_item", F.lit(0))))


def cold_users(pairs: DataFrame, train: DataFrame, user_col="user_id") -> DataFrame:
    return pairs.join(train.select(user_col).distinct(), user_col, "left_anti")


def cold_items(pairs: DataFrame, train: DataFrame, item_col="item_id") -> DataFrame:
    return pairs.join(train.select(item_col).distinct(), item_col, "left_anti")


def cold_start_route(pairs: DataFrame, train: DataFrame, user_col="user_id",
                     item_col="item_id") -> DataFrame:
    """Mark each pair 'both_known', 'cold_item', 'cold_user' or 'both_cold'."""
    ku = train.select(user_col).distinct().withColumn("_ku", F.lit(True))
    ki = train.select(item_col).distinct().withColumn("_ki", F.lit(True))
    j = pairs.join(ku, user_col, "left").join(ki, item_col, "left")
    route = (F.when(F.col("_ku").isNotNull() & F.col("_ki").isNotNull(), "both_known")
             .when(F.col("_ku").isNotNull(), "cold_item")
             .when(F.col("_ki").isNotNull(), "cold_user")
             .otherwise("both_cold"))
    return j.withColumn("route", route).drop("_ku", "_ki")


DIGEST_HEX = 5   # 20-bit entries: a sum over 8e12 entries of one key stays inside BIGINT


def entry_digest(*cols, at: int = 0) -> Column:
    """20 bits of the md5 of one basket entry, portable to any SQL engine; ``at`` picks which five hex digits."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(":"))
        parts.append(F.col(c).cast("string"))
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1 + at * DIGEST_HEX, DIGEST_HEX), 16, 10).cast("bigint")


def baskets(ratings: DataFrame, key_col: str, other_col: str, rating_col="stars") -> DataFrame:
    """Per-key basket summary (D1/D2): size, star sum and sum of squares, and an
    order-free digest of the basket's (other, stars) entries.

    The reference materialises each basket as a list, which ``basket_lists`` gives in bounded
    pieces; this is the summary by mergeable aggregates.
    Two independent digest sums tell different baskets of a few entries apart
    but for about one in 2^40 pairs; they prove nothing against chosen entries.
    Models never need the list: they join.
    """
    r = F.col(rating_col).cast("double")
    return ratings.groupBy(key_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(r).alias("total"),
        F.sum(r * r).alias("total_sq"),
        F.sum(entry_digest(other_col, rating_col)).alias("digest"),
        F.sum(entry_digest(other_col, rating_col, at=1)).alias("digest2"))


def basket_lists(ratings: DataFrame, key_col: str, other_col: str, rating_col="stars", size: int = 4096, seed: int = 7) -> DataFrame:
    """The baskets themselves (D1/D2), as lists of ``size`` entries at most: (key, bucket, part, n, entries), entries being
    (other, stars) in the order of other.

    A key with n entries is dealt into ceil(2 n / size) buckets by a hash of the other side, so a hot key is many groups
    that meet in no task; a bucket that still holds more is cut into parts. ``flat_basket`` joins the lists again.
    """
    r = ratings.select(key_col, other_col, rating_col)
    ways = F.ceil(F.lit(2.0) * F.count(F.lit(1)) / F.lit(size)).cast("int")
    many = r.groupBy(key_col).agg(ways.alias("_ways")).filter(F.col("_ways") > 1)
    bucket = (key_hash(other_col, seed=seed, width=7) % F.coalesce("_ways", F.lit(1))).cast("int")
    dealt = r.join(many, key_col, "left").withColumn("bucket", bucket).drop("_ways")
    place = Window.partitionBy(key_col, "bucket").orderBy(other_col, rating_col)
    cut = dealt.withColumn("part", F.floor((F.row_number().over(place) - 1) / size).cast("int"))
    return cut.groupBy(key_col, "bucket", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct(other_col, rating_col))).alias("entries"))


def flat_basket(lists: DataFrame, key_col: str) -> DataFrame:
    """The ratings that ``basket_lists`` was given."""
    return lists.select(key_col, F.inline("entries"))


def entity_counts(ratings: DataFrame, user_col="user_id", item_col="item_id") -> DataFrame:
    return ratings.agg(F.count(F.lit(1)).alias("n_ratings"),
                       F.count_distinct(user_col).alias("n_users"),
                       F.count_distinct(item_col).alias("n_items"))


def dense_index(ids: DataFrame, id_col: str, index_col: str = "idx") -> DataFrame:
    """Consecutive 0-based index in ``id_col`` order, computed distributed.

    Range-partition and sort, take ``monotonically_increasing_id`` (partition
    id in the high bits, position in the low bits), materialise that with a
    reliable checkpoint so both uses below see the same partitions, then add
    the row count of all earlier partitions. Only the per-partition counts
    (one row per partition) are ordered in a single task.
    """
    distinct = ids.select(id_col).distinct()
    tagged = (distinct.orderBy(id_col)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    tagged = (tagged.withColumn("_pid", F.shiftright("_mid", 33))
              .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("_pid", F.coalesce("_off", F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(id_col, (F.col("_off") + F.col("_pos")).cast("long").alias(index_col)))


def bias_baseline(train: DataFrame, reg_item: float = 25.0, reg_user: float = 10.0,
                  user_col="user_id", item_col="item_id", rating_col="stars") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Damped baseline ``mu + b_u + b_i`` (Koren 2010, one pass, items first).

    ``b_i = sum(r - mu) / (reg_item + n_i)``;
    ``b_u = sum(r - mu - b_i) / (reg_user + n_u)``.
    Returns (global, item_bias, user_bias) frames.
    """
    r = train.select(user_col, item_col, F.col(rating_col).cast("double").alias("_r"))
    g = global_mean(train, rating_col)
    rg = attach_row(r, g)
    bi = rg.groupBy(item_col).agg(
        (F.sum(F.col("_r") - F.col("global_mean")) / (F.lit(reg_item) + F.count(F.lit(1)))).alias("b_item"))
    bu = (rg.join(bi, item_col)
          .groupBy(user_col).agg(
              (F.sum(F.col("_r") - F.col("global_mean") - F.col("b_item"))
               / (F.lit(reg_user) + F.count(F.lit(1)))).alias("b_user")))
    return g, bi, bu


def bias_predict(pairs: DataFrame, g: DataFrame, bi: DataFrame, bu: DataFrame,
                 user_col="user_id", item_col="item_id") -> DataFrame:
    """Unknown sides contribute 0 bias."""
    return (attach_row(pairs, g).join(bi, item_col, "left").join(bu, user_col, "left")
            .withColumn("baseline", F.col("global_mean") + F.coalesce("b_user", F.lit(0.0))
                        + F.coalesce("b_item", F.lit(0.0))))
