"""Rating, candidate and profile views derived from the TPC-H-like test tables.

These are the Spark side of FIXTURES.md §3. Every view is derived from the
whole tables (no id subsets), so its size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.operators.baselines import dedupe_latest, dense_index

# Fixed values of the fixture definitions (FIXTURES.md).
COLD_OFFSET = 1_000_000_000          # id offset of carved-out cold users/items
COLD_USER_MOD = 40                   # every 40th user of half B gets a cold twin
COLD_ITEM_MOD = 10                   # every 10th item of half B gets a cold twin
NULL_ATTRS_MOD, NULL_ATTRS_REM = 7, 3
EVENT_STARS = [("purchase", 5), ("signup", 4), ("click", 3), ("view", 2)]  # anything else: 1
# user-profile vote columns counted from event types
VOTE_EVENTS = [("useful", "view"), ("funny", "click"), ("cool", "purchase"), ("fans", "signup")]
COMPLIMENTS = ["hot", "more", "profile", "cute", "list", "note", "plain", "cool", "funny",
               "writer", "photos"]
# attribute flag keys of the item profile, with their (key offset, truth offset)
ATTR_FLAGS = [("BusinessAcceptsCreditCards", 0, 0), ("GoodForKids", 1, 2),
              ("RestaurantsReservations", 2, 4), ("RestaurantsGoodForGroups", 3, 6),
              ("RestaurantsTakeOut", 5, 10), ("OutdoorSeating", 6, 12), ("HasTV", 7, 14)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _stars_from_quantity() -> F.Column:
    return F.ceil(F.col("l_quantity") / 10).cast("int")


def ratings_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x supplier; the latest purchase wins."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, F.col("o_orderkey") == F.col("l_orderkey"))
    rows = j.select(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("item_id"),
                    _stars_from_quantity().alias("stars"), "l_shipdate", "l_quantity")
    return dedupe_latest(rows, ["user_id", "item_id"], "stars", ["l_shipdate", "l_quantity"])


def ratings_bt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x (brand/type); string item ids."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    j = (li.join(o, F.col("o_orderkey") == F.col("l_orderkey"))
         .join(p, F.col("p_partkey") == F.col("l_partkey")))
    rows = j.select(F.col("o_custkey").alias("user_id"),
                    F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")).alias("item_id"),
                    _stars_from_quantity().alias("stars"), "l_shipdate", "l_quantity")
    return dedupe_latest(rows, ["user_id", "item_id"], "stars", ["l_shipdate", "l_quantity"])


def event_k() -> F.Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def ratings_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: user x props.k, stars from the event type."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    stars = F.lit(1)
    for name, s in reversed(EVENT_STARS):
        stars = F.when(F.col("event_type") == name, F.lit(s)).otherwise(stars)
    rows = e.select("user_id", event_k().alias("item_id"), stars.alias("stars"), "ts", "event_id")
    return dedupe_latest(rows, ["user_id", "item_id"], "stars", ["ts", "event_id"])


RATINGS = {"supp": ratings_supp, "bt": ratings_bt, "ev": ratings_ev}


def ratings(spark: SparkSession, sf_dir: str, name: str = "supp") -> DataFrame:
    return RATINGS[name](spark, sf_dir)


def _cold_item(item: F.Column, string_ids: bool) -> tuple[F.Column, F.Column]:
    """(selector, cold id) for carving out cold items."""
    if string_ids:
        sel = F.conv(F.substring(F.md5(item), 1, 4), 16, 10).cast("int") % COLD_ITEM_MOD == 0
        return sel, F.concat(item, F.lit("~cold"))
    return item % COLD_ITEM_MOD == 0, item + F.lit(COLD_OFFSET)


def candidates(half_b: DataFrame, string_items: bool = False, row_no: bool = False) -> DataFrame:
    """Half B plus cold-user, cold-item and both-cold twins; ``stars`` is the label."""
    u, i = F.col("user_id"), F.col("item_id")
    cu = u % COLD_USER_MOD == 0
    ci, cold_i = _cold_item(i, string_items)
    cold_u = u + F.lit(COLD_OFFSET)
    ways = [(F.lit(True), u, i), (cu, cold_u, i), (ci, u, cold_i), (cu & ci, cold_u, cold_i)]
    twin = F.explode(F.array(*[F.struct(k.alias("k"), a.alias("u"), b.alias("i")) for k, a, b in ways])).alias("t")
    out = half_b.select("stars", twin).filter("t.k").select(F.col("t.u").alias("user_id"), F.col("t.i").alias("item_id"), "stars")
    if row_no:
        # input-line number: position in (user, item) order, as a file would carry it
        key = F.struct("user_id", "item_id")
        idx = dense_index(out.select(key.alias("_k")), "_k", "row_no")
        out = (out.withColumn("_k", key).join(idx, "_k").drop("_k")
               .select("row_no", "user_id", "item_id", "stars"))
    return out


def user_profile(spark: SparkSession, sf_dir: str, half_a: DataFrame) -> DataFrame:
    """Review-site-style user rows: averages from half A, votes/compliments from events."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    r = half_a.groupBy("user_id").agg(F.avg(F.col("stars").cast("double")).alias("average_stars"),
                                      F.count(F.lit(1)).alias("review_count"))
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "props")
    k = event_k()
    aggs = [F.sum(F.when(F.col("event_type") == ev, 1).otherwise(0)).alias(col) for col, ev in VOTE_EVENTS]
    aggs += [F.sum(F.when(k % 11 == n, 1).otherwise(0)).alias(f"compliment_{c}") for n, c in enumerate(COMPLIMENTS)]
    votes = e.groupBy("user_id").agg(*aggs)
    out = cust.join(r, "user_id", "left").join(votes, "user_id", "left")
    cols = [F.col("user_id"), F.coalesce("average_stars", F.lit(2.5)).alias("average_stars"),
            F.coalesce("review_count", F.lit(0)).cast("long").alias("review_count")]
    cols += [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c, _ in VOTE_EVENTS]
    cols += [F.coalesce(f"compliment_{c}", F.lit(0)).cast("long").alias(f"compliment_{c}") for c in COMPLIMENTS]
    return out.select(*cols)


def _attr_json(s: F.Column) -> F.Column:
    parts = [F.lit('{"WiFi":"free"')]
    for key, ko, to in ATTR_FLAGS:
        val = (F.when((s + ko) % 5 == 0, F.lit("null"))
               .when((s + to) % 3 == 0, F.lit('"True"')).otherwise(F.lit('"False"')))
        parts.append(F.when((s + ko) % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(f',"{key}":'), val)))
    alc = (F.when(s % 13 == 0, F.lit("null")).when(s % 3 == 0, F.lit('"none"'))
           .otherwise(F.lit('"full_bar"')))
    # Alcohol sits between the 4th and 5th flag in the text; order is irrelevant to a map
    parts.insert(5, F.when((s + 4) % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(',"Alcohol":'), alc)))
    parts.append(F.lit("}"))
    return F.when(s % NULL_ATTRS_MOD == NULL_ATTRS_REM, F.lit(None).cast("string")).otherwise(F.concat(*parts))


def item_profile(spark: SparkSession, sf_dir: str, half_a: DataFrame) -> DataFrame:
    """Review-site-style business rows over suppliers; ``attributes`` is JSON text."""
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("item_id"))
    r = half_a.groupBy("item_id").agg(
        (F.round(F.avg(F.col("stars").cast("double")) * 2) / 2).alias("stars"),
        F.count(F.lit(1)).alias("review_count"))
    out = sup.join(r, "item_id", "left")
    return out.select("item_id", F.coalesce("stars", F.lit(2.5)).alias("stars"),
                      F.coalesce("review_count", F.lit(0)).cast("long").alias("review_count"),
                      _attr_json(F.col("item_id")).alias("attributes"))
