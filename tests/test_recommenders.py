"""DataFrame recommenders against plain-Python semantics on small random data,
plus hand-worked fallback cases."""

import random

import pytest
from pyspark.sql import functions as F

import bruteforce as BF
from sparkrec.operators import itemcf, slopeone, userknn


def _random_ratings(seed, n_users=12, n_items=6, density=0.6, half=False):
    rng = random.Random(seed)
    rows = []
    for u in range(n_users):
        for i in range(n_items):
            if rng.random() < density:
                r = rng.randint(1, 5) if not half else rng.randint(2, 10) / 2
                rows.append((u, i, float(r)))
    return rows


def _pairs(seed, n_users=12, n_items=6):
    rng = random.Random(seed + 100)
    ps = {(rng.randrange(n_users + 2), rng.randrange(n_items + 2)) for _ in range(30)}
    return sorted(ps)


def _df(spark, rows, cols):
    return spark.createDataFrame(rows, cols)


def _as_dict(df):
    return {(r["user_id"], r["item_id"]): r["prediction"] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("min_co,k", [(0, 20), (3, 2)])
def test_item_cf_matches_bruteforce(spark, seed, min_co, k):
    ratings = _random_ratings(seed, half=seed == 3)
    pairs = _pairs(seed)
    got = _as_dict(itemcf.item_cf(_df(spark, ratings, "user_id long, item_id long, stars double"),
                                  _df(spark, pairs, "user_id long, item_id long"), k=k, min_co=min_co))
    want = BF.item_cf(ratings, pairs, k=k, min_co=min_co)
    assert set(got) == set(want)
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9), key


@pytest.mark.parametrize("seed", [4, 5])
def test_user_knn_matches_bruteforce(spark, seed):
    ratings = _random_ratings(seed, density=0.4)
    pairs = _pairs(seed)
    got = _as_dict(userknn.user_knn(_df(spark, ratings, "user_id long, item_id long, stars double"),
                                    _df(spark, pairs, "user_id long, item_id long"), k=3))
    want = BF.user_knn(ratings, pairs, k=3)
    assert set(got) == set(want)
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9), key


@pytest.mark.parametrize("seed", [6, 7])
def test_slope_one_matches_bruteforce(spark, seed):
    ratings = _random_ratings(seed, density=0.5)
    pairs = _pairs(seed)
    got = _as_dict(slopeone.slope_one(_df(spark, ratings, "user_id long, item_id long, stars double"),
                                      _df(spark, pairs, "user_id long, item_id long")))
    want = BF.slope_one(ratings, pairs)
    assert set(got) == set(want)
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9), key


def test_item_cf_routes_and_string_ids(spark):
    # u1, u2 rate a and b identically-centred; c is unseen; u9 is unseen
    rows = [("u1", "a", 5.0), ("u1", "b", 4.0), ("u2", "a", 1.0), ("u2", "b", 2.0), ("u3", "a", 3.0)]
    train = _df(spark, rows, "user_id string, item_id string, stars double")
    cand = _df(spark, [("u3", "b"), ("u1", "c"), ("u9", "a"), ("u9", "c"), ("u2", "a")],
               "user_id string, item_id string")
    got = {(r.user_id, r.item_id): (r.prediction, r.route)
           for r in itemcf.item_cf(train, cand, min_co=2).collect()}
    assert got[("u1", "c")] == (4.5, "cold_item")          # user mean
    assert got[("u9", "c")] == (2.5, "both_cold")          # fixed default
    assert got[("u9", "a")] == (3.0, "cold_user")          # item mean over all raters
    assert got[("u3", "b")][1] == "neighbors"              # w(a,b) = 1 with 2 co-raters
    assert got[("u3", "b")][0] == pytest.approx(3.0)
    assert got[("u2", "a")][1] == "neighbors"              # target among its own neighbours


def test_weights_symmetric_and_bounded(spark):
    ratings = _random_ratings(11, n_users=20, n_items=8, density=0.7)
    train = _df(spark, ratings, "user_id long, item_id long, stars double")
    items = spark.range(8).select(F.col("id").alias("item_id"))
    xy = items.select(F.col("item_id").alias("x")).crossJoin(items.select(F.col("item_id").alias("y")))
    # the scanning path takes any pair orientation
    w = itemcf.weight_from_stats(itemcf.co_rating_stats(train, xy, light_max=None), 0, 2.5).collect()
    d = {(r.x, r.y): r.weight for r in w}
    for (x, y), v in d.items():
        assert abs(v) <= 1 + 1e-12
        assert d[(y, x)] == pytest.approx(v, abs=1e-12)
    # heavy/light split (every rater heavy, every rater light, mixed) equals the scan
    canon = xy.filter("x <= y")
    for lm in (0, 3, 100):
        w2 = itemcf.weight_from_stats(itemcf.co_rating_stats(train, canon, light_max=lm), 0, 2.5).collect()
        d2 = {(r.x, r.y): (r.n_co, r.weight) for r in w2}
        assert len(d2) == len([k for k in d if k[0] <= k[1]])
        for (x, y), (n, v) in d2.items():
            assert v == pytest.approx(d[(x, y)], abs=1e-12)


def test_result_unchanged_under_repartition(spark):
    ratings = _random_ratings(12, n_users=15, n_items=7)
    pairs = _pairs(12, 15, 7)
    train = _df(spark, ratings, "user_id long, item_id long, stars double")
    cand = _df(spark, pairs, "user_id long, item_id long")
    a = _as_dict(itemcf.item_cf(train, cand, min_co=2))
    b = _as_dict(itemcf.item_cf(train.repartition(7), cand.repartition(3), min_co=2))
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key], abs=1e-12)


def _skewed(seed, n_users=30, n_items=8):
    """User 0 rates every item and holds about a third of all rows; item 0 is
    rated by everyone (a hot item)."""
    rng = random.Random(seed)
    rows = [(0, i, float(rng.randint(1, 5))) for i in range(n_items)]
    for u in range(1, n_users):
        rows.append((u, 0, float(rng.randint(1, 5))))
        if rng.random() < 0.15:
            rows.append((u, rng.randrange(1, n_items), float(rng.randint(1, 5))))
    return sorted(set({(u, i): (u, i, r) for u, i, r in rows}.values()))


@pytest.mark.parametrize("light_max", [None, 0, 2, 128])
def test_skewed_input_all_paths_agree(spark, light_max):
    ratings = _skewed(21)
    pairs = [(u, i) for u in range(0, 31, 3) for i in range(9)]
    tr = _df(spark, ratings, "user_id long, item_id long, stars double")
    cand = _df(spark, pairs, "user_id long, item_id long")
    got = _as_dict(itemcf.item_cf(tr, cand, k=3, min_co=1, light_max=light_max))
    want = BF.item_cf(ratings, pairs, k=3, min_co=1)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9), key
    so = _as_dict(slopeone.slope_one(tr, cand, light_max=light_max))
    for key, v in BF.slope_one(ratings, pairs).items():
        assert so[key] == pytest.approx(v, abs=1e-9), key
    kn = _as_dict(userknn.user_knn(tr, cand, k=4, light_max=light_max))
    for key, v in BF.user_knn(ratings, pairs, k=4).items():
        assert kn[key] == pytest.approx(v, abs=1e-9), key
