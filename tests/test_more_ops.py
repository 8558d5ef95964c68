"""Co-clustering vs plain Python, sweep consistency, dense index, switching blend."""

import random

import pytest
from pyspark.sql import functions as F

import bruteforce as BF
from sparkrec.operators import baselines as B
from sparkrec.operators import blend, cocluster, itemcf


def _ratings(seed, n_users=14, n_items=7, density=0.6):
    rng = random.Random(seed)
    return [(u, i, float(rng.randint(1, 5))) for u in range(n_users) for i in range(n_items) if rng.random() < density]


@pytest.mark.parametrize("seed", [31, 32])
def test_co_cluster_matches_bruteforce(spark, seed):
    ratings = _ratings(seed)
    pairs = [(u, i) for u in range(16) for i in range(9)]
    tr = spark.createDataFrame(ratings, "user_id long, item_id long, stars double")
    cand = spark.createDataFrame(pairs, "user_id long, item_id long")
    m = cocluster.fit(tr, ku=3, ki=2, epochs=3)
    got = {(r.user_id, r.item_id): r.prediction for r in cocluster.predict(m, cand).collect()}
    want = BF.co_cluster(ratings, pairs, ku=3, ki=2, epochs=3)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9), k


def test_sweep_equals_single_runs(spark):
    ratings = _ratings(33, 20, 8, 0.7)
    pairs = [(u, i) for u in range(22) for i in range(9)]
    tr = spark.createDataFrame(ratings, "user_id long, item_id long, stars double")
    cand = spark.createDataFrame(pairs, "user_id long, item_id long")
    sw = itemcf.item_cf_sweep(tr, cand, [0, 3, 6], [2, 20], clamp_range=(0.0, 5.0)).collect()
    sweep = {(r.min_co, r.k, r.user_id, r.item_id): r.prediction for r in sw}
    for t in (0, 3, 6):
        for k in (2, 20):
            one = itemcf.item_cf(tr, cand, k=k, min_co=t, clamp_range=(0.0, 5.0)).collect()
            for r in one:
                assert sweep[(t, k, r.user_id, r.item_id)] == pytest.approx(r.prediction, abs=1e-12)


def test_dense_index_consecutive(spark):
    ids = spark.range(0, 5000, 7, numPartitions=6).select(F.col("id").cast("string").alias("k"))
    got = B.dense_index(ids, "k").collect()
    order = sorted(r.k for r in got)
    assert sorted(r.idx for r in got) == list(range(len(order)))
    assert {r.k: r.idx for r in got} == {k: n for n, k in enumerate(order)}


def test_switch_blend_picks_lowest_rmse_per_bucket(spark):
    train = spark.createDataFrame([(1, 1, 3.0)] + [(2, i, 3.0) for i in range(6)], "user_id long, item_id long, stars double")
    hold = spark.createDataFrame([(1, 9, 4.0), (2, 9, 2.0), (3, 9, 5.0)], "user_id long, item_id long, stars double")
    good_for_light = spark.createDataFrame([(1, 9, 4.0), (2, 9, 5.0), (3, 9, 1.0)], "user_id long, item_id long, prediction double")
    good_for_heavy = spark.createDataFrame([(1, 9, 1.0), (2, 9, 2.0), (3, 9, 5.0)], "user_id long, item_id long, prediction double")
    out = blend.switch_blend({"a": good_for_light, "b": good_for_heavy}, train, hold).collect()
    chosen = {r.user_id: (r.bucket, r.model) for r in out}
    assert chosen[1] == (1, "a")     # 1 rating -> bucket 1
    assert chosen[2] == (2, "b")     # 6 ratings -> bucket 2
    assert chosen[3] == (0, "b")     # unknown user -> bucket 0


def test_switch_blend_keeps_pairs_of_unlabelled_buckets(spark):
    train = spark.createDataFrame([(1, 1, 3.0)], "user_id long, item_id long, stars double")
    hold = spark.createDataFrame([(1, 9, 4.0)], "user_id long, item_id long, stars double")
    a = spark.createDataFrame([(1, 9, 1.0), (7, 9, 2.0)], "user_id long, item_id long, prediction double")
    b = spark.createDataFrame([(1, 9, 4.0), (7, 9, 5.0)], "user_id long, item_id long, prediction double")
    out = {r.user_id: (r.model, r.prediction) for r in blend.switch_blend({"a": a, "b": b}, train, hold).collect()}
    assert out == {1: ("b", 4.0), 7: ("a", 2.0)}   # no label for user 7's bucket: the first listed model


def test_weights_do_not_depend_on_row_order(spark):
    """Pairs whose centred sum is exactly 0 weigh exactly 0, however rows are ordered and dealt out."""
    rng = random.Random(5)
    rows = []
    for g in range(12):   # items (2g, 2g + 1): orthogonal deviations around non-terminating means
        for u, (x, y) in enumerate([(1.0, 1.0), (1.0, 5.0), (5.0, 1.0), (5.0, 5.0), (3.0, 2.0), (3.0, 4.0), (3.0, 3.0)]):
            rows += [(100 * g + u, 2 * g, x), (100 * g + u, 2 * g + 1, y)]
    pairs = spark.createDataFrame([(2 * g, 2 * g + 1) for g in range(12)], "x long, y long")
    seen = set()
    for parts in (1, 2, 5, 7):
        rng.shuffle(rows)
        train = spark.createDataFrame(rows, "user_id long, item_id long, stars double").repartition(parts)
        w = itemcf.weight_from_stats(itemcf.co_rating_stats(train, pairs), 0, 2.5)
        got = sorted((r.x, r.n_co, r.sab, r.saa, r.sbb, r.weight) for r in w.collect())
        assert len(got) == 12 and all(r[2] == 0 and r[5] == 0 for r in got)
        seen.add(tuple(got))
    assert len(seen) == 1
