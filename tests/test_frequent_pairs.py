"""Pairs that can't reach the threshold leave before their sums and the candidates' expansion are shuffled; the result is the same."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrec.operators import itemcf, pairs


def ratings(spark, n_users=60, n_items=30, heavy=False, seed=3):
    r = np.random.default_rng(seed)
    rows = [(u, int(i), int(r.integers(1, 6))) for u in range(n_users) for i in r.choice(n_items, 8, replace=False)]
    if heavy:
        rows += [(1000, i, 1 + i % 5) for i in range(n_items)]
    return spark.createDataFrame(rows, "user_id long, item_id long, stars int")


def counts(train):
    a, b = (train.select("user_id", F.col("item_id").alias(c)) for c in "xy")
    return {(r.x, r.y): r["count"] for r in a.join(b, "user_id").filter("x < y").groupBy("x", "y").count().collect()}


def test_only_frequent_pairs_are_needed(spark):
    train = ratings(spark)
    enough = {p for p, n in counts(train).items() if n >= 6}
    assert 0 < len(enough) < len(counts(train))
    found = pairs.frequent_pairs(train, "item_id", "user_id", 6)
    assert sorted(map(tuple, found.collect())) == sorted(enough)
    cand = train.select("user_id", ((F.col("item_id") + 1) % 30).alias("item_id")).distinct()
    expand = itemcf.candidate_expand(cand, train)
    needed, few = itemcf.frequent_needed(expand, train, 6)
    asked = {tuple(r) for r in itemcf.canonical_needed(expand).collect()}
    got = {tuple(r) for r in needed.collect()}
    assert few and got == {p for p in asked if p in enough or p[0] == p[1]}


def test_a_heavy_rater_leaves_the_pairs_as_they_are(spark):
    train = ratings(spark, heavy=True)
    assert pairs.frequent_pairs(train, "item_id", "user_id", 6, light_max=20) is None
    expand = itemcf.candidate_expand(train, train)
    needed, few = itemcf.frequent_needed(expand, train, 6, light_max=20)
    assert not few and needed.count() == itemcf.canonical_needed(expand).count()


@pytest.mark.parametrize("room", [1 << 18, 10, 0])
@pytest.mark.parametrize("light_max", [128, 20, None])
def test_predictions_are_the_same(spark, monkeypatch, room, light_max):
    monkeypatch.setattr(itemcf, "BROADCAST_PAIRS", room)
    train = ratings(spark, heavy=light_max == 20)
    cand = train.select("user_id", ((F.col("item_id") + 1) % 32).alias("item_id")).distinct()
    got = itemcf.item_cf(train, cand, k=4, min_co=4, light_max=light_max)
    whole = itemcf.candidate_expand(cand, train)
    stats = itemcf.co_rating_stats(train, itemcf.canonical_needed(whole), light_max=None)
    w = itemcf.both_orientations(itemcf.weight_from_stats(stats, 4, 2.5))
    top = itemcf.topk_neighbors(whole.join(w, ["item_id", "other"]), 4).groupBy("user_id", "item_id").agg(
        (F.sum(F.col("r_other") * F.col("weight")) / F.sum("weight")).alias("p"))
    want = {(r.user_id, r.item_id): round(min(5.0, max(1.0, r.p)), 9) for r in top.collect()}
    found = {(r.user_id, r.item_id): round(r.prediction, 9) for r in got.filter("route = 'neighbors'").collect()}
    assert want and found == want
