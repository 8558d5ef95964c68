"""Pairs of baskets travel as arrays, one row for a rating or a candidate: no pair is shuffled to be found or summed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrec.operators import itemcf, pairs, slopeone


def tables(spark, odd=False, seed=5):
    r = np.random.default_rng(seed)
    rated = [(u, int(i), int(r.integers(1, 6))) for u in range(40) for i in {0, *r.choice(25, 7, replace=False)}]
    asked = [(u, int(i)) for u in range(45) for i in r.choice(28, 6, replace=False)]
    if odd:  # repeated keys, nulls, a user of long lists
        rated += rated[:9] + [(3, None, 4), (None, 4, 2), (5, 24, None)] + [(77, i, 1 + i % 5) for i in range(25)]
        asked += asked[:9] + [(3, None), (None, 4), (4, None)] + [(77, i) for i in range(25)]
    return (spark.createDataFrame(rated, "user_id long, item_id long, stars int"),
            spark.createDataFrame(asked, "user_id long, item_id long"), rated, asked)


def above_shuffles(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("piece", [128, 3])
def test_needed_pairs_are_those_of_the_expansion(spark, monkeypatch, odd, piece):
    monkeypatch.setattr(pairs, "PIECE", piece)
    train, cand, _, _ = tables(spark, odd)
    want = itemcf.canonical_needed(itemcf.candidate_expand(cand, train)).collect()
    found = itemcf.needed(cand, train)
    assert "Generate explode" in above_shuffles(found)
    assert sorted(map(str, found.collect())) == sorted(map(str, want)) and want


@pytest.mark.parametrize("odd", [False, True])
def test_sums_of_baskets_equal_plain_ones(spark, odd):
    train, _, rated, _ = tables(spark, odd)
    want = {}
    for u, i, a in rated:
        for v, j, b in rated:
            if u is not None and u == v and None not in (i, j) and i <= j:
                s = want.setdefault((i, j), [0] * 6)
                here = [1, a, b, None if None in (a, b) else a * b, None if a is None else a * a, None if b is None else b * b]
                for n, x in enumerate(here):
                    s[n] += x or 0
    found = pairs.pair_sums(train, None, "item_id", "user_id", exact=False)
    assert "Generate posexplode" in above_shuffles(found)
    unit = [1, 1000, 1000, 1000 ** 2, 1000 ** 2, 1000 ** 2]
    got = {(r.x, r.y): [r.n, r.a, r.b, r.ab, r.aa, r.bb] for r in found.collect()}
    assert got == {p: [x * f for x, f in zip(s, unit, strict=True)] for p, s in want.items()}


def test_deviations_with_and_without_a_heavy_rater(spark):
    train, cand, _, _ = tables(spark)
    cand = cand.filter("user_id < 40 and item_id < 25")
    asked = itemcf.needed(cand, train)
    rows = [sorted((r.x, r.y, r.n_co, round(r.dev, 9)) for r in slopeone.deviations(train, asked, light_max=m).collect()) for m in (128, 7, None)]
    assert rows[0] == rows[1] == rows[2] and rows[0]


def test_predictions_take_frequent_pairs_without_the_expansion(spark):
    train, cand, _, _ = tables(spark)
    expand = itemcf.candidate_expand(cand, train)
    loose, few = itemcf.frequent_needed(expand, train, 3, exact=False)
    exact, _ = itemcf.frequent_needed(expand, train, 3)
    more = {tuple(r) for r in loose.collect()}
    assert few and {tuple(r) for r in exact.collect()} <= more
    often = {tuple(r) for r in pairs.frequent_pairs(train, "item_id", "user_id", 3).collect()}
    assert often <= more and loose.filter(F.col("x") != F.col("y")).count() == len(often)
