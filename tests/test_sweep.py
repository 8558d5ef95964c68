"""Tops under nested thresholds from one ranking."""

import numpy as np
import pytest

from sparkrec.operators import itemcf


def rows_of(n, seed, ties=False):
    r = np.random.default_rng(seed)
    return [(int(r.integers(0, 4)), int(r.integers(0, 3)), o, int(r.integers(0, 40)), float(r.integers(-2, 4)) if ties else float(r.normal(0.2, 1)), 3.0)
            for o in range(n)]


@pytest.mark.parametrize(("ties", "cut"), [(False, True), (True, True), (True, False)])
def test_tops_of_all_thresholds(spark, ties, cut):
    rows = rows_of(900, 3, ties)
    frame = spark.createDataFrame(rows, "user_id long, item_id long, other long, n_co long, weight double, r_other double")
    ts, k = [35, 0, 10, 20], 7
    got = itemcf.nested_topk(frame, ts, k, cut).collect()
    for t in ts:
        want = {}
        for u in range(4):
            for i in range(3):
                here = sorted((-w, o) for a, b, o, n, w, _ in rows if (a, b) == (u, i) and n >= t and w > 0)[:k]
                want |= {(u, i, o): place for place, (_, o) in enumerate(here, 1)}
        assert {(r.user_id, r.item_id, r.other): r[f"rank_{t}"] for r in got if r[f"rank_{t}"]} == want
    assert len(got) <= 4 * 3 * k * len(ts)


def test_rows_are_not_copied_and_are_cut_before_the_shuffle(spark):
    frame = spark.createDataFrame(rows_of(50, 1), "user_id long, item_id long, other long, n_co long, weight double, r_other double")
    plan = itemcf.nested_topk(frame, [0, 10, 20, 25, 30, 35], 20)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("WindowGroupLimit") >= 2


def test_a_row_behind_k_of_its_band_is_in_no_top(spark):
    """One hot pair: thousands of neighbours, as many rows as k for each band."""
    frame = spark.range(5000).selectExpr("1L user_id", "1L item_id", "id other", "id % 50 n_co", "1.0 / (id + 1) weight", "3.0D r_other")
    got = itemcf.nested_topk(frame, [0, 10, 35], 20)
    assert got.count() <= 60
    assert [r.other for r in got.where("rank_35 = 1").collect()] == [35]


def test_baskets_rebuild_exactly_and_a_hot_key_is_many_groups(spark):
    from sparkrec.operators import baselines as B

    rows = [("hot", f"i{n}", float(n % 5)) for n in range(3000)] + [("cold", "i1", 2.0), ("warm", None, 1.0), (None, "i2", 3.0)]
    frame = spark.createDataFrame(rows, "user_id string, item_id string, stars double")
    lists = B.basket_lists(frame, "user_id", "item_id", size=50)
    got = lists.collect()
    assert max(r.n for r in got) <= 50 and len({r.bucket for r in got if r.user_id == "hot"}) > 60
    assert all(r.n == len(r.entries) for r in got)
    assert sorted(map(tuple, B.flat_basket(lists, "user_id").collect()), key=str) == sorted(rows, key=str)


def test_ratings_finer_than_the_unit_raise(spark):
    train = spark.createDataFrame([(u, i, 3.0005) for u in range(3) for i in range(2)], "user_id long, item_id long, stars double")
    with pytest.raises(Exception, match="finer"):
        itemcf.item_cf(train, train, min_co=0).collect()
