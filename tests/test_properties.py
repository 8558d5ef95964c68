"""Property tests (hypothesis): report invariants and clamped predictions."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkrec.operators import evaluate as EV
from sparkrec.operators import itemcf

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

stars = st.sampled_from([1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0])
preds = st.one_of(st.floats(min_value=-1.0, max_value=7.0, allow_nan=False), st.just(-999.0))


@settings(**SETTINGS)
@given(st.lists(st.tuples(preds, stars), min_size=1, max_size=40))
def test_report_invariants(spark, rows):
    data = [(f"u{n}", "i", p, t) for n, (p, t) in enumerate(rows)]
    pred = spark.createDataFrame([(u, i, p) for u, i, p, _ in data], "user_id string, item_id string, prediction double")
    truth = spark.createDataFrame([(u, i, t) for u, i, _, t in data], "user_id string, item_id string, stars double")
    r = EV.eval_report(pred, truth).collect()[0].asDict()
    kept = [(p, t) for p, t in rows if p != -999.0]
    assert r["count"] == len(kept)
    assert sum(r[h] for h in EV.HIST_NAMES) == r["count"]
    assert r["pos_count"] + r["neg_count"] <= r["count"]
    if kept:
        assert abs(r["rmse"] - math.sqrt(sum((p - t) ** 2 for p, t in kept) / len(kept))) < 1e-9


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 4), stars), min_size=3, max_size=30,
                unique_by=lambda x: (x[0], x[1])),
       st.sampled_from([(1.0, 5.0), (0.0, 5.0), (2.0, 3.0)]))
def test_item_cf_predictions_inside_clamp(spark, ratings, bounds):
    tr = spark.createDataFrame(ratings, "user_id int, item_id int, stars double")
    cand = spark.createDataFrame([(u, i) for u in range(8) for i in range(6)], "user_id int, item_id int")
    lo, hi = bounds
    out = itemcf.item_cf(tr, cand, k=3, min_co=1, clamp_range=bounds).collect()
    assert len(out) == 48
    assert all(lo <= r.prediction <= hi for r in out)
