"""Settings of any model by successive halving, and blends on out-of-fold predictions."""

import numpy as np
import pytest
from pyspark.ml import Estimator, Model
from pyspark.sql import functions as F

from sparkrec.functions.columns import key_hash
from sparkrec.operators import estimators as E
from sparkrec.operators import search as S
from sparkrec.operators.split import with_fold


class ConstantModel(Model):
    def __init__(self, value):
        super().__init__()
        self.value = value

    def _transform(self, dataset):
        return dataset.withColumn("prediction", F.lit(self.value))


class Mean(Estimator):
    """The training mean and a shift: a model whose errors can be worked out by hand."""

    def __init__(self, shift):
        super().__init__()
        self.shift = shift

    def _fit(self, dataset):
        return ConstantModel(dataset.agg(F.avg("stars").alias("m")).first().m + self.shift)


@pytest.fixture(scope="module")
def ratings(spark):
    g = spark.range(24 * 12).select(F.concat(F.lit("u"), (F.col("id") / 12).cast("int")).alias("user_id"), F.concat(F.lit("i"), F.col("id") % 12).alias("item_id"))
    stars = (key_hash("user_id", seed=1) % 3 + key_hash("item_id", seed=2) % 3 + 1).cast("double")
    return g.filter(key_hash("user_id", "item_id", seed=3) % 100 < 70).withColumn("stars", stars)


def by_fold(ratings, n):
    return [(r.fold, r.stars) for r in with_fold(ratings, n, seed=1).collect()]


def test_halving_scores_every_setting(spark, ratings):
    """Five shifts, three folds: errors by hand, half goes out after each fold."""
    shifts = {"a": 0.0, "b": 0.1, "c": -0.4, "d": 1.0, "e": 2.0}
    got = {r.setting: r for r in S.halving(ratings, {k: (lambda v=v: Mean(v)) for k, v in shifts.items()}).collect()}
    rows = by_fold(ratings, 3)

    def rmse(shift, folds):
        errors = [np.mean([s for f, s in rows if f != k]) + shift - s for k in range(folds) for f, s in rows if f == k]
        return float(np.sqrt(np.mean(np.square(errors))))

    first = sorted(shifts, key=lambda s: rmse(shifts[s], 1))
    second = sorted(first[:3], key=lambda s: rmse(shifts[s], 2))
    for name in shifts:
        folds = 1 if name not in first[:3] else 2 if name not in second[:2] else 3
        assert got[name].n_folds == folds and got[name].rmse == pytest.approx(rmse(shifts[name], folds))
    assert [r.place for r in sorted(got.values(), key=lambda r: (-r.n_folds, r.rmse))] == [1, 2, 3, 4, 5]


def test_real_models_and_their_out_of_fold_predictions(spark, ratings):
    settings = {"cf": lambda: E.ItemCF(k=5, min_co=2), "steps": lambda: E.Factorisation(rank=2, epochs=3, lr=0.05)}
    seen = S.out_of_fold(ratings, settings, n_folds=2)
    assert seen.columns == ["user_id", "item_id", "stars", "cf", "steps"] and seen.count() == ratings.count()
    folded = with_fold(ratings, 2, seed=1)
    want = E.ItemCF(k=5, min_co=2).fit(folded.filter("fold = 1")).transform(folded.filter("fold = 0").select("user_id", "item_id"))
    expected = {tuple(r)[:2]: r.prediction for r in want.collect()}
    found = {(r.user_id, r.item_id): r.cf for r in seen.collect()}
    assert {k: found[k] for k in expected} == pytest.approx(expected)
    blended = {(r.user_id, r.item_id): r.prediction for r in S.stacked_blend(ratings, settings, ratings, n_folds=2, clamp_range=None).collect()}
    rows = seen.collect()
    a = np.array([[1.0, r.cf, r.steps] for r in rows])
    w = np.linalg.lstsq(a, np.array([r.stars for r in rows]), rcond=None)[0]
    parts = [{(r.user_id, r.item_id): r.prediction for r in make().fit(ratings).transform(ratings.select("user_id", "item_id")).collect()} for make in settings.values()]
    assert blended == pytest.approx({k: w[0] + w[1] * parts[0][k] + w[2] * parts[1][k] for k in blended}, abs=1e-6)
    assert len(blended) == ratings.count()
