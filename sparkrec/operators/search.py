"""Search over settings of any recommender, and stacking on out-of-fold predictions.

A setting is a name and a function of nothing that gives an estimator (``estimators``: its fitted
model's ``transform`` predicts). Folds are a key hash of (user, item), written once, and serve
every setting alike. ``halving`` scores all settings on the first folds, keeps the better half for
the next ones, and so on; the last ones are scored on every fold. Every setting's score is
returned with the number of folds behind it, and an order that says where it went out.

``out_of_fold`` predicts every rating by models that were fitted without its fold, which is what a
stacker may learn from: ``stacked_blend`` weighs the models by least squares on these predictions
and then uses them fitted on all ratings.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.functions.columns import attach_row, clamp
from sparkrec.operators.blend import blend_moments, solve_weights
from sparkrec.operators.split import with_fold
from sparkrec.session import drop_materialized, materialize

KEYS = ["user_id", "item_id"]
Settings = dict[str, Callable[[], Estimator]]


def _folds(ratings: DataFrame, n_folds: int, seed: int) -> DataFrame:
    rows = ratings.select(*KEYS, F.col("stars").cast("double").alias("stars"))
    return materialize(with_fold(rows, n_folds, seed=seed), "search-folds")


def _error(make: Callable[[], Estimator], folds: DataFrame, fold: int) -> tuple[float, int]:
    """Sum of squared errors and rows of one fold, by a model of the others."""
    model = make().fit(folds.filter(F.col("fold") != fold).drop("fold"))
    held = folds.filter(F.col("fold") == fold).drop("fold")
    d = F.col("prediction") - F.col("stars")
    found = model.transform(held).agg(F.coalesce(F.sum(d * d), F.lit(0.0)).alias("s"), F.count("prediction").alias("n")).first()
    if hasattr(model, "delete"):
        model.delete()
    return found.s, found.n


def halving(ratings: DataFrame, settings: Settings, n_folds: int = 3, seed: int = 1) -> DataFrame:
    """(setting, rmse, n_folds, place): every setting's error over the folds that it was scored on; place 1 is the best.

    Rungs: after each fold the settings are ordered by their error so far and the better half (rounded up) stays, until one
    is left or the folds are used up. Settings that stayed longer come first, then lower errors, then names.
    """
    folds = _folds(ratings, n_folds, seed)
    scores: dict[str, list[tuple[float, int]]] = {name: [] for name in settings}
    alive = sorted(settings)

    def rmse(name: str) -> float:
        total, n = (sum(x[k] for x in scores[name]) for k in (0, 1))
        return (total / n) ** 0.5 if n else float("inf")

    for fold in range(n_folds):
        for name in alive:
            scores[name].append(_error(settings[name], folds, fold))
        if len(alive) > 1:
            alive = sorted(alive, key=lambda s: (round(rmse(s), 9), s))[:-(-len(alive) // 2)]
    drop_materialized(folds)
    order = sorted(settings, key=lambda s: (-len(scores[s]), round(rmse(s), 9), s))
    rows = [(s, rmse(s), len(scores[s]), n) for n, s in enumerate(order, 1)]  # a row for each setting
    return ratings.sparkSession.createDataFrame(rows, "setting string, rmse double, n_folds int, place int")


def out_of_fold(ratings: DataFrame, settings: Settings, n_folds: int = 3, seed: int = 1) -> DataFrame:
    """Written (user_id, item_id, stars, one column for each setting): predictions by models that didn't see the rating's fold."""
    folds = _folds(ratings, n_folds, seed)
    parts, written = [], []
    for fold in range(n_folds):
        held = folds.filter(F.col("fold") == fold).drop("fold")
        for name, make in settings.items():
            model = make().fit(folds.filter(F.col("fold") != fold).drop("fold"))
            held = materialize(model.transform(held).withColumnRenamed("prediction", name), "search-held")
            written.append(held)
            if hasattr(model, "delete"):
                model.delete()
        parts.append(held)
    done = materialize(reduce(DataFrame.unionByName, parts), "search-out-of-fold")
    for t in [folds, *written]:
        drop_materialized(t)
    return done


def stacked_blend(ratings: DataFrame, settings: Settings, pairs: DataFrame, n_folds: int = 3, seed: int = 1,
                  clamp_range: tuple[float, float] | None = (1.0, 5.0)) -> DataFrame:
    """(user_id, item_id, prediction) of distinct pairs: least-squares weights from out-of-fold predictions, models of all ratings."""
    names = list(settings)
    seen = out_of_fold(ratings, settings, n_folds, seed)
    weights = solve_weights(blend_moments(seen, names, "stars"), len(names))
    wide = pairs.select(*KEYS).distinct()
    for name in names:
        wide = settings[name]().fit(ratings).transform(wide).withColumnRenamed("prediction", name)
    out = attach_row(wide, weights)
    pred = F.col("w0")
    for i, name in enumerate(names, 1):
        pred = pred + F.col(f"w{i}") * F.col(name)
    if clamp_range is not None:
        pred = clamp(pred, *clamp_range)
    done = materialize(out.select(*KEYS, pred.alias("prediction")), "search-blend")
    drop_materialized(seen)
    return done
