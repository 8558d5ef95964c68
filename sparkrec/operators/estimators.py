"""``pyspark.ml`` estimators and models of the recommenders, with writers and readers (A10).

An estimator fits on ratings (user_id, item_id, stars); its model's ``transform`` adds
``prediction`` to any frame with user_id and item_id, keeping its rows and columns. A saved
model is a folder: ``manifest`` (one JSON line: class, version, parameters, plain numbers, the
names of tables and of models inside) and a Parquet table or a folder of the same kind for
each name. ``load_model`` reads any of them; nothing refers to where the model was fitted.

A model's tables are written when it is fitted, under the checkpoint folder; ``delete``
removes them. Models that look up ratings at prediction time (item CF, user kNN, Slope One)
hold their training ratings as a table, since the pairs they need follow from the pairs asked.
"""

from __future__ import annotations

import json
from typing import ClassVar

from pyspark.ml import Estimator, Model
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.functions.columns import clamp
from sparkrec.operators import boosting, calibrate, cocluster, itemcf, sgd, slopeone, stack, userknn
from sparkrec.operators import features as FE
from sparkrec.operators.baselines import training_counts
from sparkrec.operators.split import split_halves
from sparkrec.session import drop_materialized, materialize

VERSION = 1
KEYS = ["user_id", "item_id"]


class _Writer(MLWriter):
    def __init__(self, model: RecModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        path, m = path.rstrip("/"), self.model
        spark = SparkSession.active()
        for name, table in m.tables.items():
            table.write.parquet(f"{path}/{name}")
        for name, inner in m.models.items():
            inner.write().save(f"{path}/{name}")
        manifest = {"class": type(m).__name__, "version": VERSION, "options": m.options, "facts": m.facts,
                    "tables": sorted(m.tables), "models": sorted(m.models)}
        # last, so that a folder with a manifest is a whole model
        spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}/manifest")


class _Reader(MLReader):
    def load(self, path: str) -> RecModel:
        return load_model(path)


class RecModel(Model, MLWritable, MLReadable):
    """tables: frames; models: fitted models inside; options: parameters of the operator; facts: plain numbers of the fit."""

    def __init__(self, options: dict | None = None, facts: dict | None = None, tables: dict[str, DataFrame] | None = None,
                 models: dict[str, RecModel] | None = None):
        super().__init__()
        self.options, self.facts, self.tables, self.models = options or {}, facts or {}, tables or {}, models or {}

    def predict(self, pairs: DataFrame) -> DataFrame:
        """(user_id, item_id, prediction) of distinct pairs."""
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = self.predict(dataset.select(*KEYS).distinct()).select(*[F.col(c).alias(f"__{c}") for c in KEYS], "prediction")
        same = F.col("user_id").eqNullSafe(F.col("__user_id")) & F.col("item_id").eqNullSafe(F.col("__item_id"))
        return dataset.join(found, same, "left").drop("__user_id", "__item_id")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    def delete(self) -> None:
        """Removes the tables that fitting wrote; a saved folder stays."""
        for table in self.tables.values():
            drop_materialized(table)
        for inner in self.models.values():
            inner.delete()


MODELS: dict[str, type[RecModel]] = {}


def _model(cls: type[RecModel]) -> type[RecModel]:
    MODELS[cls.__name__] = cls
    return cls


def load_model(path: str, spark: SparkSession | None = None) -> RecModel:
    """Any saved model of this module."""
    spark, path = spark or SparkSession.active(), path.rstrip("/")
    manifest = json.loads(spark.read.text(f"{path}/manifest").first().value)
    if manifest["version"] != VERSION:
        raise ValueError(f"{path}: model version {manifest['version']}, this library reads {VERSION}")
    return MODELS[manifest["class"]](manifest["options"], manifest["facts"], {n: spark.read.parquet(f"{path}/{n}") for n in manifest["tables"]},
                                     {n: load_model(f"{path}/{n}", spark) for n in manifest["models"]})


class RecEstimator(Estimator):
    """options: keyword parameters of the operator's fit or prediction."""

    model: ClassVar[type[RecModel]]

    def __init__(self, **options):
        super().__init__()
        self.options = options

    def _fit(self, dataset: DataFrame) -> RecModel:
        return self.model(self.options, tables={"ratings": materialize(dataset.select(*KEYS, "stars"), "model-ratings")})


# ---------------------------------------------------------------- models over their ratings


@_model
class ItemCFModel(RecModel):
    def predict(self, pairs: DataFrame) -> DataFrame:
        return itemcf.item_cf(self.tables["ratings"], pairs, **self.options).select(*KEYS, "prediction")


class ItemCF(RecEstimator):
    model = ItemCFModel


@_model
class UserKNNModel(RecModel):
    def predict(self, pairs: DataFrame) -> DataFrame:
        return userknn.user_knn(self.tables["ratings"], pairs, **self.options).select(*KEYS, "prediction")


class UserKNN(RecEstimator):
    model = UserKNNModel


@_model
class SlopeOneModel(RecModel):
    def predict(self, pairs: DataFrame) -> DataFrame:
        return slopeone.slope_one(self.tables["ratings"], pairs, **self.options).select(*KEYS, "prediction")


class SlopeOne(RecEstimator):
    model = SlopeOneModel


# ---------------------------------------------------------------- models of fitted tables


@_model
class CoClusteringModel(RecModel):
    def predict(self, pairs: DataFrame) -> DataFrame:
        return cocluster.predict(cocluster.CoClusterModel(**self.tables), pairs).select(*KEYS, "prediction")


class CoClustering(RecEstimator):
    """options: ku, ki, epochs, seed."""

    def _fit(self, dataset: DataFrame) -> RecModel:
        return CoClusteringModel(self.options, tables=dict(vars(cocluster.fit(dataset, **self.options))))


@_model
class FactorisationModel(RecModel):
    def predict(self, pairs: DataFrame) -> DataFrame:
        return sgd.predict(sgd.Model(**self.tables), pairs)


class Factorisation(RecEstimator):
    """options: those of ``sgd.Params``."""

    def _fit(self, dataset: DataFrame) -> RecModel:
        return FactorisationModel(self.options, tables=dict(vars(sgd.fit(dataset, sgd.Params(**self.options)))))


@_model
class ProfileTreesModel(RecModel):
    def predict(self, pairs: DataFrame) -> DataFrame:
        rows = stack.profile_rows(pairs, self.tables["users"], self.tables["items"])
        return stack.score(boosting.Boosted.from_json(self.facts["trees"]), rows)


class ProfileTrees(RecEstimator):
    """Trees on profile features. options: those of ``boosting.Params``."""

    def __init__(self, users: DataFrame, items: DataFrame, **options):
        super().__init__(**options)
        self.users, self.items = users, items

    def _fit(self, dataset: DataFrame) -> RecModel:
        tables = {"users": materialize(self.users, "model-users"), "items": materialize(self.items, "model-items")}
        rows = stack.profile_rows(dataset.select(*KEYS, F.col("stars").cast("double").alias("label")), tables["users"], tables["items"])
        model = boosting.fit(rows, FE.USER_FEATURES_BASIC + FE.ITEM_FEATURES_BASIC, params=boosting.Params(**self.options))
        return ProfileTreesModel(self.options, {"trees": model.to_json()}, tables)


# ---------------------------------------------------------------- the hybrid

BASES = {"f_cf": ItemCF, "f_mf": Factorisation, "f_cc": CoClustering, "f_knn": UserKNN}
OFFSET = ("f_mf", "f_cc", "f_knn")  # shifted by their mean error on the stacker's half
FEATURES = [*FE.USER_FEATURES, *FE.ITEM_FEATURES, *BASES, "n_user", "n_item"]


@_model
class HybridModel(RecModel):
    def features(self, pairs: DataFrame, shifted: bool = True) -> DataFrame:
        """``FEATURES`` of distinct pairs; a missing profile field counts as 0, a base model without a prediction for a pair raises."""
        out = FE.item_lookup(FE.user_lookup(pairs, self.tables["users"]), self.tables["items"])
        out = out.join(training_counts(pairs, self.tables["ratings"]), KEYS)
        missing = F.raise_error(F.lit("a base model has no prediction for a pair")).cast("double")
        for name in BASES:
            out = out.join(self.models[name].predict(pairs).select(*KEYS, F.col("prediction").alias(name)), KEYS, "left")
            shift = F.lit(float(self.facts["offsets"].get(name, 0.0)) if shifted else 0.0)
            out = out.withColumn(name, F.coalesce(F.col(name), missing) + shift)
        return out.select(*KEYS, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES])

    def predict(self, pairs: DataFrame) -> DataFrame:
        known = pairs.dropna(subset=KEYS)
        return stack.score(boosting.Boosted.from_json(self.facts["trees"]), self.features(known), (1.0, 5.0))


class Hybrid(RecEstimator):
    """The stacked recommender: one half of the ratings fits the base models, the other their offsets and the trees.

    options: ``bases`` (options of each base model by feature name), ``trees`` (of ``boosting.Params``), ``seed`` of the split.
    """

    def __init__(self, users: DataFrame, items: DataFrame, **options):
        super().__init__(**options)
        self.users, self.items = users, items

    def _fit(self, dataset: DataFrame) -> RecModel:
        base, rest = split_halves(dataset.select(*KEYS, F.col("stars").cast("double").alias("stars")), seed=self.options.get("seed", 0))
        tables = {"users": materialize(self.users, "model-users"), "items": materialize(self.items, "model-items"),
                  "ratings": materialize(base, "model-ratings")}
        rest = materialize(rest, "model-rest")
        bases = {name: kind(**self.options.get("bases", {}).get(name, {})).fit(tables["ratings"]) for name, kind in BASES.items()}
        model = HybridModel(self.options, {"offsets": {}}, tables, bases)
        rows = materialize(model.features(rest.select(*KEYS).distinct(), shifted=False), "model-rows")
        for name in OFFSET:
            found = calibrate.fit_offset(rows.select(*KEYS, F.col(name).alias("prediction")), rest).first()
            model.facts["offsets"][name] = -float(found.offset or 0.0)
        shifted = rows.select(*KEYS, *[(F.col(c) + F.lit(model.facts["offsets"].get(c, 0.0))).alias(c) for c in FEATURES])
        labelled = shifted.join(rest.select(*KEYS, F.col("stars").alias("label")), KEYS)
        params = boosting.Params(**self.options["trees"]) if "trees" in self.options else stack.HYBRID_GBT
        model.facts["trees"] = boosting.fit(labelled, FEATURES, params=params).to_json()
        for t in (rest, rows):
            drop_materialized(t)
        return model
