"""Models as estimators: fit, save, load in another session, equal predictions."""

import json

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sparkrec.functions.columns import key_hash
from sparkrec.operators import boosting, cocluster, itemcf, sgd, stack, userknn
from sparkrec.operators import estimators as E
from sparkrec.operators import features as FE
from sparkrec.session import materialize


@pytest.fixture(scope="module")
def tables(spark):
    """Ratings, asked pairs (repeated and unknown ones too) and profiles."""
    g = spark.range(30 * 14).select(F.concat(F.lit("u"), (F.col("id") / 14).cast("int")).alias("user_id"), F.concat(F.lit("i"), F.col("id") % 14).alias("item_id"))
    stars = (key_hash("user_id", seed=1) % 3 + key_hash("item_id", seed=2) % 3 + 1).cast("double")
    ratings = materialize(g.filter(key_hash("user_id", "item_id", seed=3) % 100 < 70).withColumn("stars", stars), "test-ratings")
    asked = g.filter(key_hash("user_id", "item_id", seed=3) % 100 >= 60).withColumn("note", F.lit("kept"))
    more = spark.createDataFrame([("u1", "i1", "twice"), ("u1", "i1", "twice"), ("nobody", "i1", "new"), ("u1", "nothing", "new"), ("nobody", "nothing", "new")],
                                 "user_id string, item_id string, note string")
    users = ratings.groupBy("user_id").agg(F.avg("stars").alias("average_stars"), F.count("*").alias("review_count")).select(
        "*", F.lit(2).alias("fans"), *[F.lit(n).alias(c) for n, c in enumerate([*FE.VOTES, *FE.COMPLIMENTS])])
    items = ratings.groupBy("item_id").agg(F.avg("stars").alias("stars"), F.count("*").alias("review_count")).withColumn("attributes", F.lit('{"HasTV":"True"}'))
    return ratings, materialize(asked.unionByName(more), "test-asked"), materialize(users, "test-users"), materialize(items, "test-items")


def rows(frame):
    return sorted((tuple(r) for r in frame.select("user_id", "item_id", "note", "prediction").collect()), key=str)


SMALL_TREES = {"trees": 4, "depth": 3, "alpha": 1.0}
SMALL_STEPS = {"rank": 3, "epochs": 2}


def build(name, users, items):
    return {"ItemCF": lambda: E.ItemCF(k=5, min_co=2), "UserKNN": lambda: E.UserKNN(k=4), "SlopeOne": lambda: E.SlopeOne(),
            "CoClustering": lambda: E.CoClustering(ku=3, ki=2, epochs=2), "Factorisation": lambda: E.Factorisation(**SMALL_STEPS),
            "ProfileTrees": lambda: E.ProfileTrees(users, items, **SMALL_TREES),
            "Hybrid": lambda: E.Hybrid(users, items, trees=SMALL_TREES, bases={"f_cf": {"min_co": 2}, "f_mf": SMALL_STEPS, "f_cc": {"epochs": 1}})}[name]()


@pytest.mark.parametrize("name", ["ItemCF", "UserKNN", "SlopeOne", "CoClustering", "Factorisation", "ProfileTrees", "Hybrid"])
def test_fit_save_load_predict(spark, tables, tmp_path, name):
    ratings, asked, users, items = tables
    model = build(name, users, items).fit(ratings)
    before = rows(model.transform(asked))
    assert len(before) == asked.count() and all(r[3] is not None for r in before)
    path = str(tmp_path / "model")
    model.write().save(path)
    model.delete()  # nothing but the folder is left
    again = E.load_model(path, spark.newSession())
    assert type(again) is type(model) and again.options == model.options
    asked_there = again.tables[next(iter(again.tables))].sparkSession.read.parquet(asked._sparkrec_path)
    assert rows(again.transform(asked_there)) == before
    with pytest.raises(Exception, match="(?i)exist"):
        again.write().save(path)


def test_the_models_give_what_the_operators_give(spark, tables):
    ratings, asked, users, items = tables
    pairs = asked.select("user_id", "item_id").distinct()

    def same(model, frame):
        got = {tuple(r)[:2]: r.prediction for r in model.transform(pairs).collect()}
        assert got == pytest.approx({(r.user_id, r.item_id): r.prediction for r in frame.collect()})

    same(E.ItemCF(k=5, min_co=2).fit(ratings), itemcf.item_cf(ratings, pairs, k=5, min_co=2))
    same(E.UserKNN(k=4).fit(ratings), userknn.user_knn(ratings, pairs, k=4))
    same(E.CoClustering(ku=3, ki=2, epochs=2).fit(ratings), cocluster.predict(cocluster.fit(ratings, 3, 2, 2), pairs))
    same(E.Factorisation(**SMALL_STEPS).fit(ratings), sgd.predict(sgd.fit(ratings, sgd.Params(**SMALL_STEPS)), pairs))
    same(E.ProfileTrees(users, items, **SMALL_TREES).fit(ratings), stack.profile_gbt(ratings, pairs, users, items, boosting.Params(**SMALL_TREES)))


def test_in_a_pipeline_and_other_versions(spark, tables, tmp_path):
    ratings, asked, _, _ = tables
    model = Pipeline(stages=[E.ItemCF(min_co=2)]).fit(ratings).stages[0]
    assert model.transform(asked).count() == asked.count()
    path = tmp_path / "model"
    model.write().save(str(path))
    manifest = json.loads(spark.read.text(str(path / "manifest")).first().value)
    assert manifest["class"] == "ItemCFModel" and manifest["tables"] == ["ratings"]
    spark.createDataFrame([(json.dumps(manifest | {"version": 99}),)], "value string").write.mode("overwrite").text(str(path / "manifest"))
    with pytest.raises(ValueError, match="version 99"):
        E.ItemCFModel.load(str(path))
