"""User profiles (A3), comparison files (A8), truth/prediction dump (A9), model tables (A10)."""

import os
import tempfile

from pyspark.sql import functions as F

from sparkrec.operators import evaluate as EV
from sparkrec.operators import features as FE
from sparkrec.sources import files


def test_user_profiles_and_features(spark):
    d = tempfile.mkdtemp(prefix="sparkrec-io-")
    p = os.path.join(d, "user.json")
    import json

    from sparkrec.sources.schemas import USER_JSON
    # a record of the declared schema with values of our own, counts 0 unless given
    blank = {f.name: 0 for f in USER_JSON if f.dataType.typeName() in ("integer", "long", "double")}
    with open(p, "w") as f:
        f.write(json.dumps(blank | {"user_id": "u1", "name": "Robin", "review_count": 3, "useful": 2, "funny": 1, "cool": 1,
                                    "average_stars": 4.0, "compliment_hot": 3, "compliment_cool": 1}) + "\n")
        f.write(json.dumps(blank | {"user_id": "u2", "review_count": 1, "fans": 2, "average_stars": 2.0}) + "\n")
    prof = files.read_user_profiles(spark, p)
    feats = {r.user_id: r for r in FE.user_features(prof).collect()}
    assert feats["u1"].u_useful == 0.5 and feats["u1"].u_compliment_hot == 0.75
    assert feats["u2"].u_useful == 0.0 and feats["u2"].u_fans == 2.0      # zero totals left unchanged
    pairs = spark.createDataFrame([("u1", "b"), ("u9", "b")], "user_id string, item_id string")
    look = {r.user_id: r for r in FE.user_lookup(pairs, prof).collect()}
    assert look["u9"].u_average_stars == 2.5 and look["u9"].u_review_count == 0.0


def test_comparison_file_best_of(spark):
    d = tempfile.mkdtemp(prefix="sparkrec-io-")
    p = os.path.join(d, "comparison.csv")
    with open(p, "w") as f:
        f.write("user,item,c2,p3,p4,p5\nu1,b1,3.0,1.0,4.5,2.0\nu2,b1,-999,5.0,5.0,5.0\n")
    cmp = files.read_comparison(spark, p)
    truth = spark.createDataFrame([("u1", "b1", 4.0), ("u2", "b1", 1.0)], "user_id string, item_id string, stars double")
    j = cmp.join(truth.withColumnRenamed("stars", "label"), ["user_id", "item_id"])
    r = EV.best_of_models(j, ["p3", "p4", "p5"], "label", check_col="c2").collect()[0]
    assert r["count"] == 1 and r["avg_diff"] == 0.5


def test_truth_dump_and_model_tables(spark):
    d = tempfile.mkdtemp(prefix="sparkrec-io-")
    df = spark.createDataFrame([(4.0, 3.5), (2.0, 2.5)], "label double, prediction double")
    files.write_truth_vs_prediction(df, os.path.join(d, "cmp"))
    back = spark.read.option("header", True).csv(os.path.join(d, "cmp"))
    assert back.columns == ["true", "pred"] and back.count() == 2
    w = spark.createDataFrame([(1, 2, 40, 0.5)], "x long, y long, n_co long, weight double")
    files.save_tables({"weights": w}, os.path.join(d, "model"))
    got = files.load_tables(spark, os.path.join(d, "model"), ["weights"])["weights"]
    assert got.collect()[0].weight == 0.5


def test_candidate_lines_are_all_kept(spark, tmp_path):
    """Blank ids stay, each line equal to the header goes, and several files are numbered by name."""
    one = tmp_path / "pairs.csv"
    one.write_text("user_id,business_id,stars\nu1,b1,3\n,b2,4\nuser_id,business_id,stars\nuser_id,b3,2\nu4,,1\n")
    rows = files.read_candidates(spark, str(one)).orderBy("row_no").collect()
    assert [(r.user_id, r.item_id, r.stars) for r in rows] == [("u1", "b1", 3.0), (None, "b2", 4.0), ("user_id", "b3", 2.0), ("u4", None, 1.0)]
    (tmp_path / "more.csv").write_text("user_id,business_id,stars\nu9,b9,3\n")
    both = files.read_candidates(spark, str(tmp_path)).orderBy("row_no").collect()
    assert [(r.user_id, r.item_id) for r in both] == [("u9", "b9"), ("u1", "b1"), (None, "b2"), ("user_id", "b3"), ("u4", None)]
