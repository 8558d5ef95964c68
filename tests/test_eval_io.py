"""Evaluation edge cases, splits, and file round trips."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sparkrec.operators import evaluate as EV
from sparkrec.operators.split import split_halves
from sparkrec.sources import files


def test_report_edges(spark):
    pred = spark.createDataFrame([("a", "x", 3.0), ("a", "y", 5.0), ("b", "x", -999.0), ("b", "y", 1.0),
                                  ("c", "x", 4.0)], "user_id string, item_id string, prediction double")
    truth = spark.createDataFrame([("a", "x", 3.0), ("a", "y", 1.0), ("b", "x", 2.0), ("b", "y", 3.0),
                                   ("c", "x", 5.0)], "user_id string, item_id string, stars double")
    r = EV.eval_report(pred, truth).collect()[0].asDict()
    assert r["count"] == 4                         # placeholder skipped
    assert r["count_0_1"] == 1 and r["count_1_2"] == 1 and r["count_2_3"] == 1 and r["count_4_5"] == 1
    assert r["pos_count"] == 1 and r["neg_count"] == 2   # zero error is neither
    assert r["avg_pos_diff"] == 4.0 and r["avg_neg_diff"] == -1.5
    assert r["rmse"] == pytest.approx(((0 + 16 + 4 + 1) / 4) ** 0.5)


def test_report_no_positive_and_empty(spark):
    pred = spark.createDataFrame([("a", "x", 2.0)], "user_id string, item_id string, prediction double")
    truth = spark.createDataFrame([("a", "x", 3.0)], "user_id string, item_id string, stars double")
    r = EV.eval_report(pred, truth).collect()[0]
    assert r["avg_pos_diff"] == -999.0 and r["avg_neg_diff"] == -1.0
    empty = EV.eval_report(pred.filter("false"), truth).collect()[0]
    assert empty["count"] == 0 and empty["rmse"] is None


def test_strict_join_raises(spark):
    pred = spark.createDataFrame([("a", "x", 2.0), ("z", "z", 1.5)], "user_id string, item_id string, prediction double")
    truth = spark.createDataFrame([("a", "x", 3.0)], "user_id string, item_id string, stars double")
    with pytest.raises(Exception, match="prediction without truth"):
        EV.eval_report(pred, truth).collect()
    assert EV.eval_report(pred, truth, strict=False).collect()[0]["count"] == 1


def test_best_of_first_wins_tie(spark):
    df = spark.createDataFrame([(1.0, 3.0, 5.0, 4.0, 4.0)], "c2 double, p3 double, p4 double, p5 double, label double")
    r = EV.best_of_models(df, ["p3", "p4", "p5"], check_col="c2").collect()[0]
    assert r["count"] == 1 and r["avg_diff"] == 0.0    # p5 exact; p3 and p4 tie at 1 behind it


def test_halves_disjoint_complete(spark):
    r = spark.range(2000).select((F.col("id") % 97).alias("user_id"), (F.col("id") % 89).alias("item_id"),
                                 F.lit(3).alias("stars")).distinct()
    a, b = split_halves(r)
    assert a.count() + b.count() == r.count()
    assert a.join(b, ["user_id", "item_id"]).count() == 0


def test_csv_json_round_trip(spark):
    d = tempfile.mkdtemp(prefix="sparkrec-io-")
    rp = os.path.join(d, "train.csv")
    with open(rp, "w") as f:
        f.write("user_id,business_id,stars\nu1,b1,4.0\nuser_id,business_id,stars\nu2,b1,2.5\n")
    r = files.read_ratings(spark, rp)
    assert sorted(map(tuple, r.collect())) == [("u1", "b1", 4.0), ("u2", "b1", 2.5)]
    cp = os.path.join(d, "val.csv")
    with open(cp, "w") as f:
        f.write("user_id,business_id,stars\nu2,b9,3.0\nu1,b1,5.0\nu2,b9,3.0\n")
    c = files.read_candidates(spark, cp)
    pred = c.withColumn("prediction", F.lit(3.5))
    out = os.path.join(d, "pred")
    files.write_predictions(pred, out)
    text = "".join(open(os.path.join(out, p)).read() for p in sorted(os.listdir(out)) if p.endswith(".csv"))
    lines = [ln for ln in text.splitlines() if ln]
    assert lines[0] == "user_id, business_id, prediction"      # every part file starts with it
    body = [ln for ln in lines if ln != lines[0]]
    assert [ln.split(",")[:2] for ln in body] == [["u2", "b9"], ["u1", "b1"], ["u2", "b9"]]
    back = files.read_predictions(spark, out)
    assert back.count() == 3
    ip = os.path.join(d, "business.json")
    with open(ip, "w") as f:
        f.write('{"business_id":"b1","stars":4.0,"review_count":3,"attributes":{"GoodForKids":"False","HasTV":null,"Alcohol":"none"}}\n')
        f.write('{"business_id":"b2","stars":3.0,"review_count":1,"attributes":null}\n')
    from sparkrec.operators import features as FE
    items = files.read_item_profiles(spark, ip)
    got = {r.item_id: r for r in FE.item_features(items).collect()}
    assert got["b1"].i_kids == 0.0 and got["b1"].i_tv == 0.0 and got["b1"].i_alcohol == 0.0
    assert got["b1"].i_credit == 0.5 and got["b2"].i_kids == 0.5
    pres = {r.item_id: r for r in FE.item_features(items, mode="presence").collect()}
    assert pres["b1"].i_kids == 1.0        # the reference's truthiness of the text "False"


def test_line_order_survives_split_input(spark):
    """A file read as many splits still yields row_no in line order, and the
    sink writes the lines back in that order (E6)."""
    d = tempfile.mkdtemp(prefix="sparkrec-io-")
    p = os.path.join(d, "pairs.csv")
    rows = [(f"u{(n * 37) % 101}", f"b{(n * 11) % 23}") for n in range(400)]
    with open(p, "w") as f:
        f.write("user_id,business_id,stars\n")
        for u, b in rows:
            f.write(f"{u},{b},3.0\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        c = files.read_candidates(spark, p)
        assert c.rdd.getNumPartitions() > 4
        got = [(r.user_id, r.item_id) for r in c.orderBy("row_no").collect()]
        assert got == rows
        out = os.path.join(d, "pred")
        files.write_predictions(c.withColumn("prediction", F.lit(1.0)), out)
        text = "".join(open(os.path.join(out, q)).read() for q in sorted(os.listdir(out)) if q.endswith(".csv"))
        body = [ln.split(",")[:2] for ln in text.splitlines() if ln and not ln.startswith("user_id")]
        assert [tuple(x) for x in body] == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_truth_of_attributes_follows_their_json_type(spark, tmp_path):
    """Presence mode: texts are true unless empty, JSON values by what they are; from files, JSON text and maps of texts."""
    import json

    from pyspark.sql import functions as F

    from oracle_compare import duck
    from sparkrec.operators import features as FE
    from sparkrec.plans.q_data import _item_feature_sql
    from sparkrec.sources import files

    key, column = "HasTV", "i_tv"
    true = ["0", "false", "False", "{}", "[]", "none", " ", 1, 0.5, True, {"a": False}, [0]]
    false = ["", 0, 0.0, False, {}, [], None]
    lines = [{"business_id": f"b{i}", "stars": 3.0, "review_count": 1, "attributes": {key: v}} for i, v in enumerate([*true, *false])]
    lines += [{"business_id": "absent", "stars": 3.0, "review_count": 1, "attributes": {"Other": "x"}}, {"business_id": "null", "stars": 3.0, "review_count": 1, "attributes": None}]
    path = tmp_path / "items.json"
    path.write_text("\n".join(map(json.dumps, lines)))
    want = {f"b{i}": float(i < len(true)) for i in range(len(true) + len(false))} | {"absent": 0.5, "null": 0.5}
    items = files.read_item_profiles(spark, str(path))
    assert {r.item_id: r[column] for r in FE.item_features(items, mode="presence").collect()} == want
    rows = [(x["business_id"], x["stars"], 1, None if x["attributes"] is None else json.dumps(x["attributes"])) for x in lines]
    texts = spark.createDataFrame(rows, "item_id string, stars double, review_count long, attributes string")
    assert {r.item_id: r[column] for r in FE.item_features(texts, mode="presence").collect()} == want
    con = duck("/root/testdata/sf0.001")
    con.execute("create table item_profile(item_id varchar, stars double, review_count bigint, attributes varchar)")
    con.executemany("insert into item_profile values (?, ?, ?, ?)", rows)
    twin = con.execute(_item_feature_sql(False, "presence"))
    at = [d[0] for d in twin.description]
    assert {r[at.index("item_id")]: r[at.index(column)] for r in twin.fetchall()} == want
    plain = texts.withColumn("attributes", F.from_json("attributes", "map<string,string>")).filter("item_id in ('b0', 'b1', 'b12', 'null')")
    assert {r.item_id: r[column] for r in FE.item_features(plain, mode="presence").collect()} == {"b0": 1.0, "b1": 1.0, "b12": 0.0, "null": 0.5}
    parsed = {r.item_id: r[column] for r in FE.item_features(items).collect()}
    assert parsed["b0"] == parsed["b1"] == parsed["b2"] == parsed["b5"] == 0.0 and parsed["b9"] == 1.0


def test_comparison_works_predictions_out_once(spark, monkeypatch):
    from types import SimpleNamespace

    from sparkrec.plans import q_eval as Q

    rated = spark.createDataFrame([(u, i, 1 + (u + i) % 5) for u in range(6) for i in range(4) if (u + i) % 3], "user_id long, item_id long, stars int")
    asked = spark.createDataFrame([(n, u, i, 1 + u % 5) for n, (u, i) in enumerate((u, i) for u in range(7) for i in range(5))],
                                  "row_no long, user_id long, item_id long, stars int")
    calls, real = [], Q.cf_predictions
    monkeypatch.setattr(Q, "cf_predictions", lambda ctx: calls.append(1) or real(ctx))
    rows = Q.comparison_table(SimpleNamespace(half_a=rated, candidates=asked.drop("row_no"), candidates_rn=asked)).collect()
    assert len(calls) == 1 and len(rows) == 35
    assert all(r.c2 == (-999.0 if r.row_no % Q.PLACEHOLDER_EVERY == 0 else r.p5) for r in rows)
