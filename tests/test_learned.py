"""Learned models on planted low-rank data (the fixtures' stars are noise).

Ratings come from ``spark.range``: user and item factors from key hashes,
stars = clip(3 + 1.5 * <p_u, q_i>, 1, 5). MF must beat the bias baseline."""

from pyspark.sql import functions as F

from sparkrec.functions.columns import key_hash
from sparkrec.operators import baselines as B
from sparkrec.operators import evaluate as EV
from sparkrec.operators import mf
from sparkrec.operators.split import split_halves


def _planted(spark, n_users=120, n_items=60, density=0.5):
    g = spark.range(n_users * n_items).select((F.col("id") / n_items).cast("long").alias("user_id"),
                                              (F.col("id") % n_items).alias("item_id"))
    g = g.filter(key_hash("user_id", "item_id", seed=7) % 100 < int(density * 100))

    def f(col, seed):
        return (key_hash(col, seed=seed) % 200 - 100) / 100.0

    dot = f("user_id", 1) * f("item_id", 2) + f("user_id", 3) * f("item_id", 4)
    stars = F.greatest(F.lit(1.0), F.least(F.lit(5.0), F.lit(3.0) + 1.5 * dot))
    return g.withColumn("stars", stars)


def test_mf_beats_bias_baseline(spark):
    r = _planted(spark)
    a, b = split_halves(r)
    rm_mf = EV.eval_report(mf.predict(mf.fit(a, rank=4, max_iter=15, reg=0.05), b), b).collect()[0]["rmse"]
    g, bi, bu = B.bias_baseline(a)
    base = B.bias_predict(b.select("user_id", "item_id"), g, bi, bu).withColumnRenamed("baseline", "prediction")
    rm_base = EV.eval_report(base, b).collect()[0]["rmse"]
    assert rm_mf < 0.8 * rm_base, (rm_mf, rm_base)
