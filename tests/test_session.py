"""Session helpers: lineage cut by a written table, and its removal."""

import os

from pyspark.sql import functions as F

from sparkrec.session import drop_materialized, ensure_checkpoint_dir, materialize


def test_materialize_round_trip_and_drop(spark):
    base = ensure_checkpoint_dir(spark)
    assert base
    df = spark.range(100).withColumn("sq", F.col("id") * F.col("id"))
    m = materialize(df, "unit")
    assert m.count() == 100 and m.agg(F.sum("sq")).collect()[0][0] == sum(i * i for i in range(100))
    path = m._sparkrec_path
    local = path.replace("file:", "")
    assert os.path.isdir(local)
    drop_materialized(m)
    assert not os.path.exists(local)
    drop_materialized(df)          # a frame that was never written: no-op
