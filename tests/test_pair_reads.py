"""Slope One and the sweep read the statistics of pairs over arrays: odd rows, long lists, hot items and many chunks give what joins give."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkrec.operators import itemcf, pair_reads, pairs, slopeone


def tables(spark, kind="long"):
    """Repeated keys, nulls on each side, unrated items, a user of long lists, a hot item."""
    r = np.random.default_rng(8)
    rated = [(u, int(i), int(r.integers(1, 6))) for u in range(40) for i in {0, *r.choice(25, 7, replace=False)}]
    rated += rated[:9] + [(3, None, 4), (4, None, None), (None, 4, 2), (5, 24, None), (6, 30, None)] + [(77, i, 1 + i % 5) for i in range(25)]
    asked = [(u, int(i)) for u in range(45) for i in r.choice(28, 6, replace=False)] + [(3, None), (None, 4), (None, None), (6, 30)] + [(77, i) for i in range(25)]
    train = spark.createDataFrame(rated, "user_id long, item_id long, stars int")
    cand = spark.createDataFrame(asked + asked[:5], "user_id long, item_id long")
    if kind == "string":
        train, cand = (t.withColumn("user_id", F.concat(F.lit("u"), "user_id")).withColumn("item_id", F.concat(F.lit("i"), "item_id")) for t in (train, cand))
    return train, cand


def by_joins(train, cand):
    """Slope One as plain joins, a row for each (user, target, rated item); a null item counts as the target itself."""
    r = train.select("user_id", "item_id", F.col("stars").cast("double").alias("stars"))
    g = r.agg(F.avg("stars")).first()[0]
    um = r.groupBy("user_id").agg(F.avg("stars").alias("m"))
    pairs_ = cand.select("user_id", "item_id").distinct()
    known = pairs_.join(um.select("user_id"), "user_id", "left_semi").join(r.select("item_id").distinct(), "item_id", "left_semi")
    expand = itemcf.by_pair(itemcf.candidate_expand(known, train))
    d = slopeone.deviations(train, itemcf.canonical_needed(expand), None).select("x", "y", "dev")
    dev = F.when(F.col("item_id") == F.col("x"), F.col("dev")).otherwise(-F.col("dev"))
    top = expand.join(d, ["x", "y"]).groupBy("user_id", "item_id").agg(F.avg(dev).alias("d"))
    out = pairs_.join(um, "user_id", "left").join(known.withColumn("k", F.lit(True)), ["user_id", "item_id"], "left").join(top, ["user_id", "item_id"], "left")
    return out.select("user_id", "item_id", F.when(F.col("k").isNull(), g).otherwise(F.col("m") + F.coalesce("d", F.lit(0.0))).alias("prediction"))


def same(got, want, keys, value="prediction"):
    one, two = ({tuple(r[k] for k in keys): r[value] for r in t.collect()} for t in (got, want))
    assert one.keys() == two.keys() and one
    for k, v in two.items():
        assert (one[k] is None) == (v is None) and (v is None or one[k] == pytest.approx(v, abs=1e-9)), k


@pytest.mark.parametrize(("kind", "small"), [("long", True), ("string", False)])
def test_slope_one_reads_what_joins_read(spark, monkeypatch, kind, small):
    if small:
        for name, value in (("PIECE", 8), ("CELL_PAIRS", 400), ("HOT_ROWS", 20)):
            monkeypatch.setattr(pair_reads, name, value)
    train, cand = tables(spark, kind)
    for light_max in (128, 9)[:1 + small]:  # with 9, the user of 25 ratings is heavy
        same(slopeone.slope_one(train, cand, None, light_max), by_joins(train, cand), ["user_id", "item_id"])


@pytest.mark.parametrize(("small", "thresholds"), [(True, [0, 3]), (False, [4, 2])])
def test_sweep_equals_single_runs_on_odd_rows(spark, monkeypatch, small, thresholds):
    if small:
        for name, value in (("PIECE", 8), ("CELL_PAIRS", 400), ("HOT_ROWS", 20)):
            monkeypatch.setattr(pair_reads, name, value)
    train, cand = tables(spark)
    train = train.filter("item_id is not null and stars is not null")
    ks = (2, 20) if small else (3,)
    sweep = itemcf.item_cf_sweep(train, cand, thresholds, list(ks)).cache()
    for t in thresholds:
        for k in ks:
            same(sweep.filter((F.col("min_co") == t) & (F.col("k") == k)), itemcf.item_cf(train, cand, k, t, clamp_range=(0.0, 5.0)), ["user_id", "item_id"])


def test_candidates_are_not_shuffled_pair_by_pair(spark):
    """What goes to the other side and back is a row for each candidate or rating, with arrays."""
    train, cand = tables(spark)
    for found in (slopeone.slope_one(train, cand), itemcf.item_cf_sweep(train, cand, [0, 5], [3])):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "WindowGroupLimit" not in plan


def test_chunks_of_rows_give_what_all_give(monkeypatch):
    """Asked rows and tops in chunks of a few pairs; a top's rows leave while others still come."""
    r = np.random.default_rng(2)
    rated = [[{"at": int(i), "pos": int(9 - i), "stars": float(r.integers(1, 6))} for i in r.choice(10, 6, replace=False)] for _ in range(30)]
    b = pa.RecordBatch.from_pylist([{"user_id": f"u{n}", "asked_piece": 0, "asked": r.choice(10, 3, replace=False).tolist(), "rated": x} for n, x in enumerate(rated)])
    tops = pa.RecordBatch.from_pylist([{"user_id": f"u{n % 4}", "ts": [n % 3] * 5, "ps": r.choice(90, 5, replace=False).tolist(), "rs": [1.0, 2.0, 3.0, None, 5.0],
                                        "ws": r.choice([0.25, 0.5, 0.75], 5).tolist(), "ns": r.integers(0, 9, 5).tolist()} for n in range(60)])
    found = []
    for chunk in (1 << 18, 7):
        monkeypatch.setattr(pair_reads, "CHUNK", chunk)
        monkeypatch.setattr(itemcf, "CHUNK", chunk)
        asked = sorted((x["user_id"], x["mine"], x["k"], *sorted(zip(x["es"], x["ps"] if x["mine"] else x["ps"] * 9, strict=False))) for out in pair_reads._asks(True)([b]) for x in out.to_pylist())
        top = sorted((x["user_id"], x["at"], *map(str, x["num"]), *map(str, x["den"])) for out in itemcf._tops([0, 4], [2, 3], pa.string())([tops.slice(n, 6) for n in range(0, 60, 6)])
                     for x in out.to_pylist())
        found.append((asked, top))
    assert found[0] == found[1] and len(found[0][0]) > 60


def test_sums_are_exact_beyond_longs(spark):
    """Totals whose products pass 64 bits are added up as whole numbers of any size."""
    rows = [(1, 2, 3, 10**9, 2 * 10**9, 7 * 10**14, 5 * 10**14, 9 * 10**14, 3_000_001, 2_000_003, 10**10 + 1, 10**10 + 3), (1, 3, 2, 7, 9, 31, 25, 41, 2, 3, 8, 11)]
    names = ["x", "y", *itemcf.TOTALS]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in names)).coalesce(1)
    got = {r.y: r for r in frame.mapInArrow(itemcf._centred, "x bigint, y bigint, n_co bigint, sab double, saa double, sbb double").collect()}
    for row in rows:
        _, y, n, a, b, ab, aa, _, nx, ny, tx, ty = row
        assert got[y].sab == float(nx * ny * ab - nx * ty * a - ny * tx * b + n * tx * ty) / (nx * ny) / 1e6
        assert got[y].saa == float(nx * nx * aa - 2 * nx * tx * a + n * tx * tx) / (nx * nx) / 1e6


def test_a_written_table_leaves_no_shuffle_files(spark):
    from sparkrec.session import CLEANUP, materialize

    before = spark.conf.get(CLEANUP, None)
    count = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size
    had = count()
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert materialize(frame, "t").count() == 7
    assert count() <= had + 1  # of the last count only
    assert spark.conf.get(CLEANUP, None) == before


def test_numbers_follow_the_rarest_first(spark):
    train, _ = tables(spark)
    items = sorted(pair_reads.numbered(train).items.collect(), key=lambda r: r.at)
    assert [(r._deg, r.item_id) for r in items] == sorted((r._deg, r.item_id) for r in items)
    assert [r.item_id for r in sorted(items, key=lambda r: r.pos)] == sorted(r.item_id for r in items)
    assert pairs.DEFAULT_LIGHT_MAX >= max(r.n for r in train.groupBy("user_id").agg(F.count("*").alias("n")).collect())
