"""Stratified gradient descent against one serial run, and against least squares on planted factors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrec.functions.columns import key_hash
from sparkrec.operators import evaluate as EV
from sparkrec.operators import mf, sgd

SCHEMA = "user_id string, item_id long, stars double, b double, cell int"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 0.0, 1) for r in rows], SCHEMA).repartition(parts)


def ratings(n_users, n_items, share, seed=1):
    r = np.random.default_rng(seed)
    return [(f"u{u}", i, float(r.integers(1, 6))) for u in range(n_users) for i in range(n_items) if r.random() < share]


def serial(spark, rows, p):
    """Every rating once an epoch, in the documented order, one plain step after another."""
    keyed = frame(spark, rows).select(
        "user_id", "item_id", "stars", sgd._block("user_id", p.blocks, p.seed).alias("a"), sgd._block("item_id", p.blocks, p.seed + 1).alias("c"),
        F.array(*[F.xxhash64(F.lit(e), F.col("user_id"), F.col("item_id").cast("string")) for e in range(p.epochs)]).alias("turn")).collect()
    mean = sum(r.stars for r in keyed) / len(keyed)
    bu, bi = {r.user_id: 0.0 for r in keyed}, {r.item_id: 0.0 for r in keyed}
    pu = {u: sgd.start_factors(u, "u", p.rank, p.seed) for u in bu}
    qi = {i: sgd.start_factors(str(i), "i", p.rank, p.seed) for i in bi}
    for e in range(p.epochs):
        for r in sorted(keyed, key=lambda r: ((r.c - r.a) % p.blocks, r.a, r.turn[e], r.stars)):
            u, i = r.user_id, r.item_id
            err = r.stars - (mean + bu[u] + bi[i] + float(pu[u] @ qi[i]))
            bu[u] += p.lr * (err - p.reg * bu[u])
            bi[i] += p.lr * (err - p.reg * bi[i])
            pu[u], qi[i] = pu[u] + p.lr * (err * qi[i] - p.reg * pu[u]), qi[i] + p.lr * (err * pu[u] - p.reg * qi[i])
    return bu, bi, pu, qi


@pytest.mark.parametrize("blocks", [1, 3])
def test_equals_a_serial_run(spark, blocks):
    rows = ratings(25, 12, 0.5)
    p = sgd.Params(rank=4, epochs=3, lr=0.05, reg=0.1, blocks=blocks)
    m = sgd.fit(frame(spark, rows), p)
    bu, bi, pu, qi = serial(spark, rows, p)
    users, items = ({r[0]: r for r in t.collect()} for t in (m.users, m.items))
    assert set(users) == set(bu) and set(items) == set(bi)
    for u, r in users.items():
        assert r.b == pytest.approx(bu[u], abs=1e-10) and r.v == pytest.approx(pu[u].tolist(), abs=1e-10)
    for i, r in items.items():
        assert r.b == pytest.approx(bi[i], abs=1e-10) and r.v == pytest.approx(qi[i].tolist(), abs=1e-10)


def test_does_not_depend_on_the_dealing(spark):
    """Blocks are a parameter of the order; partitions of the input and of shuffles are not."""
    rows = ratings(20, 10, 0.6, seed=2)
    p = sgd.Params(rank=3, epochs=2, blocks=4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for parts, shuffled in ((1, "3"), (13, "64")):
            spark.conf.set("spark.sql.shuffle.partitions", shuffled)
            found.append(sorted((r.user_id, r.b, tuple(r.v)) for r in sgd.fit(frame(spark, rows, parts), p).users.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_waves_keep_the_order_of_what_they_share():
    r = np.random.default_rng(3)
    u, i = r.integers(0, 9, 200), r.integers(0, 7, 200)
    groups = sgd.waves(u, i)
    assert sorted(np.concatenate(groups).tolist()) == list(range(200))
    seen: dict = {}
    for w, g in enumerate(groups):
        assert len(set(u[g])) == len(g) == len(set(i[g]))
        for n in g:
            seen[int(n)] = w
    for a in range(200):
        for b in range(a):
            if u[a] == u[b] or i[a] == i[b]:
                assert seen[b] < seen[a]
    assert sgd.waves(np.zeros(0, int), np.zeros(0, int)) == []


def test_error_at_or_below_least_squares(spark):
    """Planted factors with noise, a third held out."""
    g = spark.range(120 * 60).select(F.concat(F.lit("u"), (F.col("id") / 60).cast("int")).alias("user_id"), (F.col("id") % 60).alias("item_id"))
    g = g.filter(key_hash("user_id", "item_id", seed=4) % 100 < 60)

    def f(col, seed):
        return (key_hash(col, seed=seed) % 200 - 100) / 100.0

    noise = (key_hash("user_id", "item_id", seed=8) % 100 - 50) / 100.0
    rated = g.withColumn("stars", 3.0 + 1.5 * (f("user_id", 1) * f("item_id", 2) + f("user_id", 3) * f("item_id", 4)) + f("user_id", 6) * 0.5 + noise)
    held = key_hash("user_id", "item_id", seed=5) % 3 == 0
    train, test = rated.filter(~held), rated.filter(held)
    by_steps = sgd.predict(sgd.fit(train, sgd.Params(rank=8, epochs=40, lr=0.02, reg=0.05, blocks=1)), test)
    by_squares = mf.predict(mf.fit(train, rank=8, max_iter=15, reg=0.05), test)
    one, other = (EV.eval_report(x, test).first().rmse for x in (by_steps, by_squares))
    assert one <= other * 1.02


def test_unknown_sides_and_odd_rows(spark):
    rows = [("a", 1, 4.0), ("a", 1, 2.0), ("b", 2, 5.0), (None, 1, 1.0), ("c", None, 1.0), ("d", 3, None)]
    m = sgd.fit(frame(spark, rows), sgd.Params(rank=2, epochs=2))
    assert {r.user_id for r in m.users.collect()} == {"a", "b"}
    got = {(r.user_id, r.item_id): r.prediction for r in sgd.predict(m, frame(spark, [("a", 9, 0.0), ("z", 9, 0.0), ("z", 1, 0.0), ("a", 1, 0.0)]), None).collect()}
    bu, bi = ({r[0]: r.b for r in t.collect()} for t in (m.users, m.items))
    assert got["z", 9] == pytest.approx(11 / 3) and got["a", 9] == pytest.approx(11 / 3 + bu["a"]) and got["z", 1] == pytest.approx(11 / 3 + bi[1])
    empty = sgd.fit(frame(spark, []), sgd.Params(rank=2, epochs=2))
    assert sgd.predict(empty, frame(spark, [("a", 1, 0.0)])).first().prediction is None


def test_blocks_follow_the_number_of_ratings(spark, monkeypatch):
    for name, value in (("CELL_RATINGS", 50), ("ONE_CELL", 100)):
        monkeypatch.setattr(sgd, name, value)
    few, many = frame(spark, ratings(10, 9, 1.0)), frame(spark, ratings(40, 20, 1.0))
    assert sgd.choose_blocks(few, sgd.Params()) == 2 and sgd.choose_blocks(many, sgd.Params()) == 4
    assert sgd.choose_blocks(many, sgd.Params(blocks=7)) == 7


def test_factors_are_packed_and_steps_are_taken_in_parts(monkeypatch):
    x = np.arange(12.0).reshape(4, 3)
    assert sgd._packed(x).to_pylist() == [row.tobytes() for row in x]
    assert (sgd._unpacked(sgd._packed(x).slice(1, 2)).reshape(2, 3) == x[1:3]).all() and not len(sgd._unpacked(sgd._packed(x[:0])))
    r = np.random.default_rng(4)
    u, i, stars = r.integers(0, 300, 900), r.integers(0, 200, 900), r.integers(1, 6, 900).astype(float)
    found = []
    for part in (7, 10**6):
        monkeypatch.setattr(sgd, "AT_ONCE", part)
        state = [np.zeros(300), np.zeros(200), *(np.random.default_rng(n).standard_normal((m, 5)) for n, m in ((1, 300), (2, 200)))]
        sgd.steps(u, i, stars, 3.0, *state, sgd.Params())
        found.append(state)
    assert all((a == b).all() for a, b in zip(*found, strict=True))
