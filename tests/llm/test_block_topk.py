"""Top-k against scoring every pair."""

import math

import numpy as np
import pytest
from sparkrec.llm import block_topk as B

SCHEMA = "vec_id long, embedding array<float>, label int, part long, query_no int"


def brute(rows, k=10, every=100):
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, v in good]
    size = max(set(lengths), key=lambda n: (lengths.count(n), n)) if good else 0
    good = [(i, v) for i, v in good if len(v) == size]
    out = []
    for q, a in good:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out += [(q, r, i, -x) for r, (x, i) in enumerate(s, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)


def test_against_all_pairs(table, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 32)
    monkeypatch.setattr(B, "RANGE_ROWS", 128)
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(0, 0.3, 8)]) for i in range(900)]
    rows += [(5000, rows[0][1]), (5001, rows[0][1]), (5002, None), (5003, [None] * 8), (5100, [float("nan")] * 8), (5200, [float("inf")] + [0.0] * 7), (5300, [1.0]), (None, rows[1][1])]
    got = sorted(map(tuple, B.top_k(table(rows)).collect()))
    assert got == brute(rows)


def test_ties_and_few_rows(table):
    rows = [(i, [1.0, -0.5]) for i in range(0, 300, 25)]
    assert sorted(map(tuple, B.top_k(table(rows)).collect())) == brute(rows)
    few = [(100, [0.1, 0.2]), (7, [0.0, 0.0]), (9, [-1.0, -1.0])]
    assert sorted(map(tuple, B.top_k(table(few)).collect())) == brute(few)
    assert B.top_k(table([])).count() == 0
    assert B.top_k(table([(100, [1.0])])).count() == 0


def test_each_length_is_searched_among_its_own(table):
    r = np.random.default_rng(6)
    long, short = ([(i, [float(x) for x in r.normal(0, 0.3, n)]) for i in ids] for n, ids in ((8, range(300)), (5, range(1000, 1150))))
    got = sorted(map(tuple, B.top_k(table([*long, *short, (2000, []), (2100, [1.0])])).collect()))
    assert got == sorted(brute(long) + brute(short))


def test_blocks_below_the_bound_are_not_scored():
    r = np.random.default_rng(5)
    centres = r.normal(0, 2, (20, 8))
    blocks, rows = [], []
    for c in range(20):
        x = np.floor(1024 * (centres[c] + r.normal(0, 0.05, (50, 8)))).astype(np.int64)
        ids = np.arange(c * 50, c * 50 + 50)
        rows += list(zip(ids.tolist(), x))
        blocks.append({"ids": ids, "vectors": x.tobytes(), "high": x.max(0), "low": x.min(0)})
    q = np.array([rows[i][1] for i in (0, 333, 777)])
    best = B.Best(np.array([0, 333, 777]), 5)
    scored = B.search_blocks(blocks, q, best)
    assert scored < 3 * 1000 / 2
    for n, i in enumerate((0, 333, 777)):
        want = sorted((-int(q[n] @ v), j) for j, v in rows if j != i)[:5]
        assert [(-s, j) for s, j in zip(best.score[n].tolist(), best.ids[n].tolist())] == want


@pytest.mark.parametrize("base", [2.0**20, 1.3e6])
def test_large_components(table, monkeypatch, base):
    """Scores past 2^60 are exact, also where doubles would round them and bounds are rounded."""
    monkeypatch.setattr(B, "BLOCK", 32)
    monkeypatch.setattr(B, "RANGE_ROWS", 64)
    r = np.random.default_rng(5)
    rows = [(i, [base + r.integers(0, 8) / 8, float(r.integers(-9, 9)), -base + r.integers(0, 8) / 8]) for i in range(400)]
    assert sorted(map(tuple, B.top_k(table([(i, [float(x) for x in v]) for i, v in rows])).collect())) == brute(rows)


@pytest.mark.parametrize("x", [4e6, 1e17])
def test_scores_past_64_bits_raise(table, x):
    with pytest.raises(Exception, match="64 bits"):
        B.top_k(table([(0, [x, x]), (1, [x, x])]), k=2).collect()
