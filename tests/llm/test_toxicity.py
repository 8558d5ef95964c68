"""Segments against all sub-intervals; held-out accuracy on planted passages."""

import itertools
import random

import pytest

from sparkrec.llm import toxicity as T


def plain_segments(scores):
    """Maximal-scoring segments by the definition: the best interval, then those left and right of it."""
    if not scores:
        return []
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)))
    total, _, _, a, b = best
    if total <= 0:
        return []
    left, right = plain_segments(scores[:a]), plain_segments(scores[b:])
    return left + [(total, a, b)] + [(s, x + b, y + b) for s, x, y in right]


def test_segments_by_definition():
    r = random.Random(1)
    for _ in range(300):
        scores = [r.choice([-3, -2, -1, 1, 2, 5]) + r.random() / 100 for _ in range(r.randint(0, 14))]
        got = T.maximal_segments([(s, i, i + 1) for i, s in enumerate(scores)])
        want = plain_segments(scores)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert all(abs(x[0] - y[0]) < 1e-9 for x, y in zip(got, want))


def test_many_tokens_take_linear_time():
    items = [(1.0 if i % 2 else -0.9, i, i + 1) for i in range(200_000)]
    assert T.maximal_segments(items)[0][1] == 1


def planted(n=600, seed=6):
    r = random.Random(seed)
    clean = [f"word{i}" for i in range(300)]
    bad = ["scoundrel", "villain", "wretch", "knave"]
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(clean) for _ in range(r.randint(20, 120))]
        toxic = i % 6 == 0
        if toxic:
            at = r.randrange(len(words))
            words[at:at] = [r.choice(bad) for _ in range(3)]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def labelled(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(make_docs, labelled):
    rows, labels = planted()
    rows += [(9000, None), (9001, ""), (9002, "word1 " * 30_000), (9003, rows[0][1]), (9003, rows[0][1]), (None, "word5")]
    docs = make_docs(rows)
    model = T.fit(docs, labelled(labels + [(0, 1, 1), (3, 0, None), (None, 1, 1), (12345, 1, 1)]))
    out = T.score_documents(docs, model).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    held = [i for i in range(600) if by[i].held_out]
    assert 60 < len(held) < 200
    assert sum(by[i].predicted == (i % 6 == 0) for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert by[9000].score == by[9001].score < 0.5 and by[9003].predicted == 1
    spans = T.passages(docs, model).where("doc_id = 6").collect()
    text = rows[6][1]
    assert len(spans) == 1 and all(w in ("scoundrel", "villain", "wretch", "knave") for w in text[spans[0].start:spans[0].end].split()[:1])
    kept = T.without_toxic(docs, labelled(labels))
    assert kept.schema == docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert 9000 in ids and None in ids and 9003 not in ids


def test_held_out_rows_teach_nothing(make_docs, labelled):
    rows, labels = planted(240)
    import zlib
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    docs = make_docs(rows)
    assert T.fit(docs, labelled(labels)) == T.fit(docs, labelled(flipped))


def test_without_labels(make_docs, labelled):
    docs = make_docs(["a b c", None])
    model = T.fit(docs, labelled([]))
    assert [r.score for r in T.score_documents(docs, model).collect()] == [0.0, 0.0]
    assert T.score_documents(make_docs([]), model).count() == 0
    assert T.without_toxic(make_docs([]), labelled([])).count() == 0
    assert T.fit(docs, labelled([(0, 1, 0), (1, 1, 0)]))["weights"] == {}


def test_calibration_keeps_all_segments_of_a_long_text(spark, monkeypatch):
    text = " ".join(["bad " + "fine " * 30] * 200)
    weights = {"bad": 6.0, "fine": -1.0}
    sample = spark.createDataFrame([(1, text, 1, 0), (2, "fine fine", 0, 1)], "doc_id long, text string, toxic int, part int")
    seen, plain = [], T.features
    monkeypatch.setattr(T, "features", lambda n, segs, *more: seen.append(len(segs)) or plain(n, segs, *more))
    T._calibrate(sample, [weights] * 3)
    assert max(seen) == len(T.segments(text, weights, T.DRIFT)[1]) > 64
