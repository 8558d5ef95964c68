"""Rates against projected gradient descent in numpy; the classifier on planted domains."""

import random

import numpy as np
import pytest

from sparkrec.llm import mixing as M


def planted(n=120, seed=4):
    """Documents of two kinds of words; kind b is rarer."""
    r = random.Random(seed)
    rows, domains = [], []
    for i in range(n):
        kind = "b" if i % 4 == 0 else "a"
        rows.append((i, " ".join(f"{kind}{r.randrange(12)}" if r.random() < 0.7 else f"c{r.randrange(30)}" for _ in range(r.randint(5, 60)))))
        if i % 3:
            domains.append((i, kind))
    return rows, domains


@pytest.fixture(scope="module")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, domain string")


def test_posteriors_find_the_domains(make_docs, labels):
    rows, domains = planted()
    table, names = M.posteriors(make_docs(rows), labels(domains))
    assert names == ["a", "b"]
    got = {r.doc_id: (r.p0, r.p1, r.n_tokens) for r in table.collect()}
    assert all(abs(p + q - 1) < 1e-5 for p, q, _ in got.values())
    assert all(n == len(rows[i][1].split()) for i, (_, _, n) in got.items())
    held_out = [i for i, _ in rows if i % 3 == 0]
    assert np.mean([(got[i][1] > 0.5) == (i % 4 == 0) for i in held_out]) > 0.9


@pytest.mark.parametrize(("weights", "min_rate"), [({"a": 0.5, "b": 0.5}, 0.0), ({"a": 0.05, "b": 0.95}, 0.0), ({"a": 0.6, "b": 0.4}, 1.0)])
def test_rates_against_numpy(make_docs, labels, weights, min_rate):
    rows, domains = planted()
    docs = make_docs([*rows, (500, None), (501, ""), (502, rows[0][1]), (2, rows[2][1])])
    table, names = M.posteriors(docs, labels(domains))
    history, reached = M.fit_rates(table, names, weights, min_rate=min_rate)
    data = table.collect()
    n = np.array([r.n_tokens * r.copies for r in data], float)
    p = np.array([[r.p0, r.p1] for r in data])
    now = p.T @ n
    share = np.array([weights[d] for d in names])
    budget = now.sum() if not min_rate else max(now.sum(), (now / share).max())
    target = share * budget
    # plain projected gradient descent, many steps, no history
    gram = (p * n[:, None]).T @ p
    metric = np.linalg.pinv(gram + 1e-9 * np.trace(gram) * np.eye(2))
    rate = np.full(len(n), max(1.0, min_rate))
    for _ in range(4000):
        rate = np.maximum(min_rate, rate - p @ (metric @ (p.T @ (n * rate) - target)))
    want = p.T @ (n * rate)
    total = np.array([reached["totals"][d] for d in names])
    assert np.abs(total - want).max() < (5e-3 if min_rate else 2e-3) * budget  # bounded rates approach their totals slowly
    if not min_rate:
        assert np.abs(total - target).max() < 2e-3 * budget
    assert len(history) <= 20


def test_rows_and_repeats(make_docs, labels):
    rows, domains = planted()
    rows += [(500, None), (501, ""), (2, rows[2][1]), (3, "same id but another text"), (None, "a1 a2 a3")]
    docs = make_docs(rows)
    out = M.rates(docs, labels(domains), {"a": 0.5, "b": 0.5}).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(d) for d, _ in rows)
    assert all(r.rate >= 0 and abs(r.repeats - r.rate) < 1.0001 for r in out)
    mixed = M.mixed(docs, labels(domains), {"a": 0.6, "b": 0.4}, min_rate=1.0)
    assert mixed.schema == docs.schema
    kept = {(r.doc_id, r.text) for r in mixed.collect()}
    assert kept == set(rows)  # every document stays


def test_degenerate(make_docs, labels):
    none = labels([])
    assert M.rates(make_docs([]), none, {"a": 1.0}).count() == 0
    assert [r.rate for r in M.rates(make_docs(["x y", None]), none, {"a": 1.0}).collect()] == [1.0, 1.0]
    out = M.rates(make_docs(["x y", None, "z"]), labels([(0, "a"), (0, "b"), (1, None), (None, "a")]), {"a": 0.5, "b": 0.5})
    assert out.count() == 3


def test_main_path_has_no_python(make_docs, labels):
    rows, domains = planted(40)
    plan = M.rates(make_docs(rows), labels(domains), {"a": 0.5, "b": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_texts_are_not_split_to_look_for_empty_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "")], "doc_id long, text string")
    lab = spark.createDataFrame([(1, "x")], "doc_id long, domain string")
    words = M._words(M._marked(M.texts(docs).join(lab, "doc_id"), "domain"), "domain", "doc_id")
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "split(" in line], plan
    assert M._words(M._marked(M.texts(docs)), "doc_id").where("doc_id = 2").count() == 3
