"""The join against comparing all pairs."""

import random

import numpy as np
import pytest

from sparkrec.llm import chosen_path as C


def brute(rows, threshold=0.8):
    """links and least doc_id of the component for each row; rows without doc_id have none."""
    sets = [set(C.shingles(t or "").tolist()) for _, t in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            k = len(sets[i] & sets[j])
            if 10 * k >= round(threshold * 10) * (len(sets[i]) + len(sets[j]) - k):
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            r = find(i)
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return sorted(str((rows[i][0], least[find(i)] if rows[i][0] is not None else None, links[i])) for i in range(n))


def got(df):
    return sorted(str((r.doc_id, r.class_id, r.n_links)) for r in df.collect())


def near_copies(seed, groups, per_group, words=60):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(groups):
        base = [r.choice(vocab) for _ in range(words)]
        for _ in range(per_group):
            own = list(base)
            for _ in range(r.randint(0, 3)):
                own[r.randrange(words)] = r.choice(vocab)
            rows.append(" ".join(own))
    r.shuffle(rows)
    return list(enumerate(rows))


EDGE = [(900, None), (901, ""), (902, ""), (903, "too few words"), (904, "too few words"), (905, "Too few words!"), (None, "too few words"),
        (906, "a b c d e"), (907, "A b, c d e."), (908, "x y z " * 3000), (908, "x y z " * 3000), (908, "another text with the same id here")]


def test_against_all_pairs(make_docs):
    rows = near_copies(1, 12, 6) + EDGE
    assert got(C.jaccard_classes(make_docs(rows))) == brute(rows)


def test_large_groups_are_split_and_compared_in_blocks(make_docs):
    """Groups beyond ``small`` go down all levels and end as pairs of blocks; nothing is lost."""
    rows = near_copies(2, 2, 40) + [(500 + i, "this passage is in many of the documents here " + " ".join(f"u{i}x{j}" for j in range(12))) for i in range(30)]
    assert got(C.jaccard_classes(make_docs(rows), small=8)) == brute(rows)


def test_a_family_of_different_sets_keeps_its_links(make_docs):
    """Pairs of likeness 0.8 to 0.85 in one group that is split at all levels: each run must split by tokens of its own."""
    r, n, words = random.Random(4), 2400, 300
    rows = []
    for i in range(n):
        own = [f"w{k}" for k in range(words)]
        for at in r.sample(range(words // 6), 3):  # three replaced words, six and more apart
            own[at * 6] = f"x{i}n{at}"
        rows.append((i, " ".join(own)))
    sets = [C.shingles(t) for _, t in rows]
    size = np.array([len(s) for s in sets], np.float64)
    inter = C.overlaps(sets).astype(np.float64)
    like = inter / (size[:, None] + size[None, :] - inter)
    np.fill_diagonal(like, 0)
    assert 0.8 < np.quantile(like, 0.01) and np.quantile(like, 0.8) < 0.85
    found = {x.doc_id: x.n_links for x in C.jaccard_classes(make_docs(rows), small=600).collect()}
    want = (like >= 0.8).sum(axis=1)
    lost = sum(int(want[i]) - found[i] for i in range(n))
    assert 0 <= lost <= 0.0001 * want.sum(), (lost, int(want.sum()))


def test_runs_reckon_with_the_splits():
    assert C.runs_for(0.99999, C.run_success(0.8)) == 9


def test_empty(make_docs):
    assert C.jaccard_classes(make_docs([])).count() == 0
    assert C.one_of_each(make_docs([])).count() == 0


def test_one_of_each(make_docs):
    rows = near_copies(3, 5, 4) + EDGE
    docs = make_docs(rows)
    out = C.one_of_each(docs)
    assert out.schema == docs.schema
    kept = [(r.doc_id, r.text) for r in out.collect()]
    classes = {(r.doc_id, r.uid): r.class_id for r in C.jaccard_classes(docs).collect()}
    ids = {c for c in classes.values() if c is not None}
    assert {d for d, _ in kept if d is not None} == ids
    assert sum(d is None for d, _ in kept) == 1
    assert sorted(t[:7] for d, t in kept if d == 908) == ["another", "x y z x"]  # one row of the repeated text, one of the other


def test_overlaps_are_exact():
    r = np.random.default_rng(0)
    pool = r.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(r.choice(pool, r.integers(1, 200))) for _ in range(40)]
    want = [[0 if i == j else len(np.intersect1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    out = C.overlaps(sets)
    np.fill_diagonal(out, 0)
    assert (out == np.array(want)).all()


@pytest.mark.parametrize(("recall", "runs"), [(0.99999, 8), (0.9, 2), (0.2, 1)])
def test_runs(recall, runs):
    assert C.runs_for(recall, 0.8) == runs


@pytest.mark.parametrize("size,cells", [(1, 1 << 15), (7, 20), (400, 1 << 15), (400, 16)])
def test_sampled_works_several_hashes_out_at_once(monkeypatch, size, cells):
    """The same tokens as one hash after another, with a bounded number of array steps for a short set."""
    s = np.unique(np.random.default_rng(size).integers(0, 2**63, size).astype(np.uint64) * np.uint64(3))
    monkeypatch.setattr(C, "SAMPLED_CELLS", cells)
    one_by_one = []
    for k in range(1, 46):
        seed = np.array(k, np.uint64) * np.uint64(0xD1B54A32D192ED03)
        one_by_one.append(int(C._mix(s ^ seed).min().astype(np.int64)))
    assert C.sampled(s, 45) == one_by_one
    steps = []
    monkeypatch.setattr(C, "_mix", lambda x: steps.append(x))
    assert C.sampled(s, 45) == one_by_one and not steps
