"""Fingerprints against a plain version over sorted documents."""

import hashlib
import random

from sparkrec.llm import imatch as I


def text(r, n):
    return " ".join(f"w{min(int(r.paretovariate(0.4)), 500)}" for _ in range(n))


def corpus(seed=3):
    r = random.Random(seed)
    rows = [(i * 7 % 101, text(r, r.choice([3, 20, 80, 300]))) for i in range(100)]
    return rows + [(1000, None), (1001, ""), (1002, "."), (1003, rows[0][1]), (1004, "é" * 50_000), (55, "again the same id"), (55, "again the same id"), (None, "no id here")]


def brute(rows, band):
    texts = [t or "" for _, t in rows]
    df = {}
    for t in texts:
        for w in I.terms(t):
            df[w] = df.get(w, 0) + 1
    n = len(rows)
    import math
    low, high = max(2, math.ceil(band[0] * n)), max(2, math.floor(band[1] * n))
    lex = I.Lexicon([w for w, k in df.items() if low <= k <= high])
    order = sorted(rows, key=lambda x: (-(x[0] if x[0] is not None else I.LAST), x[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        edited = t[:len(t) - k] + nxt[:k]
        a, b, c = (lex.codes(I.terms(x)) for x in (t, edited, nxt))
        out.append(str((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), I.likeness(a, b), I.likeness(a, c))))
    return sorted(out)


def test_against_plain(make_docs):
    rows = corpus()
    got = sorted(str(tuple(r)) for r in I.against_neighbours(make_docs(rows), (0.02, 0.3)).collect())
    assert got == brute(rows, (0.02, 0.3))


def test_edited_texts_are_nearer_than_neighbours(make_docs):
    r = random.Random(9)
    rows = [(i, text(r, 200)) for i in range(120)]
    out = I.against_neighbours(make_docs(rows), (0.02, 0.3)).collect()
    assert sum(x.near_edited > x.near_next for x in out) >= 114
    assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in out)


def test_equal_texts_and_small_tables(make_docs):
    rows = corpus()
    prints = {r.doc_id: r.fingerprint for r in I.fingerprints(make_docs(rows), I.lexicon(make_docs(rows), (0.02, 0.3))).collect()}
    assert prints[1003] == prints[rows[0][0]] and prints[1000] == prints[1001] == prints[1002]
    assert I.against_neighbours(make_docs([])).count() == 0
    one = I.against_neighbours(make_docs([(4, "abcdef")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(4, 1.0)] and one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    groups = {r.doc_id: r.group_id for r in I.same_fingerprint_groups(make_docs(["x y", "x y", "z"])).collect()}
    assert groups[0] == groups[1] == 0 and groups[2] == 2
