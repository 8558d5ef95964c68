"""Ranked search against scoring every document, and how much the skipping leaves out."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from oracle_compare import compare, duck
from sparkrec.llm import queries as Q
from sparkrec.llm import ranked_search as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id long, text string, doc_id long, term string, weight double, chunk int"


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, k=50):
    docs = [(d, Counter(words(t))) for d, t in docs]
    docs = [(d, c, c.total()) for d, c in docs if c]
    n, total = len(docs), sum(x for _, _, x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for i, terms in asked.items():
        found = []
        for d, c, size in docs:
            m = 50 + 50 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def got(spark, make_docs, docs, items, k=50):
    frame = spark.createDataFrame([(i, t, 1, "x", 0.5, 3) for i, t in items], ITEMS)
    return sorted(map(tuple, R.rank_documents(make_docs(docs), frame, k).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(n, seed=1):
    r = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    weight = 1 / np.arange(1, 401)
    weight /= weight.sum()
    return [(i, " ".join(r.choice(vocabulary, r.integers(1, 60), p=weight))) for i in range(n)], r, vocabulary, weight


@pytest.mark.parametrize(("share", "room"), [(0.0, 0), (0.125, 0), (0.125, 1 << 20), (1e9, 1 << 20)])
def test_against_all_documents(spark, make_docs, monkeypatch, share, room):
    """Only long lists, both kinds, only accumulators, chunks shuffled or broadcast: the same result; small shards, windows and chunks."""
    for name, value in (("SHARD_DOCS", 70), ("WINDOW", 16), ("CHUNK_BYTES", 500), ("SHORT_SHARE", share), ("OPEN_CHUNKS", 2), ("BROADCAST_BYTES", room)):
        monkeypatch.setattr(R, name, value)
    docs, r, vocabulary, weight = corpus(600)
    items = [(i, " ".join(r.choice(vocabulary, 8, p=weight))) for i in range(12)]
    assert got(spark, make_docs, docs, items, 7) == brute(docs, items, 7)


def test_odd_rows(spark, make_docs):
    long = "Straße eins " * 30_000 + "zwei"
    docs = [(1, None), (2, ""), (3, "... --"), (None, "alpha beta"), (None, "alpha beta"), (4, "Alpha BETA"), (4, "alpha beta"), (5, long), (-7, "alpha beta"),
            (6, "é alpha É"), (8, "a1 b2 alpha_beta")]
    items = [(1, "ALPHA beta, alpha"), (1, "zwei"), (2, None), (3, ""), (4, "nothing here"), (5, "STRASSE straße É eins"), (None, "b2 beta"), (6, long)]
    assert got(spark, make_docs, docs, items) == brute(docs, items)
    assert got(spark, make_docs, docs, items, 2) == brute(docs, items, 2)


def test_empty_tables(spark, make_docs):
    assert got(spark, make_docs, [], [(1, "a")]) == []
    assert got(spark, make_docs, [(1, "a")], []) == []
    assert got(spark, make_docs, [(1, None)], [(1, "a")]) == []


def test_one_term_in_all_documents_and_many_equal_ones(spark, make_docs, monkeypatch):
    monkeypatch.setattr(R, "SHARD_DOCS", 64)
    docs = [(i, "common rare" if i % 50 == 3 else "common") for i in range(500, 0, -1)]
    items = [(1, "common"), (2, "common rare"), (3, "rare")]
    assert got(spark, make_docs, docs, items) == brute(docs, items)


def test_a_long_text_is_counted_in_pieces(monkeypatch):
    text = ("Wort, wort; " * 500 + "x" * 300 + " ende").encode()
    whole = R.count_terms(text)
    monkeypatch.setattr(R, "PIECE", 64)
    assert R.count_terms(text) == whole and whole[b"wort"] == 1000 and whole[b"x" * 300] == 1


def _index(docs, totals=None):
    shard = R._Shard()
    for d, t in docs:
        shard.add(d, t.encode())
    row = shard.row(0)
    return row, R.Totals(row["n_docs"], row["n_tokens"])


def test_long_lists_are_skipped():
    """A rare term sets the k-th best; a common term's postings are then looked up for its documents only."""
    docs = [(i, "common filler" if i % 400 else "common rare") for i in range(4000)]
    row, totals = _index(docs)
    index = R.ShardIndex(row, totals, {b"common": 1, b"rare": 9000})
    best = R.Best(3)
    read = R.search_shard(index, [b"common", b"rare"], best, window=64)
    assert best.ids.tolist() == [0, 400, 800]
    assert read < 4000 / 2


def test_accumulators_are_bounded_by_their_largest_sum():
    row, totals = _index([(1, "a b"), (2, "a"), (3, "c")])
    index = R.ShardIndex(row, totals, {b"a": 10, b"b": 20, b"c": 5})
    merged = R.Accumulators([index.lists[b"a"], index.lists[b"b"]], 3)
    assert merged.slots.tolist() == [0, 1]
    assert merged.bound == merged.scores.max() == merged.scores[0]
    assert all(p.scores.max() <= p.bound for p in index.lists.values())


def test_lengths_beyond_64_bits_raise():
    with pytest.raises(OverflowError):
        R.Totals(2**40, 10).norm(np.array([2**30]))


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    compare(Q.op13_ranked_search(spark, sf), duck(sf), R.SQL)


def test_no_row_of_the_index_holds_more_than_a_term_or_a_shard_s_documents(spark, make_docs, monkeypatch):
    """Files and batches hold rows whole, and a task may write many shards."""
    monkeypatch.setattr(R, "SHARD_DOCS", 50)
    docs, *_ = corpus(400)
    index = R.build_index(make_docs(docs))
    largest = max(sum(len(v) for v in r if isinstance(v, (bytes, bytearray, list))) for r in index.collect())
    assert largest <= 50 * 16 + 64
    df = {r.term.decode(): r.n for r in index.where("term is not null").groupBy("term").agg({"size": "sum"}).toDF("term", "n").collect()}
    assert df == Counter(t for _, text in docs for t in set(words(text)))
    R.drop_materialized(index)
