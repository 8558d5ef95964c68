"""Line dedup against a plain version; the index's filters and its reversibility."""

import collections
import hashlib

import numpy as np

from sparkrec.llm import line_dedup as L

LONG = "This line is shared and is longer than forty characters."


def brute(rows):
    held = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            k = x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            if len(k) >= 40 and d is not None:
                held[k].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            k = x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            if len(k) >= 40 and len(held[k]) >= 5 and d is not None and d != max(held[k]):
                continue
            kept.append(x)
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(map(str, out))


def got(df):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())


def test_against_plain(make_docs):
    rows = [(i, f"own line number {i}\n  {LONG.upper() if i % 2 else LONG}\t\n{LONG}\nshort") for i in range(9)]
    rows += [(20, None), (21, ""), (22, "\n\n"), (3, rows[3][1]), (3, rows[3][1]), (None, LONG), (30, "É" + LONG[1:]), (31, "x" * 200_000 + "\n" + LONG)]
    rows += [(40 + i, "four documents only have this line, so it stays") for i in range(4)]
    rows += [(50 + i, "É" * 40) for i in range(3)] + [(60 + i, "é" * 40) for i in range(3)]  # only A-Z is lower-cased
    assert got(L.report(make_docs(rows))) == brute(rows)


def test_empty(make_docs):
    assert L.report(make_docs([])).count() == 0
    assert L.without_common_lines(make_docs([])).count() == 0


def test_columns_stay(make_docs):
    docs = make_docs([f"{LONG}\nown {i}" for i in range(6)])
    out = L.without_common_lines(docs)
    assert out.schema == docs.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[5] == (f"{LONG}\nown 5", len(LONG) + 6) and got[0] == ("own 0", 5)


def test_filter_holds_what_was_inserted_and_forgets_what_was_deleted():
    r = np.random.default_rng(1)
    a, b = r.integers(-2**63, 2**63 - 1, (2, 30_000))
    f = L.CuckooFilter.of(a, b)
    assert f.contains(a, b).all() and f.contains(b, a).mean() < 0.01
    f.delete(a[:10_000], b[:10_000])
    assert f.contains(a[10_000:], b[10_000:]).all() and f.contains(a[:10_000], b[:10_000]).mean() < 0.01
    full = L.CuckooFilter(16)
    assert not full.insert(a[:100], b[:100])


def state(index):
    refs = sorted(map(tuple, index.refs.select("k1", "k2", "doc_id", "refs").collect()))
    keys = index.refs.select("k1", "k2").distinct()
    held = index.probe(keys.select(index._shard(index.n_shards), "k1", "k2")).where("maybe").count() if index.n_shards else 0
    return refs, held, keys.count()


def test_insert_and_delete_are_reversible(make_docs):
    first = [(i, f"{LONG}\n{'only in document ' * 4}{i}") for i in range(4)]
    second = [(i, f"{LONG}\n{'a later document says ' * 3}{i}") for i in range(10, 13)]
    base = L.LineIndex.build(make_docs(first))
    before = state(base)
    assert base.doomed().count() == 0
    more = base.insert(make_docs(second))
    assert {r.doc_id for r in more.doomed().collect()} == {0, 1, 2, 3, 10, 11}
    refs, held, keys = state(more)
    assert held == keys and refs == state(L.LineIndex.build(make_docs(first + second)))[0]
    assert state(more.insert(make_docs(second)))[0] == refs  # documents that are there already change nothing
    back = more.delete(make_docs(second).select("doc_id"))
    assert state(back) == before
    gone = make_docs(second)
    probe = L.postings(gone).select(back._shard(back.n_shards), "k1", "k2").distinct()
    assert back.probe(probe).where("maybe").count() <= 1 + 1  # the shared line, and a false positive at most
    # the keeper moves when the largest document goes
    assert {r.doc_id for r in more.delete(make_docs([(12, "")]).select("doc_id")).doomed().collect()} == {0, 1, 2, 3, 10}


def test_changed_text_of_a_known_document_changes_nothing(make_docs):
    base = L.LineIndex.build(make_docs([(i, f"{LONG}\n{'only in document ' * 4}{i}") for i in range(4)]))
    before = state(base)
    other = make_docs([(1, "another text of document one, long enough to be a key")])
    again = base.insert(other)
    assert state(again) == before
    probe = L.postings(other).select(again._shard(again.n_shards), "k1", "k2")
    assert again.probe(probe).where("maybe").count() == 0
    gone = again.delete(other.select("doc_id"))
    assert gone.probe(probe).where("maybe").count() == 0 and state(gone)[1] == state(gone)[2] == before[2] - 1


def test_counts_follow_the_references(make_docs):
    first = [(i, f"{LONG}\n{'only in document ' * 4}{i}") for i in range(4)]
    second = [(i, f"{LONG}\n{'only in document ' * 4}{i % 4}") for i in range(10, 15)]
    index = L.LineIndex.build(make_docs(first)).insert(make_docs(second)).delete(make_docs([(14, ""), (2, "")]).select("doc_id"))
    want = collections.defaultdict(list)
    for r in index.refs.collect():
        want[r.k1, r.k2].append(r.doc_id)
    assert {(r.k1, r.k2): (r.n, r.keeper) for r in index.counts.collect()} == {k: (len(v), max(v)) for k, v in want.items()}


def test_a_key_the_filters_deny_is_not_looked_up(make_docs):
    """With filters that hold nothing, known keys count as new ones: it is the filters' answer that decides."""
    index = L.LineIndex.build(make_docs([(i, LONG) for i in range(4)]))
    blind = L.LineIndex(index.refs, index.counts, index.filters.limit(0), index.n_shards)
    later = make_docs([(9, LONG)])
    assert index.insert(later).doomed().count() == 4
    assert [r.fresh for r in blind.insert(later).counts.orderBy("fresh").collect()] == [False, True]


def test_a_full_shard_is_dealt_anew(make_docs):
    """Filters too small for a batch are built again from the counts."""
    index = L.LineIndex.build(make_docs([(0, "x" * 50)]))
    lines = ["\n".join(f"document {d} has line {i} of its own, and it is long enough" for i in range(60)) for d in range(1, 6)]
    more = index.insert(make_docs(list(enumerate(lines, 1))))
    refs, held, keys = state(more)
    assert held == keys == 301


def test_reshard_keeps_the_decisions(make_docs):
    index = L.LineIndex.build(make_docs([f"{LONG}\n{i}" for i in range(7)]))
    other = index.reshard(5)
    assert other.filters.count() >= 1 and state(other)[1] == state(other)[2]
