"""The trie against one built from nested prefixes, and the bitmaps of a shard."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from oracle_compare import compare, duck
from sparkrec.llm import prefix_trie as P
from sparkrec.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string, pos int, k1 string, shard double, words int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 0.5, 9) for r in rows], SCHEMA)


def in_order(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()), key=str)


def conversations(n, seed=2):
    r = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        for t in range(int(r.integers(1, 7))):
            rows.append((c, t, ("user", "assistant")[t % 2], " ".join(r.choice(["a", "b", "c"], r.integers(0, 3)))))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_against_nested_prefixes(spark, monkeypatch, small):
    """With small units and shards, prefixes and end lists reach over many of both."""
    if small:
        for name, value in (("UNIT_TURNS", 2), ("SHARD_TURNS", 40), ("PIECE_IDS", 8)):
            monkeypatch.setattr(P, name, value)
    rows = conversations(150)
    convs = in_order(rows)
    assert got(P.rebuilt_trie(table(spark, rows))) == brute(rebuilt(convs))
    if small:
        assert got(P.conversation_trie(table(spark, rows))) == brute(convs)


def test_odd_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, "user", None), (1, 0, None, "x y"), (1, 0, None, "x y"), (2, 5, "", ""), (2, 5, None, None),
            (None, 1, "user", "gone"), (20, 1, "user", "head one two"), (20, 2, "assistant", "tail"), (21, 1, "user", "own"), (25, 1, None, "own\tx\x0by z"),
            (-3, 1, "user", "negative"), (-17, 1, "user", "head"), (0, 1, "user", "first"), (0, 2, "user", "a" * 5000), (39, 7, "user", "only"),
            (40, 1, "us", "er"), (41, 1, "use", "r"), (50, 1, "user", "u"), (51, 1, "user", "u")]
    assert got(P.conversation_trie(table(spark, rows))) == brute(in_order(rows))
    assert got(P.rebuilt_trie(table(spark, rows))) == brute(rebuilt(in_order(rows)))


def test_equal_turns_are_ordered_by_role_and_text(spark):
    r = np.random.default_rng(5)
    rows = [(c, (None, 3)[int(r.integers(0, 2))], (None, "user")[int(r.integers(0, 2))], f"{r.choice(['b', 'a', 'B', 'é', ''])} {c % 3}")
            for c in range(40) for _ in range(6)]
    assert got(P.conversation_trie(table(spark, rows))) == brute(in_order(rows))
    assert got(P.rebuilt_trie(table(spark, rows))) == brute(rebuilt(in_order(rows)))


def test_a_root_with_very_many_children_has_no_parent(spark):
    rows = [(c, 1, "user", f"first {c}") for c in range(1200)]
    assert got(P.conversation_trie(table(spark, rows))) == brute(in_order(rows))


def test_empty_table(spark):
    assert got(P.rebuilt_trie(table(spark, []))) == []
    assert got(P.rebuilt_trie(table(spark, [(None, 1, "user", "x")]))) == []


def test_one_first_turn_and_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_TURNS", 100)
    rows = [(c, t, "user", "same words here" if t < 2 or c % 3 else f"other {c}") for c in range(300) for t in range(3)]
    frame = table(spark, rows)
    assert got(P.conversation_trie(frame)) == brute(in_order(rows))
    dealt = P.units(P.with_tops(P.ordered_turns(frame)))
    sizes = [r["count"] for r in dealt.groupBy("shard").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 300  # one start and first turn, yet many shards


def test_a_very_long_conversation_is_many_units(spark):
    n = P.UNIT_TURNS * 2 + 5
    rows = [(c, t, "user", f"turn {t}" if c < 2 or t < n - 3 else f"turn {t} of {c}") for c in (0, 1, 2) for t in range(n)]
    found = {(r.conv_id, r.depth): r for r in P.conversation_trie(table(spark, rows)).collect()}
    assert len(found) == n + 1 + 3
    root = found[0, 0]
    assert (root.n_convs, root.n_children, root.n_leaves) == (3, 1, 2)
    assert root.saved_tokens == 2 * 2 * (n - 3) + 2 * 3
    assert found[0, n].ends_sha256 == hashlib.sha256(b"0,1").hexdigest()
    assert found[2, n].n_leaves == 1 and found[0, n - 3].n_children == 2


def test_bitmaps():
    """Slots by id; a child is one intersection; its lowest bit is the smallest member."""
    rows = [(7, 0, 0), (7, 1, 11), (7, 2, 5), (9, 0, 0), (9, 1, 11), (12, 0, 0), (12, 1, 13)]
    key, k = {}, []
    for c, p, z in rows:
        key[c] = key.get(c, 0) ^ z
        k.append(key[c])
    last = [False, False, True, False, True, False, True]
    index = P.VerticalIndex([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [r[2] for r in rows], k, k, [1] * 7, [0] * 7, last)
    assert index.convs == [7, 9, 12]
    assert index.postings[1, 11, 11] == 0b011 and index.ends == {1: 0b110, 2: 0b001}
    seen = {(index.rows[at][0], index.rows[at][1]): (bits, ended) for at, bits, ended in index.walk()}
    assert seen == {(0, 0): (0b111, 0), (1, 11): (0b011, 0b010), (1, 13): (0b100, 0b100), (2, 5): (0b001, 0b001)}
    assert index.members(0b101) == [0, 2]


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    compare(Q.op12_prefix_trie(spark, sf), duck(sf), P.SQL)
