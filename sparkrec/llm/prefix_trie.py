"""Prefix trie of conversations by vertical bitmaps.

A turn at a position gets a 128-bit hash of (position, role, text); a prefix's key is the
exclusive or of its turns' hashes, a running aggregate of a window. Conversations are cut
into units of ``UNIT_TURNS`` positions (a unit starts from its prefix's key, so a very long
conversation is many units) and units are dealt into shards by their start and first turn;
a crowded shard is dealt further by conversation.

In a shard, conversations have slots in the order of their ids. The vertical index holds,
for each (position, turn), the bitset of the slots that have it, and for each position the
bitset of the slots that end there. The trie is walked depth first: a node's bitset
intersected with the posting of one member's next turn is a child, its popcount the
child's members, its lowest bit the smallest of them, its intersection with the ends of
that position the end list. What is left of the bitset gives the next child. A bitset of
one member is followed as a chain. Shards' nodes are added up by key.

Sums over subtrees need no walk over the tree: each node is owned by its smallest member,
and a conversation owns the nodes of its path from one depth o on. For a node v at depth d,
the saved tokens of its subtree are, summed over its members c with o(c) > d, the tokens
of c's turns from d to o(c) - 1; its childless nodes are the members c that own the
childless node at their end. A second walk over the same shards adds these up.

Defined cases: rows without conv_id take no part; null role or text is empty; a null turn
comes first; equal turns of a conversation are ordered by role, then by text, both as
bytes; repeated rows are turns of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import drop_materialized, materialize, ship, shuffle_parts

UNIT_TURNS = 1024  # positions of one unit; more of a conversation are further units
SHARD_TURNS = 16_384
PIECE_IDS = 65_536  # ids of one piece of an end list
WORDS = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- turns


def ordered_turns(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos from 1, t1, t2, words): a 128-bit digest and the words of each turn, in order."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, t))

    def half(at: int) -> Column:
        return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")

    rows = table.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), r.alias("role"), half(1).alias("t1"), half(17).alias("t2"),
        t.alias("text"), F.regexp_count(t, F.lit(WORDS)).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "t1", "t2", "words")


def borrowed_heads(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Rebuilt turns: the first h of conversation c - c % family, then c's own after its first h; h = crc32(c) % most.

    Conversations without any turn left keep a row of position 0; every conversation has one.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % most
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("h", h)
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < most)).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("head_pos"), "t1", "t2", "words")
    length = heads.groupBy("base").agg(F.count("*").alias("n_heads"))  # most - 1 rows or fewer for each base
    plan = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(length, "base", "left").withColumn(
        "lent", F.least("h", F.coalesce("n_heads", F.lit(0))))
    lent = plan.select("conv_id", "base", "lent").join(heads, "base").where(F.col("head_pos") <= F.col("lent")).select(
        "conv_id", F.col("head_pos").alias("pos"), "t1", "t2", "words")
    own = turns.join(plan.select("conv_id", "h", "lent"), "conv_id").where(F.col("pos") > F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "t1", "t2", "words")
    tops = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("t1"), F.lit(0).cast("long").alias("t2"),
                        F.lit(0).cast("long").alias("words"))
    return tops.unionByName(lent).unionByName(own)


def with_tops(turns: DataFrame) -> DataFrame:
    """Conversations as they are, each with its row of position 0."""
    zero = F.lit(0).cast("long")
    return turns.unionByName(turns.select("conv_id").distinct().select("conv_id", zero.alias("pos"), zero.alias("t1"), zero.alias("t2"), zero.alias("words")))


# ---------------------------------------------------------------- units and shards


def units(turns: DataFrame) -> DataFrame:
    """Written rows (shard, conv_id, pos, z1, z2, k1, k2, words, before, last): a position's hash, its prefix's key, the tokens before it."""
    def z(seed: int) -> Column:
        return F.when(F.col("pos") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), "pos", "t1", "t2"))

    path = Window.partitionBy("conv_id").orderBy("pos")
    so_far = path.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = turns.withColumn("z1", z(1)).withColumn("z2", z(2)).select(
        "conv_id", "pos", "z1", "z2", F.bit_xor("z1").over(so_far).alias("k1"), F.bit_xor("z2").over(so_far).alias("k2"), "words",
        (F.sum("words").over(so_far) - F.col("words")).alias("before"), F.lead("pos").over(path).isNull().alias("last"),
        F.floor(F.col("pos") / UNIT_TURNS).alias("unit"))
    # a unit is dealt by its start and its first turn; the first unit's start is the root, its first turn position 1
    by_unit = Window.partitionBy("conv_id", "unit").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("start", F.coalesce(F.nth_value("k1", 2).over(by_unit), F.first("k1").over(by_unit)))
    rows = materialize(rows, "trie-turns")
    n = rows.count()
    bucket = F.pmod(F.xxhash64("start", "unit"), F.lit(max(shuffle_parts(turns.sparkSession), -(-n // SHARD_TURNS))))
    crowd = rows.groupBy(bucket.alias("bucket")).agg(F.ceil(F.count("*") / SHARD_TURNS).alias("ways")).where("ways > 1")
    dealt = rows.withColumn("bucket", bucket).join(crowd, "bucket", "left").withColumn(
        "shard", F.xxhash64("bucket", F.pmod(F.xxhash64("conv_id", "unit"), F.coalesce("ways", F.lit(1)))))
    return dealt.drop("bucket", "ways", "start", "unit")


# ---------------------------------------------------------------- one shard


class VerticalIndex:
    """Bitsets of a shard's units: by (position, turn), by the position of an end, by start."""

    def __init__(self, conv_id: list, pos: list, z1: list, z2: list, k1: list, k2: list, words: list, before: list, last: list,
                 unit: int = UNIT_TURNS):
        """Rows in the order of (conv_id, pos)."""
        self.unit = unit
        self.convs: list[int] = []  # of each slot, ascending
        self.first: list[int] = []  # a slot's first row
        self.rows = list(zip(pos, z1, z2, k1, k2, words, before, strict=True))
        self.postings: dict[tuple, int] = {}
        self.ends: dict[int, int] = {}
        self.starts: dict[tuple, int] = {}
        held, bit = None, 0
        for at, (p, a, b, x, y, _, _) in enumerate(self.rows):
            if conv_id[at] != held or p % unit == 0:
                held, bit = conv_id[at], 1 << len(self.convs)
                self.convs.append(held)
                self.first.append(at)
                start = (p, x ^ a, y ^ b)
                self.starts[start] = self.starts.get(start, 0) | bit
            z = (p, a, b)
            self.postings[z] = self.postings.get(z, 0) | bit
            if last[at]:
                self.ends[p] = self.ends.get(p, 0) | bit
        self.first.append(len(self.rows))

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(row, parent bitset's members as a bitset, ends): every node once, depth first; the row is the smallest member's."""
        rows, first, postings, ends, unit = self.rows, self.first, self.postings, self.ends, self.unit
        stack = [(bits, p) for (p, _, _), bits in self.starts.items()]  # a bitset and the position that comes next
        while stack:
            left, p = stack.pop()
            while left:
                low = left & -left
                slot = low.bit_length() - 1
                at = first[slot] + p % unit
                if at >= first[slot + 1]:  # ended before this position, or goes on in another unit
                    left ^= low
                    continue
                if left == low:  # one member: a chain to its end
                    for x in range(at, first[slot + 1]):
                        yield x, low, low & ends.get(rows[x][0], 0)
                    break
                child = left & postings[rows[at][:3]]
                yield at, child, child & ends.get(p, 0)
                left ^= child
                if (p + 1) % unit:
                    stack.append((child, p + 1))

    def members(self, bits: int) -> list[int]:
        """Slots of a bitset."""
        out = []
        while bits:
            low = bits & -bits
            out.append(low.bit_length() - 1)
            bits ^= low
        return out


NODES = "k1 long, k2 long, depth long, p1 long, p2 long, n long, conv_id long, words long, before long, n_ends long, ends array<long>"
SUMS = "k1 long, k2 long, saved long, leaves long"
TURN_COLUMNS = ("conv_id", "pos", "z1", "z2", "k1", "k2", "words", "before", "last")


def _open(t: pa.Table, unit: int) -> VerticalIndex:
    t = t.sort_by([("conv_id", "ascending"), ("pos", "ascending")])
    return VerticalIndex(*(t.column(c).to_pylist() for c in TURN_COLUMNS), unit)


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    names = [f.split() for f in schema.split(", ")]
    fields = pa.schema([(n, pa.list_(pa.int64()) if t == "array<long>" else pa.int64()) for n, t in names])
    cols = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, fields, strict=True)], schema=fields)


def shard_nodes(dealt: DataFrame) -> DataFrame:
    """Each shard's nodes with their members, smallest member and ends in it."""
    ship(dealt.sparkSession)
    unit = UNIT_TURNS

    def run(t: pa.Table) -> pa.Table:
        index, out = _open(t, unit), []
        for at, bits, ended in index.walk():
            p, a, b, x, y, words, before = index.rows[at]
            slot = (bits & -bits).bit_length() - 1
            out.append((x, y, p, x ^ a, y ^ b, bits.bit_count(), index.convs[slot], words, before, ended.bit_count(),
                        [index.convs[s] for s in index.members(ended)] or None))
        return _table(NODES, out)

    return dealt.groupBy("shard").applyInArrow(run, NODES)


def shard_sums(dealt: DataFrame, owners: DataFrame) -> DataFrame:
    """Each shard's part of the nodes' saved tokens and childless nodes.

    owners: (conv_id, owned, tokens, leaf): the depth from which a conversation owns its path, the tokens before it, and whether
    it owns a childless node.
    """
    ship(dealt.sparkSession)
    unit = UNIT_TURNS

    def run(turns: pa.Table, owned: pa.Table) -> pa.Table:
        if not turns.num_rows:
            return _table(SUMS, [])
        index, out = _open(turns, unit), []
        given = {c: (o, t, f) for c, o, t, f in zip(*(owned.column(x).to_pylist() for x in ("owner", "owned", "tokens", "leaf")), strict=True)}
        facts = [given[c] for c in index.convs]
        for at, bits, _ in index.walk():
            p, _, _, x, y, _, before = index.rows[at]
            saved = leaves = 0
            for s in index.members(bits):
                o, tokens, leaf = facts[s]
                leaves += leaf
                if o > p:
                    saved += tokens - before
            out.append((x, y, saved, leaves))
        return _table(SUMS, out)

    of_shard = dealt.select(F.col("shard").alias("place"), F.col("conv_id").alias("owner")).distinct().join(
        owners.withColumnRenamed("conv_id", "owner"), "owner")
    return dealt.groupBy("shard").cogroup(of_shard.groupBy("place")).applyInArrow(run, SUMS)


# ---------------------------------------------------------------- end lists


def end_digests(parts: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) from shards' end lists: ids joined in pieces of a bounded range, pieces hashed one after another."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    ids = parts.where(F.col("ends").isNotNull()).select("k1", "k2", F.explode("ends").alias("id"))
    pieces = ids.groupBy("k1", "k2", F.floor(F.col("id") / PIECE_IDS).alias("piece")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string"))).alias("joined"))
    in_order = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "piece")

    def run(batches):
        held, digest = None, None
        for b in batches:
            out = []
            for k1, k2, joined in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "joined")), strict=True):
                if (k1, k2) == held:
                    digest.update(b",")
                else:
                    if held:
                        out.append((*held, digest.hexdigest()))
                    held, digest = (k1, k2), hashlib.sha256()
                digest.update(joined.encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else ((), (), ()), schema, strict=True)], schema=schema)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*held, digest.hexdigest()), schema, strict=True)], schema=schema)

    return in_order.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


# ---------------------------------------------------------------- the trie


def trie(turns: DataFrame) -> DataFrame:
    """A row for each node of the trie of turns (conv_id, pos from 0, t1, t2, words), position 0 being the root's."""
    dealt = units(turns)
    dealt = materialize(dealt, "trie-units")
    parts = materialize(shard_nodes(dealt), "trie-parts")
    nodes = materialize(parts.groupBy("k1", "k2", "depth").agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_ends").alias("n_ends"),
        *(F.first(c).alias(c) for c in ("p1", "p2", "words", "before"))), "trie-nodes")
    totals = dealt.where("last").select("conv_id", (F.col("before") + F.col("words")).alias("all_tokens"))
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("owned"), F.min_by("before", "depth").alias("tokens"),
                                         F.max((F.col("n_ends") == F.col("n_convs")).cast("int")).alias("leaf"))
    owners = totals.join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("owned", F.lit(2**62)).alias("owned"), F.coalesce("tokens", "all_tokens").alias("tokens"),
        F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"))

    none = F.lit(None).cast("long")
    facts = nodes.select("k1", "k2", "depth", "conv_id", "p1", "p2", "n_convs", "words", none.alias("children"), none.alias("saved"), none.alias("leaves"),
                         F.lit(None).cast("string").alias("sha"))

    def also(rows: DataFrame, **given: Column) -> DataFrame:
        return rows.select(*(given[c].alias(c) if c in given else F.lit(None).cast(t).alias(c) for c, t in facts.dtypes))

    key = {"k1": F.col("k1"), "k2": F.col("k2")}
    children = nodes.where("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("children"))
    full = materialize(
        facts.unionByName(also(children, k1=F.col("p1"), k2=F.col("p2"), children=F.col("children")))
        .unionByName(also(shard_sums(dealt, owners), **key, saved=F.col("saved"), leaves=F.col("leaves")))
        .unionByName(also(end_digests(parts), **key, sha=F.col("ends_sha256")))
        .groupBy("k1", "k2").agg(*(F.max(c).alias(c) for c in ("depth", "conv_id", "p1", "p2", "n_convs", "words", "sha")),
                                 *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("children", "saved", "leaves"))), "trie-full")
    for t in (dealt, parts, nodes):
        drop_materialized(t)

    # a parent of a thousandth of all nodes is one of a thousand at most: those are broadcast; the root's key is its own parent's
    hot_from = max(1000, full.count() // 1000)
    parents = full.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "children")
    hot = F.broadcast(parents.where(F.col("children") > hot_from).drop("children"))
    cold = parents.where(F.col("children") <= hot_from).drop("children")
    below = full.join(hot, ["p1", "p2"], "left")
    held = F.col("parent_conv_id").isNotNull() | (F.col("depth") == 0)
    near, far = below.where(held), below.where(~held).drop("parent_conv_id").join(cold, ["p1", "p2"])
    return near.unionByName(far).select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def conversation_trie(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of conversations as they are."""
    return trie(with_tops(ordered_turns(table, conv, turn, role, text)))


def rebuilt_trie(table: DataFrame) -> DataFrame:
    """The trie of conversations rebuilt with borrowed heads."""
    return trie(borrowed_heads(ordered_turns(table)))


SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS w
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
          lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: i::BIGINT)),
            lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 4 AS h
      FROM t GROUP BY conv_id),
p AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(n, 0)) AS lent FROM c LEFT JOIN (SELECT conv_id, max(pos) AS n FROM t GROUP BY 1) b ON b.conv_id = c.base),
r AS (SELECT p.conv_id, t.pos, t.k, t.w FROM p JOIN t ON t.conv_id = p.base AND t.pos <= p.lent
      UNION ALL SELECT p.conv_id, t.pos - p.h + p.lent, t.k, t.w FROM p JOIN t USING (conv_id) WHERE t.pos > p.h
      UNION ALL SELECT conv_id, 0, '', 0 FROM p),
paths AS (SELECT conv_id, pos, w, md5(array_to_string(list(k) OVER (PARTITION BY conv_id ORDER BY pos), ',')) AS id,
                 max(pos) OVER (PARTITION BY conv_id) AS n FROM r),
nodes AS MATERIALIZED (SELECT pos AS depth, id, min(conv_id) AS conv_id, count(*)::BIGINT AS n_convs, any_value(w) AS w,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = pos), '')) AS ends_sha256 FROM paths GROUP BY pos, id),
up AS MATERIALIZED (SELECT DISTINCT a.pos AS depth, a.id, b.id AS parent FROM paths a LEFT JOIN paths b ON a.conv_id = b.conv_id AND b.pos = a.pos - 1),
kids AS MATERIALIZED (SELECT depth - 1 AS depth, parent AS id, count(*)::BIGINT AS n FROM up WHERE depth > 0 GROUP BY 1, 2),
sub AS (SELECT u.depth, u.id, count(*) FILTER (WHERE kids.n IS NULL)::BIGINT AS n_leaves, sum((v.n_convs - 1) * v.w)::BIGINT AS saved_tokens
        FROM (SELECT DISTINCT a.pos AS depth, a.id, b.pos AS below, b.id AS below_id FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.pos >= a.pos) u
        JOIN nodes v ON v.depth = u.below AND v.id = u.below_id LEFT JOIN kids ON kids.depth = u.below AND kids.id = u.below_id GROUP BY 1, 2)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, nodes.n_convs, coalesce(kids.n, 0)::BIGINT AS n_children, n_leaves, saved_tokens,
       nodes.ends_sha256
FROM nodes JOIN up USING (depth, id) JOIN sub USING (depth, id) LEFT JOIN kids USING (depth, id)
LEFT JOIN nodes parent ON parent.depth = nodes.depth - 1 AND parent.id = up.parent
"""
