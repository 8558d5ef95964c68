"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles. Documents with equal sets are
one set with a multiplicity. Sets are split recursively: a run groups them by the
token (shingle) that a hash of its own makes the least, so that two sets of
Jaccard likeness J share the group with probability J. Groups of at most
``small`` sets are compared by brute force. A larger group is split again by
``BRANCH`` further sampled tokens each, down to ``DEPTH`` levels; branching keeps
the loss of a split to (1 - J)^BRANCH. Each run has hashes of its own at every level, so
what one run's splits lose another run can find. A run that splits at all levels finds
a pair with probability p = J (1 - (1 - J)^BRANCH)^(DEPTH - 1); runs repeat until a pair
at the threshold is found with probability ``recall``: ceil(log(1 - recall) / log(1 - p)).
What is still large at the last level is compared exactly too. Any group of more
than ``BLOCK_SETS`` sets is compared as pairs of blocks, so no group has a cap and
none needs one task.

Groups with the same members count once, and a pair is compared in the least of
the groups that both its sets are in. Comparisons are exact (sorted 64-bit
shingle hashes). They yield, for each set, its number of links and the least set
of its component in that group: a row for each member, not for each pair.
Components over all groups come from repeated minimum labels on written tables.

Defined cases: null text is empty; a text of fewer than five words is one
shingle, the text itself, so it is like equal texts only; repeated rows are
copies; rows without doc_id form no link (class_id null). An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import drop_materialized, map_rows, materialize, ship, texts

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.99999
SMALL = 2048
BRANCH = 2
DEPTH = 3
RUN_HASHES = 1 + BRANCH * (DEPTH - 1)  # of a run: one, then BRANCH for each further level
BLOCK_SETS = 1024
BLOCK_SHINGLES = 2_000_000  # sets of a compared block hold about so many shingles at most
SAMPLED_CELLS = 1 << 15  # (hash, shingle) cells that are worked out at once
WORD = re.compile(r"\w+")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def runs_for(recall: float, success: float) -> int:
    """Runs until a pair that one run finds with probability ``success`` is found with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - success) - 1e-9))


def run_success(threshold: float) -> float:
    """Least probability that one run finds a pair at the threshold: its group may be split at every level."""
    return threshold * (1 - (1 - threshold) ** BRANCH) ** (DEPTH - 1)


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams."""
    h = xxhash.xxh3_64_intdigest
    w = np.array([h(x) for x in WORD.findall(text.lower())], np.uint64)
    if len(w) < n:
        return np.array([h("short\0" + text)], np.uint64)
    s = np.zeros(len(w) - n + 1, np.uint64)
    for j in range(n):
        s += w[j:len(w) - n + 1 + j] * _ODD[j % len(_ODD)] ** np.uint64(1 + j // len(_ODD))
    return np.unique(_mix(s))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def set_id(s: np.ndarray) -> str:
    return hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest()


def sampled(s: np.ndarray, n: int) -> list[int]:
    """For each of n hashes, the token of s that it makes the least (by its hash value)."""
    seeds = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    rows = max(1, SAMPLED_CELLS // len(s))  # several hashes at once, in place: most sets are short
    out = []
    for lo in range(0, n, rows):
        x = s ^ seeds[lo:lo + rows, None]
        y = x >> np.uint64(30)
        x ^= y
        x *= np.uint64(0xBF58476D1CE4E5B9)
        np.right_shift(x, np.uint64(27), out=y)
        x ^= y
        x *= np.uint64(0x94D049BB133111EB)
        np.right_shift(x, np.uint64(31), out=y)
        x ^= y
        out += x.min(axis=1).view(np.int64).tolist()
    return out


# -- comparing one group or one pair of blocks ---------------------------------------------------------------------


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets of a block, exactly: rare tokens by pairs, frequent ones by matrix products."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    rows, tokens = rows[order], tokens[order]
    start = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    df = np.diff(np.r_[start, len(tokens)])
    for k in range(2, 9):  # tokens in k sets
        at = start[df == k]
        for i in range(k):
            for j in range(i + 1, k):
                np.add.at(out, (rows[at + i], rows[at + j]), 1)
    out += out.T
    many = df > 8
    cols = np.repeat(np.cumsum(many) - 1, df)
    keep = np.repeat(many, df)
    r, c = rows[keep], cols[keep]
    for lo in range(0, int(many.sum()), 4096):
        part = (c >= lo) & (c < lo + 4096)
        x = np.zeros((n, 4096), np.float32)
        x[r[part], c[part] - lo] = 1
        out += x @ x.T
    return out


def compare_sets(sets: list[np.ndarray], leaves: list[list[int]], leaf: int, threshold: float,
                 cross: np.ndarray | None = None) -> np.ndarray:
    """Boolean links: likeness at least the threshold, and no lesser common group than leaf; cross: the only pairs."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.float32)
    inter = overlaps(sets)
    union = size[:, None] + size[None, :] - inter
    link = inter >= np.float32(threshold) * union - 1e-3
    exact = np.abs(inter - threshold * union) < 0.5  # the float product can't decide these
    link[exact] = inter[exact].astype(np.float64) * 1000 >= round(threshold * 1000) * union[exact].astype(np.float64)
    np.fill_diagonal(link, False)
    if cross is not None:
        link &= cross
    other = sorted({x for own in leaves for x in own if x < leaf})
    if other:
        at = {x: i for i, x in enumerate(other)}
        for lo in range(0, len(other), 4096):
            p = np.zeros((n, min(4096, len(other) - lo)), np.float32)
            for i, own in enumerate(leaves):
                for x in own:
                    if x < leaf and 0 <= at[x] - lo < p.shape[1]:
                        p[i, at[x] - lo] = 1
            link &= (p @ p.T) == 0
    return link


def components(link: np.ndarray, names: list[str]) -> list[str]:
    """The least name of each row's component."""
    n, root = len(names), list(names)
    order = sorted(range(n), key=names.__getitem__)
    seen = np.zeros(n, bool)
    for i in order:
        if seen[i]:
            continue
        todo, seen[i] = [i], True
        while todo:
            j = todo.pop()
            root[j] = names[i]
            more = np.flatnonzero(link[j] & ~seen)
            seen[more] = True
            todo.extend(more.tolist())
    return root


_LINKS = "uid string, links long, root string"


def _compare_group(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        cols = rows.select(["uid", "mult", "text", "leaf", "leaves", "side"]).to_pydict()
        keep, sets, seen = [], [], set()
        for i, (t, u, side) in enumerate(zip(cols["text"], cols["uid"], cols["side"], strict=True)):
            if (u, side) in seen:
                continue
            s = shingles(t)
            if set_id(s) == u:  # a doc_id may be there with other texts
                seen.add((u, side))
                keep.append(i)
                sets.append(s)
        out = {"uid": [], "links": [], "root": []}
        if len(sets) > 1:
            uid, side = [cols["uid"][i] for i in keep], np.array([cols["side"][i] for i in keep])
            cross = (side[:, None] != side[None, :]) if (side > 0).any() else None
            link = compare_sets(sets, [cols["leaves"][i] for i in keep], cols["leaf"][0], threshold, cross)
            links = link @ np.array([cols["mult"][i] for i in keep], np.float64)
            roots = components(link, uid)
            for i in np.flatnonzero(links).tolist():
                out["uid"].append(uid[i])
                out["links"].append(int(links[i]))
                out["root"].append(roots[i])
        return pa.table({"uid": pa.array(out["uid"], pa.string()), "links": pa.array(out["links"], pa.int64()),
                         "root": pa.array(out["root"], pa.string())})
    return run


# -- the join ------------------------------------------------------------------------------------------------------


def _sketches(docs: DataFrame, n_hashes: int) -> DataFrame:
    def make():
        def step(b):
            ids, size, picks = [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t)
                ids.append(set_id(s))
                size.append(len(s))
                picks.append(sampled(s, n_hashes))
            return {"doc_id": b.column("doc_id"), "uid": ids, "size": size, "picks": picks}
        return step

    return map_rows(texts(docs).where("doc_id is not null"), make, "doc_id long, uid string, size long, picks array<long>")


def _paths(sets: DataFrame, runs: int, small: int) -> DataFrame:
    """(uid, size, leaf, n): the groups of two and more sets that are not split further."""
    level = sets.select("uid", "size", "picks", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    level = level.select("uid", "size", F.slice("picks", F.col("run") * RUN_HASHES + 1, RUN_HASHES).alias("own"), "run").select(
        "uid", "size", "own", F.xxhash64("run", F.col("own")[0]).alias("leaf"))
    done = []
    for depth in range(1, DEPTH + 1):
        groups = level.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")
        level = materialize(level.join(groups, "leaf"), "path-level")
        last = depth == DEPTH
        done.append(level.select("uid", "size", "leaf", "n") if last else level.where(F.col("n") <= small).select("uid", "size", "leaf", "n"))
        if last or level.where(F.col("n") > small).isEmpty():
            break
        step = [F.lit(1 + BRANCH * (depth - 1) + j) for j in range(BRANCH)]
        level = level.where(F.col("n") > small).select("uid", "size", "own", "leaf", F.explode(F.array(*step)).alias("by")).select(
            "uid", "size", "own", F.xxhash64("leaf", "by", F.col("own")[F.col("by")]).alias("leaf"))
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    return out


def _tasks(leaves: DataFrame, small: int) -> DataFrame:
    """(uid, leaves, leaf, task, side) for each comparison that a set takes part in.

    Groups with equal members are one. Groups that are large, or whose sets are, become pairs of blocks.
    """
    h = F.xxhash64("uid")
    groups = leaves.groupBy("leaf").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.bit_xor(h).alias("x"),
                                        F.sum(F.pmod(h, F.lit(1 << 31))).alias("s"))
    kept = groups.groupBy("n", "x", "s").agg(F.min("leaf").alias("leaf"), F.max("total").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / F.lit(min(small, BLOCK_SETS))), F.ceil(F.col("total") / F.lit(BLOCK_SHINGLES)))
    kept = kept.select("leaf", F.least(blocks, F.col("n")).cast("int").alias("blocks"))
    own = materialize(leaves.select("uid", "leaf").distinct().join(kept, "leaf"), "path-leaves")
    lists = own.groupBy("uid").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))  # bounded by runs and branching
    mine = F.pmod(F.xxhash64(F.col("uid"), F.lit("block")), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = own.select("uid", "leaf", mine.alias("mine"), other)
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    # one block compares within itself (side 0); of two blocks the lesser is side 1 and the other side 2
    tasks = placed.select("uid", "leaf", F.xxhash64("leaf", low, high).alias("task"),
                          F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"))
    return tasks.join(lists, "uid")


def _classes(edges: DataFrame) -> DataFrame:
    """(uid, root): the least uid of each connected component, from (uid, root) edges."""
    both = materialize(edges.where("uid <> root").distinct(), "path-edges")
    label = materialize(both.groupBy("uid").agg(F.min("root").alias("root"))
                        .unionByName(both.select(F.col("root").alias("uid"), "root")).groupBy("uid").agg(F.min("root").alias("root")),
                        "path-labels")
    while True:
        # the least label at either end of an edge, given to both ends and to their present roots
        ends = (both.select(F.col("uid").alias("a"), F.col("root").alias("b"))
                .join(label.select(F.col("uid").alias("a"), F.col("root").alias("la")), "a")
                .join(label.select(F.col("uid").alias("b"), F.col("root").alias("lb")), "b"))
        least = F.least("la", "lb")
        told = ends.select(F.explode(F.array("a", "b", "la", "lb")).alias("uid"), least.alias("root"))
        new = label.unionByName(told).groupBy("uid").agg(F.min("root").alias("root"))
        # then each label is replaced by its own label
        up = new.select(F.col("uid").alias("root"), F.col("root").alias("higher"))
        new = materialize(new.join(up, "root", "left").select("uid", F.least("root", F.coalesce("higher", "root")).alias("root")), "path-labels")
        moved = not new.join(label.withColumnRenamed("root", "old"), "uid").where("root <> old").isEmpty()
        drop_materialized(label)
        label = new
        if not moved:
            drop_materialized(both)
            return label


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, small: int = SMALL) -> DataFrame:
    """(doc_id, class_id, n_links, uid): a row for each document.

    class_id is the least doc_id of its connected component of links, n_links the
    number of other documents with likeness at least ``threshold``.
    """
    ship(docs.sparkSession)
    runs = runs_for(recall, run_success(threshold))
    known = materialize(_sketches(docs, runs * RUN_HASHES), "path-sketch")
    sets = known.groupBy("uid").agg(F.count("*").alias("mult"), F.min("doc_id").alias("first"), F.min("size").alias("size"),
                                    F.min("picks").alias("picks"))
    sets = materialize(sets, "path-sets")
    tasks = _tasks(_paths(sets, runs, small), small)
    wanted = tasks.groupBy("uid", "leaves").agg(F.collect_list(F.struct("leaf", "task", "side")).alias("tasks"))  # of one set
    wanted = wanted.join(sets.select("uid", "mult", "first"), "uid")
    body = texts(docs).where("doc_id is not null")
    rows = (body.join(wanted.hint("shuffle_hash"), body["doc_id"] == wanted["first"])
            .select("uid", "mult", "leaves", "text", F.explode("tasks").alias("t"))
            .select("uid", "mult", "leaves", "text", "t.leaf", "t.task", "t.side"))
    found = materialize(rows.groupBy("task").applyInArrow(_compare_group(threshold), _LINKS), "path-links")
    classes = _classes(found.select("uid", "root"))
    degree = found.groupBy("uid").agg(F.sum("links").alias("links"))
    named = (sets.select("uid", "mult", "first").join(degree, "uid", "left").join(classes, "uid", "left")
             .withColumn("root", F.coalesce("root", "uid")))
    least = named.groupBy("root").agg(F.min("first").alias("class_id"))
    named = named.join(least, "root").select(
        "uid", "class_id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    named = materialize(named, "path-classes")
    out = known.select("doc_id", "uid").join(named, "uid").select("doc_id", "class_id", "n_links", "uid")
    none = texts(docs).where("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"),
                                                      F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("string").alias("uid"))
    return out.union(none)


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The documents, all columns, without those that have a lesser doc_id in their class.

    Of repeated rows with equal shingles one stays; rows without doc_id stay.
    """
    found = jaccard_classes(docs, threshold, recall).where("doc_id is not null").select("doc_id", "class_id", "uid")
    found = materialize(found.distinct(), "path-found")
    firsts = found.where("doc_id = class_id")
    id_of = docs["doc_id"].cast("long")
    repeated = materialize(docs.where("doc_id is not null").groupBy(id_of.alias("doc_id")).agg(F.count("*").alias("n"))
                           .where("n > 1").select(F.col("doc_id").alias("__again")), "path-again")
    plain = firsts.select(F.col("doc_id").alias("__first")).join(repeated, F.col("__first") == F.col("__again"), "left_anti")
    out = docs.join(plain.hint("shuffle_hash"), id_of == F.col("__first"), "left_semi").unionByName(docs.where("doc_id is null"))
    if repeated.isEmpty():
        return out
    # repeated ids: which row is which set shows only in its text
    again = docs.join(repeated.hint("shuffle_hash"), id_of == F.col("__again"), "left_semi")
    names = again.columns
    keep = firsts.join(repeated, firsts["doc_id"] == F.col("__again"), "left_semi").select(
        F.col("doc_id").alias("__doc"), F.col("uid").alias("__set"))
    marked = again.withColumn("__uid", _uid_column(again["text"]))
    rank = F.row_number().over(Window.partitionBy(id_of, "__uid").orderBy(F.col("text")))
    marked = marked.withColumn("__rank", rank).where("__rank = 1")
    return out.unionByName(marked.join(keep, (marked["doc_id"].cast("long") == F.col("__doc")) & (F.col("__uid") == F.col("__set")),
                                       "left_semi").select(*names))


def _uid_column(text: F.Column) -> F.Column:
    @F.pandas_udf("string")
    def uid(t: pd.Series) -> pd.Series:
        return t.fillna("").map(lambda x: set_id(shingles(x)))

    return uid(text)


SQL = """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN 'short' || chr(1) || t
        ELSE array_to_string(w[i:i + 4], ' ') END AS s FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d) x),
n AS (SELECT doc_id, count(*) AS k FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 10 * c >= 8 * (p.k + q.k - c)),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reach)
SELECT r.doc_id, min(reach) AS class_id, coalesce(max(l.n), 0)::BIGINT AS n_links
FROM r LEFT JOIN (SELECT x, count(*) AS n FROM e GROUP BY x) l ON l.x = r.doc_id GROUP BY r.doc_id
"""
