"""Reversible line deduplication: sharded cuckoo filters over exact reference counts.

A line's key is the line without ASCII white space at its ends and with A-Z
lower-cased; keys of at least ``min_chars`` code points count. The index keeps

* references, exact: (key, doc_id, refs), refs being the lines of that document
  with that key; and counts: (key, documents that hold it, the largest of them);
* one cuckoo filter for each shard of the keys, holding a fingerprint of every
  key that has references.

A batch of documents is inserted by asking the filters first: a key that its
shard's filter doesn't hold is new, so it needs no look-up; only keys that the
filter may hold are joined with the counts. Deleting documents takes their
references back, and keys that have none left leave the filter, so a deletion
undoes an insertion. Shards are sized by the number of keys, filters grow by
being built again from the counts, also when a single one is full. ``build``
inserts a table in ``BATCHES`` batches this way, so from the second on the
filters' answers decide which keys are joined with the counts.

A key in at least ``min_docs`` documents loses all its lines except in the
largest doc_id that holds it (there all its lines stay). Other lines stay.

Defined cases: null or empty text is one empty line; repeated rows of a doc_id
are one document for counting and each get a row; rows without doc_id count for
nothing and lose nothing; an empty table gives an empty result.

Scale: keys are counted with partial sums before the shuffle, so a line that a
third of the documents share is one row for each task; each shard is one task's
bounded group of distinct keys; the lines to drop join the documents by doc_id.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import drop_materialized, map_rows, materialize, ship, texts

MIN_CHARS = 40
MIN_DOCS = 5
STRIP = " \t\n\x0b\x0c\r"
SHARD_KEYS = 200_000
BATCHES = 2
SLOTS = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def line_key(line: str) -> str:
    """The line's key: stripped, A-Z lower-cased."""
    return line.strip(STRIP).encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _key_pair(key: str) -> tuple[int, int]:
    d = hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


class CuckooFilter:
    """Cuckoo filter of 16-bit fingerprints, four to a bucket; whole batches at a time."""

    def __init__(self, n_buckets: int, table: np.ndarray | None = None):
        self.mask = n_buckets - 1
        self.table = np.zeros((n_buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def sized(cls, items: int) -> CuckooFilter:
        return cls(1 << max(4, math.ceil(math.log2(max(items, 1) / (SLOTS * 0.8)))))

    @classmethod
    def of(cls, k1: np.ndarray, k2: np.ndarray, spare: int = 1) -> CuckooFilter:
        f = cls.sized(len(k1) * spare)
        while not f.insert(k1, k2):
            f = cls(2 * len(f.table))
        return f

    def _places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fp = (k2.astype(np.uint64) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        at = ((k1.astype(np.uint64) * _MIX) >> np.uint64(32)).astype(np.int64) & self.mask
        return fp, at

    def _other(self, at: np.ndarray, fp: np.ndarray) -> np.ndarray:
        return at ^ (((fp.astype(np.uint64) * _MIX) >> np.uint64(40)).astype(np.int64) & self.mask)

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        fp, at = self._places(k1, k2)
        return ((self.table[at] == fp[:, None]) | (self.table[self._other(at, fp)] == fp[:, None])).any(axis=1)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """False if some didn't find a place (the filter is then to be built anew, larger)."""
        fp, at = self._places(k1, k2)
        rng = np.random.default_rng(7)
        for turn in range(500):
            order = np.argsort(at, kind="stable")
            fp, at = fp[order], at[order]
            first = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
            rank = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0)) if len(at) else at
            free = self.table[at] == 0
            room = rank < free.sum(axis=1)
            slots = np.argsort(~free, axis=1, kind="stable")
            self.table[at[room], slots[room, rank[room]]] = fp[room]
            fp, at, first = fp[~room], at[~room], None
            if not len(fp):
                return True
            if turn == 0:  # the other bucket first, then push others out
                at = self._other(at, fp)
                continue
            one = np.r_[True, at[1:] != at[:-1]]
            slot = rng.integers(0, SLOTS, one.sum())
            out = self.table[at[one], slot].copy()
            self.table[at[one], slot] = fp[one]
            full = out != 0
            moved = self._other(at[one], out)
            fp, at = np.r_[out[full], fp[~one]], np.r_[moved[full], at[~one]]
            if not len(fp):
                return True
        return False

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Takes out one fingerprint of each key; all keys must have been inserted."""
        fp, at = self._places(k1, k2)
        for f, a, b in zip(fp.tolist(), at.tolist(), self._other(at, fp).tolist(), strict=True):
            for bucket in (a, b):
                hit = np.flatnonzero(self.table[bucket] == f)
                if len(hit):
                    self.table[bucket, hit[0]] = 0
                    break


def postings(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc_id, refs): keys of the documents' lines; repeated rows of a doc_id count once."""
    def make():
        def step(b):
            out = ([], [], [], [])
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                refs: dict[str, int] = {}
                for line in t.split("\n"):
                    if len(line) >= min_chars and len(k := line_key(line)) >= min_chars:
                        refs[k] = refs.get(k, 0) + 1
                for k, n in refs.items():
                    a, c = _key_pair(k)
                    for col, v in zip(out, (a, c, d, n), strict=True):
                        col.append(v)
            return dict(zip(("k1", "k2", "doc_id", "refs"), out, strict=True))
        return step

    rows = map_rows(texts(docs).where("doc_id is not null"), make, "k1 long, k2 long, doc_id long, refs long")
    return rows.groupBy("k1", "k2", "doc_id").agg(F.max("refs").alias("refs"))


_REFS = "k1 long, k2 long, doc_id long, refs long"
_COUNTS = "k1 long, k2 long, n long, keeper long"
_FILTER = "shard int, n_buckets long, slots binary"


def _filter_row(shard: int, f: CuckooFilter) -> pa.Table:
    return pa.table({"shard": pa.array([shard], pa.int32()), "n_buckets": pa.array([len(f.table)], pa.int64()),
                     "slots": pa.array([f.table.tobytes()], pa.binary())})


def _stored(rows: pa.Table) -> CuckooFilter | None:
    if not rows.num_rows:
        return None
    n = rows.column("n_buckets")[0].as_py()
    return CuckooFilter(n, np.frombuffer(rows.column("slots")[0].as_py(), np.uint16).reshape(n, SLOTS).copy())


def _keys(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return rows.column("k1").to_numpy(), rows.column("k2").to_numpy()


class LineIndex:
    """References, counts by key and filters as tables; ``insert`` and ``delete`` return a new index.

    ``refs`` (k1, k2, doc_id, refs) and ``counts`` (k1, k2, n, keeper: documents of a key and the
    largest of them) are exact; ``filters`` hold the keys of ``counts``.
    """

    def __init__(self, refs: DataFrame, counts: DataFrame, filters: DataFrame, n_shards: int, min_chars: int = MIN_CHARS):
        self.refs, self.counts, self.filters, self.n_shards, self.min_chars = refs, counts, filters, n_shards, min_chars

    @classmethod
    def build(cls, docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> LineIndex:
        """The index of all documents, inserted batch by batch: by a hash of doc_id, so each has about as many."""
        spark = docs.sparkSession
        index = cls(spark.createDataFrame([], _REFS), spark.createDataFrame([], _COUNTS), spark.createDataFrame([], _FILTER), 0, min_chars)
        batch = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(batches))
        for k in range(batches):
            grown = index.insert(docs.where(batch == k), spare=batches if not index.n_shards else 1)
            index.drop(grown)
            index = grown
        return index

    def drop(self, heir: LineIndex | None = None) -> None:
        """Deletes the tables that ``heir`` doesn't read."""
        kept = {id(t) for t in (heir.refs, heir.counts, heir.filters)} if heir else set()
        for t in (self.refs, self.counts, self.filters):
            if id(t) not in kept:
                drop_materialized(t)

    def _shard(self, n: int) -> F.Column:
        return F.pmod(F.col("k1"), F.lit(n)).cast("int").alias("shard")

    def _changed(self, changes: DataFrame, filters: DataFrame, spare: int = 1) -> DataFrame:
        """Filters after the changes: (shard, k1, k2, change), +1 inserts a key and -1 deletes it.

        A filter that can't hold its keys comes back with no buckets. ``spare``: how often as many
        keys as now a new filter is to have room for.
        """
        ship(changes.sparkSession)

        def change(key, new: pa.Table, old: pa.Table) -> pa.Table:
            f = _stored(old)
            k1, k2 = _keys(new)
            add = new.column("change").to_numpy() > 0 if new.num_rows else np.zeros(0, bool)
            if f is None:
                f = CuckooFilter.of(k1[add], k2[add], spare)
            else:
                f.delete(k1[~add], k2[~add])
                if add.any() and not f.insert(k1[add], k2[add]):
                    f = CuckooFilter(0)
            return _filter_row(key[0].as_py(), f)

        return changes.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(change, _FILTER)

    def probe(self, keys: DataFrame) -> DataFrame:
        """The rows of keys (shard, k1, k2, ...) and maybe: may the filters hold the key? False is certain."""
        ship(keys.sparkSession)

        def ask(key, new: pa.Table, old: pa.Table) -> pa.Table:
            f = _stored(old)
            k1, k2 = _keys(new)
            maybe = np.zeros(len(k1), bool) if f is None else f.contains(k1, k2)
            return new.append_column("maybe", pa.array(maybe))

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys.schema)
        return keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(ask, f"{schema}, maybe boolean")

    def insert(self, docs: DataFrame, spare: int = 1) -> LineIndex:
        """Adds documents; those that the index already has are left as they are, whatever their text is now."""
        new = postings(docs, self.min_chars)
        if self.n_shards:
            new = new.join(self.refs.select("doc_id").distinct(), "doc_id", "left_anti").select("k1", "k2", "doc_id", "refs")
        new = materialize(new, "line-refs")
        if not self.n_shards:
            counts = materialize(_counted(new), "line-counts")
            n = max(1, math.ceil(spare * counts.count() / SHARD_KEYS))
            changes = counts.select(self._shard(n), "k1", "k2", F.lit(1).alias("change"))
            filters = materialize(self._changed(changes, self.filters, spare), "line-filters")
            return LineIndex(new, counts, filters, n, self.min_chars)
        asked = materialize(self.probe(_counted(new).select(self._shard(self.n_shards), "k1", "k2", "n", "keeper")), "line-probe")
        # the filters' answer: only keys that they may hold are looked up in the counts, the others are new
        old = self.counts.select("k1", "k2", F.col("n").alias("held"), F.col("keeper").alias("held_keeper"))
        met = old.join(asked.where("maybe").select("k1", "k2", "n", "keeper"), ["k1", "k2"], "full").select(
            "k1", "k2", (F.coalesce("held", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n"),
            F.greatest("held_keeper", "keeper").alias("keeper"), F.isnull("held").alias("fresh"))
        grown = materialize(met.union(asked.where("not maybe").select("k1", "k2", "n", "keeper", F.lit(True))), "line-counts")
        refs = materialize(self.refs.union(new), "line-refs")
        out = LineIndex(refs, grown, self.filters, self.n_shards, self.min_chars)._grown(grown.where("fresh"))
        for t in (asked, new):
            drop_materialized(t)
        return out

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Takes back what the documents (column doc_id) had added."""
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        refs = materialize(self.refs.join(ids, "doc_id", "left_anti").select("k1", "k2", "doc_id", "refs"), "line-refs")
        touched = materialize(self.refs.join(ids, "doc_id", "left_semi").select("k1", "k2").distinct(), "line-touched")
        again = _counted(refs.join(touched, ["k1", "k2"], "left_semi"))
        counts = materialize(self.counts.select("k1", "k2", "n", "keeper").join(touched, ["k1", "k2"], "left_anti").union(again), "line-counts")
        gone = touched.join(counts, ["k1", "k2"], "left_anti")
        changes = gone.select(self._shard(max(self.n_shards, 1)), "k1", "k2", F.lit(-1).alias("change"))
        filters = materialize(self._changed(changes, self.filters), "line-filters")
        drop_materialized(touched)
        return LineIndex(refs, counts, filters, self.n_shards, self.min_chars)

    def _grown(self, fresh: DataFrame) -> LineIndex:
        """With the fresh keys in the filters; shards are dealt anew when they get too full, or one of them does."""
        n_keys = self.counts.count()
        if n_keys > 0.9 * self._room():
            return self.reshard(math.ceil(2 * n_keys / SHARD_KEYS))
        changes = fresh.select(self._shard(self.n_shards), "k1", "k2", F.lit(1).alias("change"))
        filters = materialize(self._changed(changes, self.filters), "line-filters")
        if filters.where("n_buckets = 0").isEmpty():
            return LineIndex(self.refs, self.counts, filters, self.n_shards, self.min_chars)
        drop_materialized(filters)
        return self.reshard(self.n_shards)

    def _room(self) -> int:
        return self.filters.agg(F.coalesce(F.sum("n_buckets"), F.lit(0))).first()[0] * SLOTS

    def reshard(self, n_shards: int) -> LineIndex:
        n = max(1, n_shards)
        changes = self.counts.select(self._shard(n), "k1", "k2", F.lit(1).alias("change"))
        empty = self.refs.sparkSession.createDataFrame([], _FILTER)
        return LineIndex(self.refs, self.counts, materialize(self._changed(changes, empty), "line-filters"), n, self.min_chars)

    def doomed(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(doc_id, keys array<struct<k1,k2>>): the keys whose lines each document loses."""
        common = self.counts.where(F.col("n") >= min_docs).select("k1", "k2", "keeper")
        hit = self.refs.join(common, ["k1", "k2"]).where("doc_id <> keeper")
        return hit.groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2")).alias("keys"))  # a document's own lines


def _counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))


def _kept(text: str, drop: set[tuple[int, int]], min_chars: int) -> tuple[int, list[str]]:
    lines = text.split("\n")
    if not drop:
        return len(lines), lines
    return len(lines), [x for x in lines if len(x) < min_chars or len(k := line_key(x)) < min_chars or _key_pair(k) not in drop]


def _drop_set(keys: list | None) -> set[tuple[int, int]]:
    return {(x["k1"], x["k2"]) for x in keys or ()}


def _with_doomed(docs: DataFrame, index: LineIndex, min_docs: int) -> DataFrame:
    """docs and a last column of dropped keys; the documents aren't sorted for the join."""
    doomed = index.doomed(min_docs).select(F.col("doc_id").alias("__line_doc"), F.col("keys").alias("__line_keys"))
    names = docs.columns
    return docs.join(doomed.hint("shuffle_hash"), docs["doc_id"].cast("long") == F.col("__line_doc"), "left").select(
        *[docs[c] for c in names], "__line_keys")


def report(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""
    index = LineIndex.build(docs, min_chars)

    def make():
        def step(b):
            n, gone, sha = [], [], []
            for t, keys in zip(b.column("text").to_pylist(), b.column("__line_keys").to_pylist(), strict=True):
                lines, kept = _kept(t, _drop_set(keys), min_chars)
                n.append(lines)
                gone.append(lines - len(kept))
                sha.append(hashlib.sha256("\n".join(kept).encode("utf-8", "surrogatepass")).hexdigest())
            return {"doc_id": b.column("doc_id"), "n_lines": n, "n_dropped": gone, "kept_sha256": sha}
        return step

    return map_rows(_with_doomed(texts(docs), index, min_docs), make,
                    "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def without_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents, all columns; texts lose their common lines and n_chars, if there, follows the text."""
    ship(docs.sparkSession)
    index = LineIndex.build(docs, min_chars)
    names = docs.columns
    at, n_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    schema = docs.schema

    def run(batches):
        for b in batches:
            cols = [b.column(i) for i in range(len(names))]
            old, keys = cols[at].to_pylist(), b.column(len(names)).to_pylist()
            new = [t if not k else "\n".join(_kept(t or "", _drop_set(k), min_chars)[1]) for t, k in zip(old, keys, strict=True)]
            cols[at] = pa.array(new, cols[at].type)
            if n_at is not None:
                n = cols[n_at].to_pylist()
                cols[n_at] = pa.array([len(t) if k else v for t, k, v in zip(new, keys, n, strict=True)], cols[n_at].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return _with_doomed(docs, index, min_docs).mapInArrow(run, schema)



SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.pos, k.line, c.keeper IS NOT NULL AND k.doc_id <> c.keeper AS gone
      FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
