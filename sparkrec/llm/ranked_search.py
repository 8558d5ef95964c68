"""Ranked lexical search: summed accumulators of short lists inside document-at-a-time skipping over long lists.

``build_index`` cuts the documents into shards of bounded size as they are read and
writes a row for each shard, its documents' ids and lengths, and one for each of its
terms: the postings (slot, occurrences) with the largest occurrence count and the least
length among them. No row is larger than a shard's documents, so files and batches of
rows stay small however many shards a task has. The index knows nothing of the queries.
Terms are the maximal runs of ASCII letters, ASCII digits and non-ASCII characters; only
A-Z are lower-cased.

``search`` deals the items into chunks of bounded size and joins their terms with the
postings (up to ``BROADCAST_BYTES`` of terms are broadcast, more are shuffled). What is
joined is dealt by shard, in order of shard and chunk, so a task holds one shard's lists of
one chunk at a time. In a shard, an item's shortest lists, as long as they hold at
most ``SHORT_SHARE`` of the shard's documents together, are summed term at a time into
one list of accumulators. That list then counts as one more iterator, bounded by its
largest sum, beside the long lists, each bounded by its weight at the largest occurrence
count and the least length. Documents are taken window by window: iterators whose bounds
together stay below the k-th best score can't bring a new document; documents come from
the others only, and are looked up in the rest, largest bound first, as long as what they
could still win reaches the k-th best. A task keeps its best k for each item from shard
to shard, so later shards skip more. The best of all tasks follow from a window whose
limit runs before the shuffle.

Scores are whole numbers (weights from doubles once a term): the result doesn't depend
on the dealing. Totals beyond 64 bits raise.

Defined cases: null text has no terms; documents without doc_id are ranked as such, after
equal scores with one; repeated rows are documents of their own; rows that share an
item_id are one item with the terms of all of them; an item without terms, or whose terms
no document holds, gets no rows; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import drop_materialized, materialize, ship

SHARD_DOCS = 4096
SHARD_TOKENS = 4_000_000
CHUNK_BYTES = 1 << 20  # of terms and weights
BROADCAST_BYTES = 8 << 20  # of all chunks' terms; more are shuffled
SHORT_SHARE = 0.125
WINDOW = 512
PIECE = 1 << 20  # characters of a very long text that are split at once
OPEN_CHUNKS = 16  # chunks whose best a task holds at a time
NO_ID = np.iinfo(np.int64).max  # stands for a missing doc_id, which comes last

#: Separators become spaces, A-Z are lower-cased; bytes of non-ASCII characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def count_terms(text: bytes | None) -> Counter:
    """term (bytes) -> occurrences, of the whole text in UTF-8."""
    folded = (text or b"").translate(_FOLD)
    if len(folded) <= PIECE:
        return Counter(folded.split())
    found: Counter = Counter()
    start = 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        found.update(folded[start:end].split())
        start = end
    return found


# ---------------------------------------------------------------- index

#: A shard's row has no term, its terms' rows no documents.
INDEX = ("shard long, n_docs int, n_tokens long, ids binary, lengths binary, term binary, size int, most int, least int, "
         "slots binary, counts binary")


class _Shard:
    """Documents under way to one row of the index."""

    def __init__(self):
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.rank: dict[bytes, int] = {}
        self.terms, self.slots, self.counts = [], [], []
        self.n_tokens = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        found = count_terms(text)
        rank = self.rank
        self.terms.append(np.array([rank.setdefault(t, len(rank)) for t in found], np.int32))
        self.counts.append(np.fromiter(found.values(), np.int32, len(found)))
        self.slots.append(np.full(len(found), len(self.ids), np.int32))
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.lengths.append(found.total())
        self.n_tokens += self.lengths[-1]

    def full(self, docs: int, tokens: int) -> bool:
        return len(self.ids) >= docs or self.n_tokens >= tokens

    def row(self, shard: int) -> dict:
        term, slot, count = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (self.terms, self.slots, self.counts))
        order = np.argsort(term, kind="stable")  # slots ascend within a term
        term, slot, count = term[order], slot[order], count[order]
        sizes = np.bincount(term, minlength=len(self.rank)).astype(np.int32)
        starts = np.cumsum(sizes) - sizes
        lengths = np.array(self.lengths, np.int64)
        return {"shard": shard, "n_docs": int((lengths > 0).sum()), "n_tokens": int(lengths.sum()),
                "ids": np.array(self.ids, np.int64).tobytes(), "lengths": lengths.tobytes(), "terms": list(self.rank), "sizes": sizes,
                "most": np.maximum.reduceat(count, starts) if len(count) else count,
                "least": np.minimum.reduceat(np.minimum(lengths, 2**31 - 1)[slot], starts).astype(np.int32) if len(count) else count,
                "slots": slot.tobytes(), "counts": count.tobytes()}


def _index_rows(row: dict) -> pa.RecordBatch:
    """A shard as rows of the index: the documents, then the terms."""
    n = len(row["terms"])
    ends = np.concatenate([[0, 0], np.cumsum(row["sizes"], dtype=np.int64)]).astype(np.int32) * 4  # the first row has no postings

    def first(value, of: pa.DataType) -> pa.Array:
        return pa.concat_arrays([pa.array([value], of), pa.nulls(n, of)])

    def each(values, of: pa.DataType) -> pa.Array:
        return pa.concat_arrays([pa.nulls(1, of), pa.array(values, of)])

    def lists(data: bytes) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), n + 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])

    made = {"shard": pa.array(np.full(n + 1, row["shard"], np.int64)), "slots": lists(row["slots"]), "counts": lists(row["counts"]),
            **{c: first(row[c], INDEX_ARROW.field(c).type) for c in ("n_docs", "n_tokens", "ids", "lengths")},
            "term": each(row["terms"], pa.binary()), **{c: each(row[c + "s" * (c == "size")], pa.int32()) for c in ("size", "most", "least")}}
    return pa.RecordBatch.from_arrays([made[f.name] for f in INDEX_ARROW], schema=INDEX_ARROW)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: a row for each shard of documents and for each of its terms. One pass over the texts, nothing shuffled."""
    ship(docs.sparkSession)
    most_docs, most_tokens = SHARD_DOCS, SHARD_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, n = TaskContext.get().partitionId() << 32, 0
        shard = _Shard()

        for b in batches:
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                shard.add(d, t.as_py())
                if shard.full(most_docs, most_tokens):
                    yield _index_rows(shard.row(first + n))
                    shard, n = _Shard(), n + 1
        if shard.ids:
            yield _index_rows(shard.row(first + n))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return materialize(rows.mapInArrow(run, INDEX), "lex-index")


INDEX_ARROW = pa.schema([("shard", pa.int64()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("lengths", pa.binary()),
                         ("term", pa.binary()), ("size", pa.int32()), ("most", pa.int32()), ("least", pa.int32()),
                         ("slots", pa.binary()), ("counts", pa.binary())])


# ---------------------------------------------------------------- one shard


class Totals:
    """Documents with a term (N) and their terms with repeats (L)."""

    def __init__(self, n_docs: int, n_tokens: int):
        self.n_docs, self.n_tokens = n_docs, n_tokens

    def norm(self, lengths: np.ndarray) -> np.ndarray:
        if not self.n_tokens:
            return np.full(len(lengths), 50, np.int64)
        if len(lengths) and 50 * self.n_docs * int(lengths.max()) >= 2**63:
            raise OverflowError("50 * length * documents needs more than 64 bits")
        return 50 + (50 * self.n_docs * lengths) // self.n_tokens


def impact(weight: int, count: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * count) // (1000 * count + 20 * norm))


class Postings:
    """A shard's list of one term, scored when it is first asked for."""

    def __init__(self, slots: np.ndarray, counts: np.ndarray, norm: np.ndarray, weight: int, bound: int):
        self.slots, self.bound, self._counts, self._norm, self._weight = slots, bound, counts, norm, weight
        self._scores: np.ndarray | None = None

    @property
    def scores(self) -> np.ndarray:
        if self._scores is None:
            self._scores = impact(self._weight, self._counts.astype(np.int64), self._norm[self.slots])
        return self._scores


class ShardIndex:
    """A shard of the index, opened for the terms that are asked for."""

    def __init__(self, row: dict, totals: Totals, asked: dict[bytes, int]):
        self.ids = np.frombuffer(row["ids"], np.int64)
        norm = totals.norm(np.frombuffer(row["lengths"], np.int64))
        slots, counts = np.frombuffer(row["slots"], np.int32), np.frombuffer(row["counts"], np.int32)
        sizes = row["sizes"]
        ends = np.cumsum(sizes)
        self.lists: dict[bytes, Postings] = {}
        for at, t in enumerate(row["terms"]):
            if t in asked:
                a, b = ends[at] - sizes[at], ends[at]
                low = totals.norm(np.array([row["least"][at]], np.int64))
                bound = int(impact(asked[t], np.array([row["most"][at]], np.int64), low)[0])
                self.lists[t] = Postings(slots[a:b], counts[a:b], norm, asked[t], bound)


class Accumulators:
    """Short lists, summed term at a time: one more list with its bound."""

    def __init__(self, lists: list[Postings], n: int):
        total = np.zeros(n, np.int64)
        for p in lists:
            total[p.slots] += p.scores
        self.slots = np.flatnonzero(total).astype(np.int32)
        self.scores = total[self.slots]
        self.bound = int(self.scores.max(initial=0))


class Best:
    """The k best (score, doc_id) so far of one item."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def kth(self) -> int:
        """Documents below this score can't enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        top = np.lexsort((i, -s))[:self.k]
        self.score, self.ids = s[top], i[top]


def search_shard(index: ShardIndex, terms: list[bytes], best: Best, share: float = SHORT_SHARE, window: int = WINDOW) -> int:
    """Adds the shard's documents for one item; returns how many postings were read document at a time."""
    lists = sorted((index.lists[t] for t in terms if t in index.lists), key=lambda p: len(p.slots))
    n, short, room = len(index.ids), 0, share * len(index.ids)
    while short < len(lists) and len(lists[short].slots) <= room:
        room -= len(lists[short].slots)
        short += 1
    merged = [Accumulators(lists[:short], n)] if short else []
    its = sorted((p for p in [*merged, *lists[short:]] if p.bound > 0), key=lambda p: p.bound)
    if not its:
        return 0
    reach = np.cumsum([p.bound for p in its])  # what its[0..i] can bring together
    edges = np.arange(0, n + window, window)
    cuts = [np.searchsorted(p.slots, edges) for p in its]
    done = 0
    for w in range(len(edges) - 1):
        need = best.kth()
        first = int(np.searchsorted(reach, need))  # lists before this one can't bring a document alone
        if first == len(its):
            break
        at = int(edges[w])
        partial = np.zeros(min(window, n - at), np.int64)
        for p, c in zip(its[first:], cuts[first:], strict=True):
            a, b = c[w], c[w + 1]
            partial[p.slots[a:b] - at] += p.scores[a:b]
            done += int(b - a)
        found = np.flatnonzero(partial)
        for k in range(first - 1, -1, -1):
            found = found[partial[found] + reach[k] >= need]
            if not len(found):
                break
            p, a, b = its[k], cuts[k][w], cuts[k][w + 1]
            place = np.searchsorted(p.slots[a:b], found + at)
            there = place < b - a
            there[there] = p.slots[a:b][place[there]] == found[there] + at
            partial[found[there]] += p.scores[a:b][place[there]]
            done += int(there.sum())
        found = found[partial[found] >= need]
        if len(found):
            best.add(partial[found], index.ids[found + at])
    return done


# ---------------------------------------------------------------- all shards


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term): every term of an item, once each."""
    ship(items.sparkSession)
    schema = pa.schema([("item_id", pa.int64()), ("term", pa.binary())])

    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for i, t in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                out += [(i, term) for term in count_terms(t)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([t for _, t in out], pa.binary())], schema=schema)

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "item_id long, term binary").distinct()


def weighted_terms(index: DataFrame, terms: DataFrame, n_docs: int) -> DataFrame:
    """(item_id, term, weight): terms that some document holds; frequencies over the whole index."""
    held = index.where(F.col("term").isNotNull()).select("term", F.col("size").alias("df"))
    df = held.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum(F.col("df").cast("long")).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    return terms.join(df.select("term", weight.cast("long").alias("weight")), "term").where(F.col("weight") > 0)


def _chunks(terms: DataFrame) -> tuple[DataFrame, int]:
    """(chunk, term, weight, items that ask for it) and the terms' bytes: items dealt into chunks of about CHUNK_BYTES."""
    total = terms.agg(F.coalesce(F.sum(16 + F.octet_length("term")), F.lit(0)).alias("n")).first().n
    chunk = F.pmod(F.xxhash64("item_id"), F.lit(max(1, -(-total // CHUNK_BYTES))))
    asking = F.transform(F.collect_list(F.struct("item_id")), lambda i: i["item_id"])  # an item may have no id
    return terms.groupBy(chunk.alias("chunk"), "term", "weight").agg(asking.alias("items")), total


SHARD_COLUMNS = ("shard", "chunk", "ids", "lengths", "term", "weight", "items", "size", "most", "least", "slots", "counts")


def _dealt(index: DataFrame, chunks: DataFrame, n_bytes: int) -> DataFrame:
    """Each shard's documents, then its lists for every chunk, in one task: terms of BROADCAST_BYTES at most are broadcast."""
    few = F.broadcast(chunks) if n_bytes <= BROADCAST_BYTES else chunks.hint("merge")
    lists = index.where(F.col("term").isNotNull()).drop("ids", "lengths").join(few, "term")
    heads = index.where(F.col("term").isNull()).select("shard", "ids", "lengths")
    rows = heads.unionByName(lists, allowMissingColumns=True).select(*SHARD_COLUMNS)
    return rows.repartition("shard").sortWithinPartitions("shard", F.asc_nulls_first("chunk"))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict, dict, dict]]:
    """(chunk, a shard's row with the lists that the chunk asks for, term -> weight, item -> terms)."""
    key, head, lists = None, None, []

    def opened() -> tuple[int, dict, dict, dict]:
        term, weight, items, size, most, least, slots, counts = zip(*lists, strict=True)
        asked: dict = {}
        for t, asking in zip(term, items, strict=True):
            for i in asking:
                asked.setdefault(i, []).append(t)
        row = {"ids": head[0], "lengths": head[1], "terms": term, "sizes": size, "most": most, "least": least, "slots": b"".join(slots), "counts": b"".join(counts)}
        return key[1], row, dict(zip(term, weight, strict=True)), asked

    for b in batches:
        for shard, chunk, ids, lengths, *of_term in zip(*(b.column(c).to_pylist() for c in SHARD_COLUMNS), strict=True):
            if (shard, chunk) != key:
                if lists:
                    yield opened()
                key, lists = (shard, chunk), []
            if chunk is None:
                head = ids, lengths
            else:
                lists.append(of_term)
    if lists:
        yield opened()


def search(index: DataFrame, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    spark = index.sparkSession
    size = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")).first()
    n_docs, n_tokens = int(size.n), int(size.t)
    terms = weighted_terms(index, item_terms(items, id_col, text_col), n_docs)
    asked = materialize(terms, "lex-items")
    chunks, n_bytes = _chunks(asked)
    ship(spark)
    share, window, most_open = SHORT_SHARE, WINDOW, OPEN_CHUNKS
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def out(held: dict) -> pa.RecordBatch:
        rows = [(i, None if d == NO_ID else d, x) for i, best in held.items() for x, d in zip(best.score.tolist(), best.ids.tolist(), strict=True)]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    def run(batches):
        totals, held = Totals(n_docs, n_tokens), {}
        for chunk, row, weights, asked_here in _shards(batches):
            if chunk not in held:
                if len(held) == most_open:
                    yield out(held.pop(next(iter(held))))
                held[chunk] = {}
            shard = ShardIndex(row, totals, weights)
            for item, terms in asked_here.items():
                search_shard(shard, terms, held[chunk].setdefault(item, Best(k)), share, window)
        for bests in held.values():
            yield out(bests)

    found = _dealt(index, chunks, n_bytes).mapInArrow(run, "item_id long, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    done = materialize(ranked, "lex-found")
    drop_materialized(asked)
    return done


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The items' best documents, through an index that is deleted again."""
    index = build_index(docs)
    found = search(index, items, k)
    drop_materialized(index)
    return found


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
tf AS (SELECT row_no, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf, any_value(n) AS n
       FROM (SELECT row_no, doc_id, len(words)::BIGINT AS n, unnest(words) AS term FROM d) GROUP BY row_no, term),
total AS (SELECT count(*)::BIGINT AS n_docs, coalesce(sum(len(words)), 0)::BIGINT AS n_tokens FROM d WHERE len(words) > 0),
df AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT i.item_id, tf.row_no, any_value(tf.doc_id) AS doc_id,
             sum(df.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * tf.n * n_docs) // n_tokens))))::BIGINT AS score
      FROM i JOIN df USING (term) JOIN tf USING (term), total GROUP BY i.item_id, tf.row_no),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
