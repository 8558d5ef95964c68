"""I-Match fingerprints over randomised lexicon subsets.

Terms are lower-cased words. The lexicon is the terms whose document frequency is
within a band of the number of documents (an inverse-document-frequency band);
terms outside it are too common to tell documents apart or too rare to recur.
Each of the subsets keeps a term with the rate of its level, by a hash of the
term. A document's distinct lexicon terms are sorted and, for each subset, those
in the subset are hashed: one code of four hex digits. Dense subsets change with
any edit, sparse ones survive larger edits. Two fingerprints are compared on the
sparsest levels that have terms of either document in ``EVIDENCE`` subsets: there
a subset holds few terms, and the share of equal codes follows the share of terms
that the documents have in common.

The band's lower end bounds the lexicon whatever the input: a term in at least a
share f of N documents, with T distinct terms on average, leaves at most T / f
terms. So the lexicon is broadcast. Document frequencies count all documents.

A document without lexicon terms has the codes of all its distinct terms instead
(the subsets then draw from those), and one without any term has the empty code
everywhere. Equal texts have equal fingerprints.

Defined cases: null text is empty; equal doc_ids are taken in the order of their
texts; rows without doc_id come last; repeated rows each get a row; an only
document is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import map_rows, materialize, ship, texts

BAND = (0.0005, 0.1)  # of the documents
MIN_DF = 2
RATES = (0.5, 0.125, 1 / 32, 1 / 128, 1 / 512, 1 / 2048)
PER_RATE = 20
EVIDENCE = 12
EMPTY = "----"
WORD = re.compile(r"[^\W_]+")


def terms(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def _hashes(words: list[str]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.array([h(w) for w in words], np.uint64)


def _subsets(hashes: np.ndarray) -> np.ndarray:
    """Boolean rows of terms by columns of subsets."""
    n = len(RATES) * PER_RATE
    out = np.zeros((len(hashes), n), bool)
    for k in range(n):
        x = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
        out[:, k] = (x >> np.uint64(32)) < np.uint64(RATES[k // PER_RATE] * 2**32)
    return out


class Lexicon:
    """The band's terms with their hashes and subsets."""

    def __init__(self, words: list[str]):
        words = sorted(words)
        self.rank = {w: i for i, w in enumerate(words)}
        self.hashes = _hashes(words)
        self.subsets = _subsets(self.hashes)

    def codes(self, words: set[str]) -> list[str]:
        """A code for each subset of the sorted distinct terms."""
        get = self.rank.get
        at = sorted(i for i in map(get, words) if i is not None)
        if at:
            hashes, subsets = self.hashes[at], self.subsets[at]
        elif words:
            hashes = _hashes(sorted(words))
            subsets = _subsets(hashes)
        else:
            return [EMPTY] * (len(RATES) * PER_RATE)
        digest = xxhash.xxh3_64_hexdigest
        some = subsets.any(axis=0)
        return [digest(hashes[subsets[:, k]].tobytes())[:4] if some[k] else EMPTY for k in range(len(some))]


_KEPT: dict[str, Lexicon] = {}


def _lexicon(key: str, words) -> Lexicon:
    """The lexicon of a broadcast word list, kept for a worker's next tasks; one at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Lexicon(words.value)
    return _KEPT[key]


def likeness(a: list[str], b: list[str]) -> float:
    """Share of equal codes on the sparsest levels with enough subsets that aren't empty on both sides; 1 for equal lists."""
    if a == b:
        return 1.0
    seen = equal = 0
    for level in reversed(range(len(RATES))):
        for k in range(level * PER_RATE, (level + 1) * PER_RATE):
            if a[k] != EMPTY or b[k] != EMPTY:
                seen += 1
                equal += a[k] == b[k]
        if seen >= EVIDENCE:
            break
    return equal / seen if seen else 0.0


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df) over all documents; counted in each task before the shuffle."""
    def make():
        def step(b):
            seen: Counter = Counter()
            for t in b.column("text").to_pylist():
                seen.update(terms(t))
            return {"term": list(seen), "df": list(seen.values())}
        return step

    return map_rows(texts(docs).select("text"), make, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> list[str]:
    """Terms of the band; at most (mean distinct terms) / band[0] of them."""
    n = docs.count()
    low, high = max(MIN_DF, math.ceil(band[0] * n)), max(MIN_DF, math.floor(band[1] * n))
    found = document_frequencies(docs).where(F.col("df").between(low, high)).select("term")
    return [r.term for r in found.collect()]


def fingerprints(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint): the codes of all subsets, joined."""
    shared, key = docs.sparkSession.sparkContext.broadcast(words), uuid.uuid4().hex

    def make():
        lex = _lexicon(key, shared)
        return lambda b: {"doc_id": b.column("doc_id"), "fingerprint": ["".join(lex.codes(terms(t))) for t in b.column("text").to_pylist()]}

    return map_rows(texts(docs, id_col, text_col), make, "doc_id long, fingerprint string")


LAST = -(2**63)  # stands for a missing doc_id, which comes last


def _ordered(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text, part, guest) dealt into ranges of descending doc_id.

    Each range also holds, as a guest, the first document of the next range (of the
    first range, in the last one), so a task needs nothing from others.
    """
    spark = docs.sparkSession
    ship(spark)
    body = texts(docs).withColumn("at", F.coalesce("doc_id", F.lit(LAST)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    steps = [i / n for i in range(1, n)] or [0.5]
    found = body.agg(F.percentile_approx("at", steps, 8 * n).alias("cuts")).first().cuts or []
    cuts = np.array(sorted(set(found)), np.int64)

    def range_of(x: np.ndarray) -> np.ndarray:  # 0 is the range of the largest ids
        return len(cuts) - np.searchsorted(cuts, x, side="left")

    @F.pandas_udf("int")
    def part_of(x: pd.Series) -> pd.Series:
        return pd.Series(range_of(x.to_numpy()))

    tops = body.groupBy(part_of("at").alias("part")).agg(F.max("at").alias("top")).orderBy("part").collect()  # a row for each range
    host = {r.top: tops[i - 1].part for i, r in enumerate(tops)}

    @F.pandas_udf("array<int>")
    def places(x: pd.Series) -> pd.Series:
        return pd.Series([[p] if (h := host.get(v)) is None else [p, h] for p, v in zip(range_of(x.to_numpy()).tolist(), x.tolist(), strict=True)])

    rows = body.select("doc_id", "at", "text", F.posexplode(places("at")).alias("guest", "part"))
    return rows, len(cuts) + 1


def against_neighbours(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to the document's own.

    Edited: the last floor(n/3) code points are replaced by the first as many (or
    all) of the next document, in descending doc_id, the first after the last.
    """
    words, key = docs.sparkSession.sparkContext.broadcast(lexicon(docs, band)), uuid.uuid4().hex
    rows, n = _ordered(docs)
    # hosts precede their guest: guests sort last in a range
    dealt = rows.repartitionById(n, F.col("part")).sortWithinPartitions("part", "guest", F.desc("at"), "text")

    def make():
        lex = _lexicon(key, words)
        before: list = []  # the row that waits for its next one: (part, doc_id, text, codes)

        def step(b):
            out = {k: [] for k in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
            for d, t, part, guest in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "part", "guest")), strict=True):
                own = lex.codes(terms(t))
                if before and before[0] == part:
                    _, last, text, codes = before
                    cut = len(text) // 3
                    edited = text[:len(text) - cut] + t[:cut]
                    new = lex.codes(terms(edited))
                    for k, v in (("doc_id", last), ("n_chars", len(text)),
                                 ("edited_sha256", hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()),
                                 ("fingerprint", "".join(codes)), ("edited_fingerprint", "".join(new)),
                                 ("near_edited", likeness(codes, new)), ("near_next", likeness(codes, own))):
                        out[k].append(v)
                before[:] = [] if guest else [part, d, t, own]
            return out
        return step

    return map_rows(dealt, make, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")


def same_fingerprint_groups(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """(doc_id, group_id): the least doc_id with the same fingerprint."""
    found = materialize(fingerprints(docs, lexicon(docs, band)), "imatch")
    least = found.groupBy("fingerprint").agg(F.min("doc_id").alias("group_id"))
    return found.join(least, "fingerprint").select("doc_id", "group_id")
