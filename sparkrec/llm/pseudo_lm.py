"""Document scores by masked pseudo-likelihood of a bidirectional window network.

Every token of a text is predicted from its neighbours on both sides, itself
masked; the summed conditional log-probabilities score the document. The network
is small and in numpy: embeddings of two tokens on either side, a tanh layer, a
softmax over token classes. The frequent tokens are classes of their own, the
others share classes; within a class a token has its share of the corpus counts,
so probabilities are over whole tokens. A token outside the vocabulary has the
even share of all such types of its class. The vocabulary grows with the square
root of the number of types, up to the size that may be broadcast.

Texts are tokenised twice, for the counts and for their codes; the codes (two bytes a
token while the vocabulary allows it) are written once, and training and scores read
these. What is learnt comes from the whole corpus: word counts of all documents, and
rounds of training. A document belongs to a shard by a hash of its id and codes, some
million tokens each; in a round every shard trains on masked positions of all its
documents, in order of id, from the shared weights and gives its change, weighed by its
positions. A round masks one position in so many as there are rounds, another one each
time, so all rounds together train on every position once. Changes are added as whole
numbers, by parameter row, so the weights depend neither on the order of sums nor on how
rows are dealt to tasks. Only the network (some hundred kB to 17 MB) and the
vocabulary are broadcast.

Defined cases: null text is empty; a text without words has 0 tokens, sum 0 and
mean 0; positions beyond the ends are a padding token; repeated rows each count
and each get a row (equal rows train in one shard, as a stream); an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import drop_materialized, map_rows, materialize, ship, shuffle_parts, texts

WORD = re.compile(r"\w+")
VOCAB = 4096  # words at least
VOCAB_ROOT = 8  # words for each square root of the number of types
VOCAB_MOST = 1 << 18  # bounds what is broadcast: 17 MB of embeddings, some 40 MB of words
OWN_CLASSES = 40
SHARED_CLASSES = 24
OOV_INPUTS = 512
SIDE = 2
EMBED = 16
HIDDEN = 24
ROUNDS = 2
STEP = 512  # positions of a training step
RATE = 0.05
FIXED = 1 << 16
SHARD = 1 << 20  # tokens of a training shard, on average
SLICE = 1 << 14  # positions that are gathered at once
AROUND = [o for o in range(-SIDE, SIDE + 1) if o]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents."""
    def make():
        def step(b):
            seen: Counter = Counter()
            for t in b.column("text").to_pylist():
                seen.update(words(t))
            return {"word": list(seen), "n": list(seen.values())}
        return step

    return map_rows(texts(docs).select("text"), make, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, size: int | None = None) -> dict:
    """Frequent words with class and log share, and for each shared class the log share of an unknown type."""
    counts = materialize(word_counts(docs), "lm-counts")
    size = size or min(max(VOCAB, math.isqrt(VOCAB_ROOT ** 2 * counts.count())), VOCAB_MOST)
    top = counts.orderBy(F.desc("n"), "word").limit(size).collect()  # the vocabulary
    known = {r.word: r.n for r in top}
    edge = (top[-1].n, top[-1].word) if top else (0, "")
    shared = (F.lit(OWN_CLASSES) + F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(SHARED_CLASSES))).cast("int")
    tail = (F.col("n") < edge[0]) | (F.col("n") == edge[0]) & (F.col("word") > edge[1])
    rest = {r.c: (r.types, r.tokens) for r in counts.where(tail).groupBy(shared.alias("c")).agg(
        F.count("*").alias("types"), F.sum("n").alias("tokens")).collect()}  # a row for each class
    drop_materialized(counts)
    cls = {w: i if i < OWN_CLASSES else OWN_CLASSES + zlib.crc32(w.encode("utf-8", "surrogatepass")) % SHARED_CLASSES
           for i, w in enumerate(known)}
    mass = np.zeros(OWN_CLASSES + SHARED_CLASSES)
    for w, n in known.items():
        mass[cls[w]] += n
    for c, (types, tokens) in rest.items():
        mass[c] += tokens + 1
    mass = np.maximum(mass, 1.0)
    unknown = [math.log((rest.get(c, (1, 0))[1] + 1) / max(rest.get(c, (1, 0))[0], 1) / max(mass[c], 1)) if c >= OWN_CLASSES else 0.0
               for c in range(len(mass))]
    return {"ids": {w: i + 1 for i, w in enumerate(known)}, "class": [0, *[cls[w] for w in known]],
            "share": [0.0, *[math.log(n / mass[cls[w]]) for w, n in known.items()]], "unknown": [min(0.0, x) for x in unknown],
            "class_share": np.log(mass / mass.sum()).tolist()}


class _Ids(dict):
    """Code of each word; a word outside the vocabulary has the code of its hash."""

    def __missing__(self, word: str) -> int:
        h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return self.n + h % SHARED_CLASSES * OOV_INPUTS + (h >> 8) % OOV_INPUTS


class Coder:
    """Tokens as codes, and the (input id, class, log share in the class) of each code."""

    def __init__(self, vocab: dict):
        n = len(vocab["class"])
        self.ids, self.n_inputs = _Ids(vocab["ids"]), n + OOV_INPUTS
        self.ids.n = n
        oov = np.arange(OOV_INPUTS * SHARED_CLASSES)
        # ids past the vocabulary stand for (input bucket, class) of unknown words
        self.input = np.r_[np.arange(n), n + oov % OOV_INPUTS].astype(np.int32)
        own = OWN_CLASSES + oov // OOV_INPUTS
        self.cls = np.r_[np.array(vocab["class"]), own].astype(np.int32)
        self.share = np.r_[np.array(vocab["share"]), np.array(vocab["unknown"])[own]].astype(np.float32)
        self.dtype = np.dtype(np.uint16 if len(self.input) <= 1 << 16 else np.int32)

    def codes(self, tokens: list[str]) -> list[int]:
        return list(map(self.ids.__getitem__, tokens))

    def packed(self, tokens: list[str]) -> bytes:
        return array("H" if self.dtype == np.uint16 else "i", map(self.ids.__getitem__, tokens)).tobytes()


class Batch:
    """The documents of a batch of codes on one line, with padding around each."""

    def __init__(self, codes: pa.Array, coder: Coder):
        lengths = pa.compute.binary_length(codes).to_numpy(zero_copy_only=False) // coder.dtype.itemsize
        whole = np.frombuffer(b"".join(codes.to_pylist()), coder.dtype)
        self.lengths, self.ends = lengths, np.cumsum(lengths)
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        at = np.arange(len(whole)) + self.doc * (2 * SIDE) + SIDE
        self.line = np.zeros(len(whole) + len(lengths) * 2 * SIDE, coder.dtype)
        self.line[at] = whole
        self.at, self.coder = at, coder

    def position(self) -> np.ndarray:
        """Place of each token in its document."""
        return np.arange(len(self.at)) - (self.ends - self.lengths)[self.doc]

    def windows(self, picked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Neighbour inputs (positions x 2 SIDE) and own codes at some tokens, in slices of bounded memory."""
        inputs = self.coder.input[self.line]
        for a in range(0, len(picked), SLICE):
            at = self.at[picked[a:a + SLICE]]
            yield np.stack([inputs[at + o] for o in AROUND], 1), self.line[at]


class Network:
    """The weights: embeddings, a hidden layer, class logits."""

    SHAPES = ("e", "w1", "b1", "w2", "b2")

    def __init__(self, n_inputs: int, flat: np.ndarray | None = None, class_share: list[float] | None = None):
        classes = OWN_CLASSES + SHARED_CLASSES
        self.shapes = [(n_inputs, EMBED), (2 * SIDE * EMBED, HIDDEN), (1, HIDDEN), (HIDDEN, classes), (1, classes)]
        self.size = sum(a * b for a, b in self.shapes)
        if flat is None:
            rng = np.random.default_rng(11)
            flat = np.concatenate([rng.normal(0, s, a * b) for (a, b), s in zip(self.shapes, (0.3, 0.15, 0.0, 0.1, 0.0), strict=True)])
            if class_share is not None:  # starts as the corpus' own shares
                flat[-classes:] = class_share
        self.flat, at = flat.astype(np.float32), 0
        for name, (a, b) in zip(self.SHAPES, self.shapes, strict=True):
            setattr(self, name, self.flat[at:at + a * b].reshape(a, b))
            at += a * b

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c = self.e[x].reshape(len(x), -1)
        h = np.tanh(c @ self.w1 + self.b1)
        z = h @ self.w2 + self.b2
        z -= z.max(1, keepdims=True)
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        return c, h, z

    def log_prob(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Log-probability of the classes y, in slices of bounded memory."""
        out = np.zeros(len(x), np.float32)
        for a in range(0, len(x), 2048):
            z = np.tanh(self.e[x[a:a + 2048]].reshape(-1, 2 * SIDE * EMBED) @ self.w1 + self.b1) @ self.w2 + self.b2
            z -= z.max(1, keepdims=True)
            own = z[np.arange(len(z)), y[a:a + 2048]]
            out[a:a + 2048] = own - np.log(np.exp(z, out=z).sum(1))
        return out

    def train(self, x: np.ndarray, y: np.ndarray, square: np.ndarray) -> None:
        """One Adagrad step."""
        c, h, z = self.forward(x)
        g = np.exp(z)
        g[np.arange(len(y)), y] -= 1
        gh = (g @ self.w2.T) * (1 - h * h)
        gc = gh @ self.w1.T
        for name, grad in (("w2", h.T @ g), ("b2", g.sum(0, keepdims=True)), ("w1", c.T @ gh), ("b1", gh.sum(0, keepdims=True))):
            self._move(name, slice(None), grad / len(x), square)
        used = x.ravel()
        order = np.argsort(used.astype(np.uint16) if len(self.e) <= 1 << 16 else used, kind="stable")
        used = used[order]
        starts = np.flatnonzero(np.r_[True, used[1:] != used[:-1]])
        grad = np.add.reduceat(gc.reshape(-1, EMBED)[order], starts, axis=0)
        self._move("e", used[starts], grad / len(x) * 8, square)

    def _move(self, name: str, rows, grad: np.ndarray, square: np.ndarray) -> None:
        own = getattr(square, name)
        own[rows] += grad * grad
        getattr(self, name)[rows] -= RATE * grad / np.sqrt(own[rows] + 1e-6)


def first_masked(doc_hash, round_no: int, rounds: int = ROUNDS):
    """First position of a document that a round trains on (numbers or arrays of them)."""
    return (doc_hash + round_no) % rounds


def masked(n: int, doc_hash: int, round_no: int, rounds: int = ROUNDS) -> range:
    """Positions of a document with n tokens that a round trains on; each position is in one of the rounds."""
    return range(first_masked(doc_hash, round_no, rounds), n, rounds)


def picked(batch: Batch, round_no: int, rounds: int) -> np.ndarray:
    """The ``masked`` positions of all documents of a batch, known by their lengths."""
    return np.flatnonzero(batch.position() % rounds == first_masked(batch.lengths, round_no, rounds)[batch.doc])


class ShardTraining:
    """A shard's training from the shared weights, in steps of STEP positions whatever the batches."""

    def __init__(self, flat: np.ndarray, n_inputs: int):
        self.start, self.net = flat, Network(n_inputs, flat.copy())
        self.square = Network(n_inputs, np.full(len(flat), 0.01))
        self.x, self.y, self.done = np.zeros((0, 2 * SIDE), np.int32), np.zeros(0, np.int32), 0

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        self.x, self.y = np.concatenate([self.x, x]), np.concatenate([self.y, y])
        whole = len(self.x) // STEP * STEP
        for a in range(0, whole, STEP):
            self.net.train(self.x[a:a + STEP], self.y[a:a + STEP], self.square)
        self.x, self.y, self.done = self.x[whole:], self.y[whole:], self.done + whole

    def change(self) -> np.ndarray:
        """Whole numbers: change of each weight times positions."""
        if len(self.x):
            self.net.train(self.x, self.y, self.square)
            self.done, self.x = self.done + len(self.x), self.x[:0]
        return np.rint((self.net.flat - self.start).astype(np.float64) * FIXED).astype(np.int64) * self.done


def encode(docs: DataFrame, vocab, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, codes) of every document, by the broadcast vocabulary."""
    def make():
        coder = Coder(vocab.value)
        return lambda b: {"doc_id": b.column("doc_id"), "codes": [coder.packed(words(t)) for t in b.column("text").to_pylist()]}

    return map_rows(texts(docs, id_col, text_col), make, "doc_id long, codes binary")


def in_shards(codes: DataFrame, itemsize: int, shard: int = SHARD) -> DataFrame:
    """(shard, doc_id, codes), each shard whole in one task and in order."""
    size = codes.agg(F.sum(F.length("codes").cast("decimal(30,0)"))).first()[0] or 0
    n = max(1, int(size) // itemsize // shard)
    dealt = codes.select(F.pmod(F.xxhash64("doc_id", "codes"), F.lit(n)).alias("shard"), "doc_id", "codes")
    tasks = min(n, max(shuffle_parts(codes.sparkSession), codes.sparkSession.sparkContext.defaultParallelism))
    return dealt.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).sortWithinPartitions("shard", "doc_id", "codes")


def _round(sharded: DataFrame, vocab, flat: np.ndarray, round_no: int, rounds: int) -> np.ndarray:
    """Weights after all shards have trained from ``flat`` on their documents."""
    sc = sharded.sparkSession.sparkContext
    weights = sc.broadcast(flat)
    width = EMBED

    def run(batches):
        coder = Coder(vocab.value)
        total, done, shard, at_work = np.zeros(len(weights.value), np.int64), 0, None, None
        for b in batches:
            shards = b.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, e in zip(cuts, cuts[1:]):
                if a == e:
                    continue
                if shards[a] != shard:
                    if at_work:
                        total += at_work.change()
                        done += at_work.done
                    shard, at_work = shards[a], ShardTraining(weights.value, coder.n_inputs)
                docs = Batch(b.column("codes").slice(a, e - a), coder)
                for x, y in docs.windows(picked(docs, round_no, rounds)):
                    at_work.add(x, coder.cls[y])
        if at_work:
            total += at_work.change()
            done += at_work.done
        if done:
            total = np.r_[total, np.zeros(-len(total) % width, np.int64)].reshape(-1, width)
            some = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_pydict({"slot": pa.array(np.r_[some, -1].astype(np.int32)),
                                              **{f"v{i}": pa.array(np.r_[total[some, i], done if i == 0 else 0]) for i in range(width)}})

    schema = "slot int, " + ", ".join(f"v{i} long" for i in range(width))
    rows = sharded.mapInArrow(run, schema).groupBy("slot").agg(
        *[F.sum(F.col(f"v{i}").cast("decimal(20,0)")).alias(f"v{i}") for i in range(width)])
    total, change = 0, np.zeros((-(-len(flat) // width), width), np.float64)
    for r in rows.collect():  # a row for each of the network's
        if r[0] < 0:
            total = int(r[1])
        else:
            change[r[0]] = [float(v) for v in r[1:]]
    weights.unpersist()
    return flat if not total else (flat + change.ravel()[:len(flat)] / FIXED / total).astype(np.float32)


def _fit_codes(codes: DataFrame, vocab: dict, shared, rounds: int) -> dict:
    coder = Coder(vocab)
    flat = Network(coder.n_inputs, class_share=vocab["class_share"]).flat
    sharded = in_shards(codes, coder.dtype.itemsize)
    for k in range(rounds):
        flat = _round(sharded, shared, flat, k, rounds)
    return {"vocab": vocab, "flat": flat}


def _score_codes(codes: DataFrame, model: dict) -> DataFrame:
    shared = codes.sparkSession.sparkContext.broadcast(model)

    def make():
        coder = Coder(shared.value["vocab"])
        net = Network(coder.n_inputs, shared.value["flat"])

        def step(b):
            docs = Batch(b.column("codes"), coder)
            lp = [(net.log_prob(x, coder.cls[y]) + coder.share[y]).astype(np.float64) for x, y in docs.windows(np.arange(len(docs.at)))]
            total = np.cumsum(np.concatenate([np.zeros(1), *lp]))
            n = docs.lengths
            sums = (total[docs.ends] - total[docs.ends - n]).round(3)
            return {"doc_id": b.column("doc_id"), "n_tokens": n, "log_prob": sums, "mean_log_prob": (sums / np.maximum(n, 1)).round(6)}
        return step

    return map_rows(codes, make, "doc_id long, n_tokens long, log_prob double, mean_log_prob double")


def fit(docs: DataFrame, rounds: int = ROUNDS) -> dict:
    """Vocabulary and weights."""
    ship(docs.sparkSession)
    vocab = vocabulary(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    codes = materialize(encode(docs, shared), "lm-codes")
    model = _fit_codes(codes, vocab, shared, rounds)
    drop_materialized(codes)
    return model


def score_documents(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) of every document."""
    ship(docs.sparkSession)
    return _score_codes(encode(docs, docs.sparkSession.sparkContext.broadcast(model["vocab"]), id_col, text_col), model)


def fit_and_score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``score_documents`` by the network fitted on the same documents, whose codes are written once."""
    ship(docs.sparkSession)
    vocab = vocabulary(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    codes = materialize(encode(docs, shared), "lm-codes")
    scores = materialize(_score_codes(codes, _fit_codes(codes, vocab, shared, rounds)), "lm-scores")
    drop_materialized(codes)
    return scores
