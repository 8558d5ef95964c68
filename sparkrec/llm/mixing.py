"""Mixing documents to target domain weights, with soft membership.

A labelled table (doc_id, domain) trains a classifier over a document's distinct
words and two marks of its shape (how far words repeat, how long they are).
Its posteriors say how far each document belongs to each domain. Document rates
r >= min_rate are then fitted so that the expected domain token totals
sum_i r_i n_i p_id meet the targets: projected gradient descent on the least
squares error, in the metric that weighs a document by its tokens and a domain
by the inverse of the totals' Gram matrix. In it a step of 1 always descends and
the update is r_i <- max(min_rate, r_i - sum_d p_id g_d): an iteration sends one
number for each domain to all documents and brings back one total for each, so
a rate follows from the posteriors and the history of g without being stored.

Everything here is DataFrame functions. Sums are of integers, so results don't
depend on the order of rows or tasks.

Labelled rows: at most ``max_labelled`` (those of least hash) train the
classifier; of its words at most ``max_terms`` (the most frequent) are kept, and
only that table is broadcast. All documents are scored, all count for the totals.

Defined cases: null text is empty; an empty text has no tokens and the prior's
posteriors; a doc_id labelled twice has its least domain name; labels without
domain are left out; repeated rows each count and each get a row; without labels
every document is in the one domain "all", and targets then don't matter. A
target of a domain that no document belongs to can't be met and is left short.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import materialize, texts

MAX_LABELLED = 20_000
MAX_TERMS = 20_000
PRIOR_DOCS = 50.0  # pooled documents added to each class when words are counted
ROW = "\u0001row"
SCALE = 1_000_000


def quality_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): high or low, from the quality label."""
    return labels.where("quality is not null").select("doc_id", F.when(F.col("quality") > 0, "high").otherwise("low").alias("domain"))


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): toxic, or else high or low."""
    return labels.where("quality is not null and toxic is not null").select(
        "doc_id", F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") > 0, "high").otherwise("low").alias("domain"))


def _marked(rows: DataFrame, *more: str) -> DataFrame:
    """(doc_id, h, n_tokens, marks, more) from (doc_id, text, more): a document's distinct words and marks; h tells
    texts of one doc_id apart."""
    text = F.col("text")
    rows = rows.select(*more, "doc_id", F.xxhash64(text).alias("h"), F.length(text).alias("chars"),
                       F.array_remove(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " "), "").alias("tokens"))
    rows = rows.select(*more, "doc_id", "h", "chars", F.size("tokens").cast("long").alias("n_tokens"), F.array_distinct("tokens").alias("own"))
    n = F.greatest(F.col("n_tokens"), F.lit(1))
    shape = F.array(F.lit(ROW), F.concat(F.lit("\u0001new"), F.floor(F.size("own") * 10 / n).cast("string")),
                    F.concat(F.lit("\u0001long"), F.floor(F.least(F.col("chars") / n, F.lit(20))).cast("string")))
    return rows.select(*more, "doc_id", "h", "n_tokens", F.concat("own", shape).alias("marks"))


def _words(marked: DataFrame, *names: str) -> DataFrame:
    """(names, word): a row for each mark. There is one always; a plain ``explode`` would have Spark look for documents without
    by splitting every text once more, ahead of the join with the labels too."""
    return marked.select(*names, F.explode_outer("marks").alias("word"))


def _terms(docs: DataFrame, domains: DataFrame, names: list[str], max_labelled: int, max_terms: int,
           id_col: str, text_col: str) -> DataFrame:
    """(word, w0, w1, ...): by domain, millionths of a word's log-likelihood ratio to the pooled sample."""
    lab = (domains.select(F.col("doc_id").cast("long").alias("doc_id"), "domain").where("doc_id is not null and domain is not null")
           .groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    sample = _marked(texts(docs, id_col, text_col).join(F.broadcast(lab), "doc_id"), "domain")  # broadcast: max_labelled rows
    words = _words(sample, "domain")
    n = [F.sum((F.col("domain") == d).cast("long")).alias(f"n{i}") for i, d in enumerate(names)]
    counts = words.groupBy("word").agg(*n).withColumn("n", sum((F.col(f"n{i}") for i in range(len(names))), F.lit(0)))
    counts = materialize(counts.where("n >= 5").orderBy(F.desc("n"), "word").limit(max_terms), "mix-counts")
    row = counts.where(F.col("word") == ROW).first()
    totals = [row[f"n{i}"] for i in range(len(names))] if row else [0] * len(names)
    total = max(sum(totals), 1)
    weights = []
    for i, k in enumerate(totals):
        pooled = F.col("n") / F.lit(float(total))
        own = (F.col(f"n{i}") + PRIOR_DOCS * pooled) / F.lit(k + PRIOR_DOCS)
        prior = math.log((k + 1) / (total + len(names)))
        w = F.when(F.col("word") == ROW, F.lit(prior)).otherwise(F.log(own / pooled))
        weights.append(F.round(w * SCALE).cast("long").alias(f"w{i}"))
    return counts.select("word", *weights)


def posteriors(docs: DataFrame, domains: DataFrame, max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS,
               id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """(doc_id, h, copies, n_tokens, p0, p1, ...) written as a table, and the domains' names in order."""
    names = [r.domain for r in domains.select("domain").where("domain is not null").distinct().orderBy("domain").limit(65).collect()]
    if len(names) > 64:
        raise ValueError("more than 64 domains")
    marked = _marked(texts(docs, id_col, text_col))
    if not names:
        base = marked.groupBy("doc_id", "h").agg(F.count("*").alias("copies"), F.max("n_tokens").alias("n_tokens"))
        return materialize(base.withColumn("p0", F.lit(1.0)), "mix-posteriors"), ["all"]
    terms = materialize(_terms(docs, domains, names, max_labelled, max_terms, id_col, text_col), "mix-terms")
    hits = _words(marked, "doc_id", "h", "n_tokens").join(
        F.broadcast(terms), "word", "left" if terms.where(F.col("word") == ROW).isEmpty() else "inner")  # max_terms rows
    k = range(len(names))
    sums = hits.groupBy("doc_id", "h").agg(
        F.sum((F.col("word") == ROW).cast("long")).alias("copies"), F.max("n_tokens").alias("n_tokens"),
        *[F.coalesce(F.sum(f"w{i}"), F.lit(0)).alias(f"s{i}") for i in k])
    # tempered by half: the words of a text repeat some of what others of it say
    z = [(F.col(f"s{i}") / F.col("copies") / F.lit(float(SCALE))) for i in k]
    top = F.greatest(*z) if len(names) > 1 else z[0]
    e = [F.exp((x - top) / F.lit(2.0)) for x in z]
    parts = sums.select("doc_id", "h", "copies", "n_tokens", *[x.alias(f"e{i}") for i, x in enumerate(e)])
    total = sum((F.col(f"e{i}") for i in k), F.lit(0.0))
    out = parts.select("doc_id", "h", "copies", "n_tokens", *[F.round(F.col(f"e{i}") / total, 6).alias(f"p{i}") for i in k])
    return materialize(out, "mix-posteriors"), names


def _rate(history: list[list[float]], n_domains: int, min_rate: float, base: float) -> F.Column:
    """A document's rate after the steps so far."""
    r = F.lit(float(max(base, min_rate)))
    for g in history:
        step = sum((F.col(f"p{d}") * F.lit(g[d]) for d in range(n_domains)), F.lit(0.0))
        r = F.greatest(F.lit(float(min_rate)), r - step)
    return r


def _totals(table: DataFrame, by: list[F.Column]) -> list[float]:
    """Sums over the documents, of millionths as whole numbers."""
    tokens = F.col("copies") * F.col("n_tokens")
    row = table.agg(*[F.sum(F.round(tokens * x * SCALE).cast("decimal(28,0)")).alias(f"t{i}") for i, x in enumerate(by)]).first()
    return [float(v or 0) / SCALE for v in row]


def fit_rates(table: DataFrame, names: list[str], weights: dict[str, float], budget: float | None = None,
              min_rate: float = 0.0, base: float = 1.0, max_steps: int = 20, tolerance: float = 1e-4) -> tuple[list[list[float]], dict]:
    """The steps g of the descent, and what they reach: targets, totals, steps.

    budget: tokens after mixing. None: as many as there are or, with min_rate, as
    few as let every domain keep min_rate of its tokens. The descent ends when
    the totals are within ``tolerance`` of the budget, or stand still.
    """
    k = len(names)
    share = np.array([max(weights.get(d, 0.0), 0.0) for d in names])
    share = share / share.sum() if share.sum() else np.full(k, 1 / k)
    sums = _totals(table, [F.col(f"p{i}") for i in range(k)] + [F.col(f"p{i}") * F.col(f"p{j}") for i in range(k) for j in range(k)])
    now, gram = np.array(sums[:k]), np.array(sums[k:]).reshape(k, k)
    if budget is None:
        budget = now.sum()
        if min_rate > 0 and share.min() > 0:
            budget = max(budget * min_rate, float((now * min_rate / share).max()))
    target = share * budget
    metric = np.linalg.pinv(gram + 1e-9 * np.trace(gram) * np.eye(k)) if now.sum() else np.zeros((k, k))
    history: list[list[float]] = []
    total = now * max(base, min_rate)
    for _ in range(max_steps):
        error = total - target
        if np.abs(error).max() <= tolerance * max(budget, 1.0):
            break
        history.append([float(x) for x in metric @ error])
        rate = _rate(history, k, min_rate, base)
        before, total = total, np.array(_totals(table, [F.col(f"p{i}") * rate for i in range(k)]))
        if np.abs(total - before).max() <= tolerance * max(budget, 1.0):
            break  # as near as nonnegative rates get
    return history, {"targets": dict(zip(names, target.tolist(), strict=True)), "totals": dict(zip(names, total.tolist(), strict=True)),
                     "steps": len(history)}


def _planned(docs: DataFrame, domains: DataFrame, weights: dict[str, float], budget: float | None, min_rate: float,
             max_labelled: int) -> tuple[DataFrame, list[str], dict]:
    """(doc_id, h, copies, n_tokens, p0, ..., rate, repeats)."""
    table, names = posteriors(docs, domains, max_labelled)
    history, reached = fit_rates(table, names, weights, budget, min_rate)
    rate = F.round(_rate(history, len(names), min_rate, 1.0), 6)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    out = table.withColumn("rate", rate).withColumn("repeats", F.floor(F.col("rate") + chance).cast("int"))
    return out, names, reached


def rates(docs: DataFrame, domains: DataFrame, weights: dict[str, float], budget: float | None = None, min_rate: float = 0.0,
          max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>, ..., rate, repeats) of every document.

    repeats is the rate as a whole number, rounded up with the chance of its fraction (by a hash of doc_id).
    """
    out, names, _ = _planned(docs, domains, weights, budget, min_rate, max_labelled)
    rows = out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("__copy"))
    return rows.select("doc_id", "n_tokens", *[F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(names)], "rate", "repeats")


def mixed(docs: DataFrame, domains: DataFrame, weights: dict[str, float], budget: float | None = None, min_rate: float = 0.0,
          max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The documents, all columns, each as often as its repeats say (with min_rate 1 each at least once)."""
    plan, _, _ = _planned(docs, domains, weights, budget, min_rate, max_labelled)
    plan = plan.where("repeats > 0").select(F.col("doc_id").alias("__mix_doc"), F.col("h").alias("__mix_h"), F.col("repeats").alias("__mix_n"))
    names = docs.columns
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__mix_doc")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("__mix_h"))
    out = docs.join(plan.hint("shuffle_hash"), same)
    times = F.explode(F.array_repeat(F.lit(0), F.col("__mix_n"))).alias("__mix_copy")
    return out.select(*[docs[c] for c in names], times).drop("__mix_copy")

