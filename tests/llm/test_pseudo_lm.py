"""The network's gradient, the scores against a plain version, and what training learns."""

import math
import random

import numpy as np

from sparkrec.llm import pseudo_lm as P


def grammar(n=200, seed=2):
    r = random.Random(seed)
    return [" ".join(w for _ in range(r.randint(5, 40)) for w in r.choice((("red", "apple", "falls"), ("blue", "stone", "sinks")))) for _ in range(n)]


def test_gradient_points_downhill():
    net, square = P.Network(30), P.Network(30)
    square.flat[:] = 0.01
    r = np.random.default_rng(0)
    x, y = r.integers(0, 30, (256, 2 * P.SIDE)), np.zeros(256, int)
    y[x[:, 1] > 15] = 3  # decided by the token before
    first = net.log_prob(x, y).mean()
    for _ in range(60):
        net.train(x, y, square)
    assert net.log_prob(x, y).mean() > first + 1.0


def test_scores_against_plain(make_docs):
    texts = [*grammar(40), None, "", "...", "Unknown zebra words here", "red " * 20_000]
    docs = make_docs(texts)
    model = P.fit(docs, rounds=1)
    coder, net = P.Coder(model["vocab"]), P.Network(0 + P.Coder(model["vocab"]).n_inputs, model["flat"])
    got = {r.doc_id: r for r in P.score_documents(docs, model).collect()}
    for i, t in enumerate(texts):
        codes = coder.codes(P.words(t or ""))
        line = [0] * P.SIDE + codes + [0] * P.SIDE
        total = 0.0
        for k in range(len(codes)) if len(codes) < 1000 else ():
            x = np.array([[coder.input[line[k + P.SIDE + o]] for o in range(-P.SIDE, P.SIDE + 1) if o]])
            total += float(net.forward(x)[2][0, coder.cls[codes[k]]]) + float(coder.share[codes[k]])
        assert got[i].n_tokens == len(codes)
        if len(codes) < 1000:
            assert math.isclose(got[i].log_prob, total, abs_tol=0.02)
    assert got[41].log_prob == got[41].mean_log_prob == 0


def test_learns_both_sides(make_docs):
    """Order matters: shuffled words of the same documents score worse."""
    texts = grammar()
    r = random.Random(8)
    shuffled = [" ".join(r.sample(t.split(), len(t.split()))) for t in texts[:50]]
    docs = make_docs(texts)
    model = P.fit(docs, rounds=6)
    good = np.mean([x.mean_log_prob for x in P.score_documents(make_docs(texts[:50]), model).collect()])
    bad = np.mean([x.mean_log_prob for x in P.score_documents(make_docs(shuffled), model).collect()])
    assert good > bad + 0.2


def test_every_position_is_trained_once():
    for n in (1, 2, 5, 40):
        for h in (0, 3, 14, 1 << 33):
            assert sorted(at for k in range(P.ROUNDS) for at in P.masked(n, h, k)) == list(range(n))


def test_probabilities_sum_to_one(make_docs):
    docs = make_docs([*grammar(30), "some words that come once only in all of this"])
    vocab = P.vocabulary(docs, size=4)
    counts = {r.word: r.n for r in P.word_counts(docs).collect()}
    coder = P.Coder(vocab)
    mass = {}
    for w in counts:
        i = coder.codes([w])[0]
        mass[coder.cls[i]] = mass.get(coder.cls[i], 0.0) + math.exp(coder.share[i])
    assert all(m <= 1.0 + 1e-3 for m in mass.values())


def test_empty(make_docs):
    docs = make_docs([])
    assert P.score_documents(docs, P.fit(docs, rounds=1)).count() == 0
    some = make_docs([None, ""])
    assert [r.n_tokens for r in P.score_documents(some, P.fit(some, rounds=1)).collect()] == [0, 0]


def test_weights_do_not_depend_on_the_dealing(make_docs, monkeypatch):
    """Several shards, dealt to one task and to eight: the same weights, to the last bit."""
    monkeypatch.setattr(P, "SHARD", 700)
    docs = make_docs([*grammar(120), None, ""])
    one, many = (P.fit(docs.repartition(n)) for n in (1, 8))
    assert np.array_equal(one["flat"], many["flat"])
    a, b = ({r.doc_id: r.log_prob for r in P.score_documents(docs.repartition(n), one).collect()} for n in (1, 8))
    assert all(abs(a[k] - b[k]) < 0.01 for k in a)


def plain_training(texts, vocab, rounds):
    """One shard's training, token by token, in doubles."""
    coder = P.Coder(vocab)
    start = P.Network(coder.n_inputs, class_share=vocab["class_share"])
    w = {n: getattr(start, n).astype(float) for n in P.Network.SHAPES}
    for k in range(rounds):
        square = {n: np.full(v.shape, 0.01) for n, v in w.items()}
        rows = []
        for t in texts:
            codes = coder.codes(P.words(t or ""))
            line = [0] * P.SIDE + codes + [0] * P.SIDE
            rows += [([coder.input[line[i + P.SIDE + o]] for o in (-2, -1, 1, 2)], coder.cls[codes[i]])
                     for i in P.masked(len(codes), len(codes), k, rounds)]
        for a in range(0, len(rows), P.STEP):
            step, grads = rows[a:a + P.STEP], {n: np.zeros_like(v) for n, v in w.items()}
            for x, y in step:
                c = np.concatenate([w["e"][i] for i in x])
                h = np.tanh(c @ w["w1"] + w["b1"][0])
                z = h @ w["w2"] + w["b2"][0]
                g = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
                g[y] -= 1
                back = (w["w2"] @ g) * (1 - h * h)
                grads["w2"] += np.outer(h, g)
                grads["b2"][0] += g
                grads["w1"] += np.outer(c, back)
                grads["b1"][0] += back
                for j, i in enumerate(x):
                    grads["e"][i] += (w["w1"] @ back)[j * P.EMBED:(j + 1) * P.EMBED] * 8
            for n, g in grads.items():
                g /= len(step)
                square[n] += g * g
                w[n] -= P.RATE * g / np.sqrt(square[n] + 1e-6)
    return np.concatenate([w[n].ravel() for n in P.Network.SHAPES])


def test_training_against_plain(make_docs):
    texts = [*grammar(60), None, "", "one unknown word here"]
    docs = make_docs(texts)
    model = P.fit(docs.repartition(5), rounds=2)
    assert np.abs(model["flat"] - plain_training(texts, model["vocab"], 2)).max() < 2e-3


def test_a_document_fed_in_pieces(make_docs):
    """Batches of codes, whatever their cut, train on the same positions in the same steps."""
    coder = P.Coder(P.vocabulary(make_docs(grammar(20)), size=50))
    codes = [coder.packed(P.words(t)) for t in [*grammar(30), "", "red " * 3_000]]
    flat = P.Network(coder.n_inputs).flat
    changes = []
    for size in (1, 7, 40):
        work = P.ShardTraining(flat, coder.n_inputs)
        for a in range(0, len(codes), size):
            batch = P.Batch(P.pa.array(codes[a:a + size], P.pa.binary()), coder)
            for x, y in batch.windows(P.picked(batch, 1, 2)):
                work.add(x, coder.cls[y])
        changes.append(work.change())
    assert np.array_equal(changes[0], changes[1]) and np.array_equal(changes[0], changes[2])


def test_fitted_and_scored_at_once(spark):
    """Repeated rows, null ids and further columns with the operator's own names; every row comes back."""
    rows = [(i, t, "x", 7) for i, t in enumerate(grammar(40))]
    rows += [rows[0]] * 3 + [(None, rows[1][1], None, None), (None, None, None, None), (50, "", "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, codes string, shard int")
    got = P.fit_and_score(docs).collect()
    assert len(got) == len(rows)
    assert len({(r.n_tokens, r.log_prob) for r in got if r.doc_id == 0}) == 1
    assert sorted(r.n_tokens for r in got if r.doc_id is None) == sorted((0, len(P.words(rows[1][1]))))
    model = P.fit(docs)
    apart = sorted(((r.doc_id or -1, r.n_tokens, round(r.log_prob, 1)) for r in P.score_documents(docs, model).collect()))
    assert apart == sorted((r.doc_id or -1, r.n_tokens, round(r.log_prob, 1)) for r in got)
    assert P.fit_and_score(docs.limit(0)).count() == 0
