"""Trained operators: gradients, exact counts, and held-out results."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ODD, fixture_texts

from barsmith.llm import attention, lm, toxicity


def test_gradient():
    shape = attention.Shape(rows=7, classes=5, width=4, hidden=6, context=5, overlap=2)
    rng = np.random.default_rng(0)
    flat = shape.start(np.zeros(5)).astype(np.float64) + rng.normal(0, 0.1, shape.size)
    rows, target = rng.integers(0, 7, (3, 5)), rng.integers(-1, 5, (3, 5))
    _, grad = attention.gradient(shape, flat, rows, target)
    at = lambda w: attention.gradient(shape, w, rows, target)[0]
    plain = [(at(flat + e) - at(flat - e)) / 2e-6 for e in 1e-6 * np.eye(shape.size)]
    assert np.abs(grad - plain).max() < 1e-6


def test_attention_sees_nothing_ahead():
    shape = attention.Shape(rows=9, classes=4)
    w = shape.split(shape.start(np.zeros(4)))
    rows = np.random.default_rng(1).integers(0, 9, (2, 16))
    other = rows.copy()
    other[:, 10:] = 0
    a, b = (attention.forward(w, r)["z"].reshape(2, 16, -1) for r in (rows, other))
    assert np.allclose(a[:, :10], b[:, :10]) and not np.allclose(a[:, 10:], b[:, 10:])


def test_windows_score_each_token_once():
    lengths = np.array([1, 2, 15, 16, 17, 29, 30, 200])
    text, index, counted = attention.windows(lengths, 16, 3)
    base = np.cumsum(lengths + 1) - (lengths + 1)
    for t, n in enumerate(lengths):
        mine = np.sort(index[text == t][counted[text == t]] - base[t])
        assert mine.tolist() == list(range(n))


def test_windows_give_half_of_themselves_as_context():
    """No token but the first of a text is scored with less than half a window before it."""
    shape, n = attention.Shape(rows=1, classes=1), 1000
    _, index, counted = attention.windows(np.array([n]), shape.context, shape.overlap)
    seen = np.broadcast_to(np.arange(shape.context), index.shape)
    assert shape.context >= 32 and seen[counted & (index >= shape.context)].min() >= shape.context // 2


def test_scores_are_probabilities():
    """Over all texts of one token and of none, the probabilities of a small model sum to one."""
    rng = np.random.default_rng(2)
    shape, klass = attention.Shape(rows=4, classes=2), np.array([0, 0, 1, 1])
    within = np.log(np.array([[0.3, 0.6], [0.7, 0.4], [0.5, 0.1], [0.5, 0.9]], np.float32))
    model = attention.Model(shape, shape.start(np.zeros(2)), rng.permutation(4), klass, within)
    one = model.scores(np.array([[3, i] for i in range(4)]).reshape(-1), np.ones(4, int))
    assert math.isclose(np.exp(one).sum(), 1, rel_tol=1e-5)
    long = rng.integers(0, 4, 101)
    assert math.isclose(model.scores(long, np.array([100]), 2)[0], model.scores(long, np.array([100]))[0], rel_tol=1e-5)


def test_context_is_seen_and_gets_no_vectors(monkeypatch):
    """A text's later windows give a vector for the places they score only, the same as whole windows do."""
    rng, real, places = np.random.default_rng(4), attention.forward, []
    shape, klass = attention.Shape(rows=9, classes=5), rng.integers(0, 5, 9)
    flat = shape.start(np.zeros(5)) + rng.normal(0, 0.3, shape.size).astype(np.float32)
    model = attention.Model(shape, flat, np.arange(9), klass, np.log(rng.random((9, 5), np.float32)))
    lengths = np.array([1, 320, 32, 33, 2000])
    tokens, w = rng.integers(0, 9, int(lengths.sum()) + lengths.size), shape.split(flat)

    want = np.zeros(lengths.size)
    for t, at, use in zip(*attention.windows(lengths, shape.context, shape.overlap)):
        logits = (real(w, tokens[at][None])["z"] @ w["out"] + w["out_bias"])[use].astype(np.float64)
        here, ahead = tokens[at][use], tokens[at + 1][use]
        picked = logits[np.arange(ahead.size), klass[ahead]] + model.within[ahead, klass[here]]
        want[t] += (picked - np.log(np.exp(logits).sum(axis=1))).sum()

    def counting(*given):
        found = real(*given)
        places.append(len(found["z"]))
        return found

    monkeypatch.setattr(attention, "forward", counting)
    assert np.allclose(model.scores(tokens, lengths, 7), want, rtol=1e-5)
    assert sum(places) <= lengths.sum() + lengths.size * shape.context


def test_language_model(docs):
    texts = ODD + fixture_texts(400)
    ids = [None, *range(1, len(texts))]
    got = {r.doc_id: r for r in lm.scores(docs([(i, t, "s") for i, t in zip(ids, texts)])).collect()}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in ids}
    words = {i: [w.decode() for w in lm.words_of(t)] for i, t in zip(ids, texts)}
    counts = Counter(w for i in ids if not held[i] for w in words[i])
    train = sum(not h for h in held.values())
    total, kinds = counts.total() + train, len(counts) + 1
    assert len(got) == len(texts)
    for i in ids:
        r = got[i]
        c = [counts[w] for w in words[i]] + [train]
        base = sum(math.log10((x + 1) / (total + kinds + 1)) for x in c)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(c), sum(x > 0 for x in c), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert got[3].score > got[5].score  # a letter against 50,000 of them


def test_language_model_without_rare_table(docs, monkeypatch):
    """All counts come from the join if no word is heavy."""
    frame = docs(["a b a", "b c", "d"])
    want = sorted(r[:6] for r in map(tuple, lm.scores(frame).collect()))
    monkeypatch.setattr(lm, "HEAVY", 0)
    got = sorted(r[:6] for r in map(tuple, lm.scores(frame).collect()))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])


def test_language_model_learns_from_whole_texts(docs, monkeypatch):
    """Every pair of neighbours of every training text is counted once, in short and long texts."""
    texts = ["one two", None, "", "b a " * 1500 + "odd", *(f"w{i} x{i} y{i}" for i in range(40))]
    seen = []

    def counting(train, kind, klass, kinds):
        matrix = real(train, kind, klass, kinds)
        seen.append((klass, matrix.copy()))
        return matrix

    real = lm.following
    monkeypatch.setattr(lm, "following", counting)
    lm.scores(docs(texts)).count()
    with open(lm.TOKENIZER, "rb") as f:
        subwords = lm.Subwords(f.read())
    want = [Counter() for _ in seen]
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            ids = [subwords.end, *subwords.apart(lm.words_of(t))[0].tolist(), subwords.end]
            for w, (klass, _) in zip(want, seen):
                w.update((z, klass[a]) for a, z in zip(ids, ids[1:]))
    assert len(seen) == 2
    for w, (_, matrix) in zip(want, seen):
        assert {(z, a): matrix[z, a] for z, a in zip(*np.nonzero(matrix))} == w


def test_language_model_of_no_rows(docs):
    assert lm.scores(docs([])).count() == 0


def test_nonnegative_risk_separates():
    rng = np.random.default_rng(3)
    positive = np.arange(400) < 100
    truth = positive | (rng.random(400) < 0.1)
    present = rng.random((400, 30)) < 0.2
    present[:, 0] = np.where(truth, rng.random(400) < 0.8, False)
    rows, codes = np.nonzero(present)
    w, b = toxicity.nnpu(codes, rows, positive, 30, 0.1, 0.1, toxicity.Params())
    z = present @ w + b
    assert w[0] > 3 * np.abs(w[1:]).max() and z[~truth].mean() < 0


@pytest.fixture
def toxic(docs, spark):
    rng = random.Random(6)
    plain = [f"plain{i}" for i in range(200)]
    rows, labels = [(None, "plain1 vile1", "s"), (9999, None, "s")], [(None, 1, 1), (5, 1, None)]
    for i in range(1500):
        bad = rng.random() < 0.15
        text = rng.choices(plain, k=40) + (rng.choices(["vile1", "Vile2", "vile3"], k=4) if bad else [])
        rows.append((i, " ".join(text), "s"))
        if rng.random() < 0.5:
            labels += [(i, 1, int(bad))] * 2
    return docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rows


def test_toxicity_held_out(toxic):
    frame, labels, rows = toxic
    got = {r.doc_id: r.score for r in toxicity.score(frame, toxicity.fit(frame, labels)).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    wrong = sum((got[i] >= 0.5) != ("vile" in t.lower()) for i, t, _ in rows[2:])
    assert wrong <= 0.02 * len(rows) and got[9999] < 0.5


def test_toxicity_never_learns_held_out_labels(toxic, spark):
    frame, labels, _ = toxic
    kept = toxicity.confirmed(labels).collect()
    assert kept and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in kept)


def test_risk_is_that_of_all_documents():
    """With the confirmed taken out of the unlabelled, the score of a bare classifier is still the prior."""
    rng = np.random.default_rng(5)
    truth = rng.random(200_000) < 0.2
    labelled = rng.random(truth.size) < 0.5
    positive = truth & labelled
    prior, c = truth.mean(), labelled.mean()
    hidden = prior * (1 - c) / (1 - prior * c)
    assert abs(truth[~positive].mean() - hidden) < 0.005
    none = np.zeros(0, int)
    _, bias = toxicity.nnpu(none, none, positive, 0, prior, hidden, toxicity.Params())
    assert abs(1 / (1 + math.exp(-bias)) - prior) < 0.01


def test_toxicity_fits_one_row_of_an_id(toxic, spark, monkeypatch):
    """Half of the rows have one id; groups stay within the parameters."""
    frame, labels, rows = toxic
    many = spark.range(20_000).selectExpr("3L as doc_id", "concat('plain', id % 7) as text", "'s' as source")
    plain_fit = toxicity.fit_group

    def counted(prior, hidden, p):
        inner = plain_fit(prior, hidden, p)

        def fit(group):
            out = inner(group)
            if group.num_rows > p.positives + p.unlabelled:
                raise AssertionError(f"{group.num_rows} rows in a group")
            return out

        return fit

    monkeypatch.setattr(toxicity, "fit_group", counted)
    p = toxicity.Params(positives=100, unlabelled=400)
    assert len(toxicity.fit(frame.unionByName(many), labels, p)) == p.classifiers


def test_toxicity_without_examples(docs, spark):
    frame = docs(["one", "", None])
    none = spark.createDataFrame([(0, 0)], "doc_id bigint, toxic int")
    for labels in (none, none.limit(0)):
        assert {r.score for r in toxicity.score(frame, toxicity.fit(frame, labels)).collect()} == {0.0}
    assert toxicity.score(docs([]), []).count() == 0
