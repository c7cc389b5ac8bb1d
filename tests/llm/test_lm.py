import math
from collections import Counter
from zlib import crc32

import brute
import numpy as np
import pytest

from freshet.llm import gru, lm
from freshet.llm.catalog import QUERIES


def base(rows):
    """(held out, tokens, known, training tokens, score) of each row by plain counting."""
    held = [crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in rows]
    tokens = [[*brute.words(t), None] for _, t in rows]
    counts = Counter(w for h, t in zip(held, tokens, strict=True) if not h for w in t)
    n, v = counts.total(), len(counts)
    for h, t in zip(held, tokens, strict=True):
        yield h, len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)


def check(got, rows):
    assert len(got) == len(rows)
    want = {}
    for (i, t), w in zip(rows, base(rows), strict=True):
        want.setdefault(i, []).append((*w[:4], round(w[4], 6)))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
    assert {i: sorted(x) for i, x in have.items()} == {i: sorted(x) for i, x in want.items()}
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


@pytest.mark.parametrize("frequent", [1 << 19, 100, 0])
def test_whole_table(spark, texts, monkeypatch, frequent):
    """Counts whatever part of the words comes by shuffle, and held-out texts likelier than by counts alone."""
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    got = QUERIES["op12_lm_scoring"](spark, "/root/testdata/sf0.001").collect()
    check(got, list(texts.items()))
    if frequent > 1000:
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "a b c " * 50), (1, "a b c " * 50), (1, "other"), (None, "a x"), (None, None), (2, ""), (3, " \n"), (4, "A B\tc é " * 9000), (6, "unseen words of a held-out text"), (9, "held out too")]
    df = spark.createDataFrame([(i, t, "x", 1, True) for i, t in rows], "doc_id long, text string, word string, id int, held boolean").repartition(3)
    got = lm.score(df).collect()
    check(got, rows)
    assert len({(r.base_score, round(r.score, 3)) for r in got if r.doc_id == 1}) == 2


def test_nothing_to_learn_from(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    held = next(i for i in range(99) if crc32(str(i).encode()) % 5 == 1)
    got = lm.score(spark.createDataFrame([(held, "some words")], "doc_id long, text string")).collect()
    check(got, [(held, "some words")])


def model(listed=12, hidden=5, seed=0):
    draw = np.random.default_rng(seed)
    counts = np.sort(draw.integers(1, 90, listed))[::-1].astype(float)
    shape = gru.Shape(listed, gru.class_cuts(counts, 4), hidden)
    flat = gru.start(shape, counts, 7.0, seed) + draw.normal(size=shape.count()).astype(np.float32) * 0.3
    docs = [np.append(draw.integers(1, listed + 1, n), 0) for n in (0, 1, 40, 3, 17, 200, 5)]
    return shape, flat, docs


def plain(shape, flat, doc):
    """One document, one symbol at a time, in double precision."""
    p = {k: v.astype(float) for k, v in shape.views(flat).items()}
    h, before, total, n = np.zeros(shape.hidden), 0, 0.0, shape.hidden
    cls = gru.class_of(shape)
    for y in doc:
        a, u = p["inputs"][before], h @ p["recur"]
        r, z = (1 / (1 + np.exp(-(a + u)[i * n : (i + 1) * n])) for i in (0, 1))
        new = np.tanh(a[2 * n :] + r * u[2 * n :])
        h = (1 - z) * new + z * h
        logits = h @ p["class_out"] + p["class_bias"]
        total += logits[cls[y]] - np.log(np.exp(logits).sum())
        if y < shape.listed:
            some = slice(shape.cuts[cls[y]], shape.cuts[cls[y] + 1])
            logits = p["word_out"][some] @ h + p["word_bias"][some]
            total += logits[y - some.start] - np.log(np.exp(logits).sum())
        before = y
    return total


@pytest.mark.parametrize(("lanes", "window"), [(1, 1), (3, 7), (64, 16)])
def test_state_is_carried_through_whole_documents(lanes, window):
    shape, flat, docs = model()
    got = gru.log_likelihoods(shape, flat, docs, lanes, window)
    assert got == pytest.approx([plain(shape, flat, d) for d in docs], rel=1e-4)


def test_probabilities_add_up():
    shape, flat, _ = model()
    one = [np.array([y]) for y in range(shape.listed + 1)]
    assert np.exp(gru.log_likelihoods(shape, flat, one, 4, 4)).sum() == pytest.approx(1, rel=1e-5)


def test_gradients():
    """Backpropagation through a whole window against differences."""
    shape, flat, docs = model(seed=3)
    docs = [d[:12] for d in docs]
    x, y, goes_on, who = next(gru.windows(docs, 4, 100))
    real = np.flatnonzero(who.ravel() >= 0)

    def loss(weights):
        p = {k: v.astype(np.float64) for k, v in shape.views(weights).items()}
        steps, _ = gru.forward(p, x, goes_on, np.zeros((x.shape[1], shape.hidden)), keep=False)
        return gru.outputs(p, shape, steps.reshape(-1, shape.hidden)[real], y.ravel()[real])[0].sum()

    p = shape.views(flat)
    steps, kept = gru.forward(p, x, goes_on, np.zeros((x.shape[1], shape.hidden), np.float32), keep=True)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    _, d = gru.outputs(p, shape, steps.reshape(-1, shape.hidden)[real], y.ravel()[real], g)
    dsteps = np.zeros((steps.size // shape.hidden, shape.hidden), np.float32)
    dsteps[real] = d
    da, g["recur"] = gru.backward(p, goes_on, kept, dsteps.reshape(steps.shape))
    np.add.at(g["inputs"], x, da)
    whole = np.concatenate([g[k].ravel() for k in shape.sizes()])
    for i in np.random.default_rng(1).choice(len(flat), 60, replace=False):
        up, down = (flat.astype(np.float64) for _ in range(2))
        up[i] += 1e-3
        down[i] -= 1e-3
        assert whole[i] == pytest.approx((loss(up) - loss(down)) / 2e-3, abs=2e-2, rel=2e-2)
