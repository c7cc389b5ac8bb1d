"""A small gated recurrent language model in numpy: lanes of documents, truncated backpropagation, and a
softmax over classes of words, then over the words of the class.

Symbol 0 ends a document and stands before its first word; the last symbol is any word outside the
model's list. Lists of symbols become lanes, one document after another; the state starts at zero with
each document and is carried from window to window, so that a document of any length is read whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_F = np.float32


@dataclass(frozen=True)
class Shape:
    """Sizes of a model: listed symbols, bounds of their classes, and units of its state."""

    listed: int
    cuts: tuple[int, ...]
    hidden: int

    @property
    def classes(self) -> int:
        return len(self.cuts) - 1

    def sizes(self) -> dict[str, tuple[int, ...]]:
        h, c = self.hidden, self.classes + 1
        return {"inputs": (self.listed + 1, 3 * h), "recur": (h, 3 * h), "class_out": (h, c), "class_bias": (c,), "word_out": (self.listed, h), "word_bias": (self.listed,)}

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, size in self.sizes().items():
            n = int(np.prod(size))
            out[name] = flat[at : at + n].reshape(size)
            at += n
        return out

    def count(self) -> int:
        return sum(int(np.prod(s)) for s in self.sizes().values())


@lru_cache
def class_of(shape: Shape) -> np.ndarray:
    """The class of every symbol; words outside the list have one of their own."""
    return np.append(np.repeat(np.arange(shape.classes), np.diff(shape.cuts)), shape.classes)


def class_cuts(counts: np.ndarray, classes: int) -> tuple[int, ...]:
    """Bounds of classes of about equal total count, over symbols by falling count."""
    share = np.cumsum(counts) / max(counts.sum(), 1)
    cuts = np.searchsorted(share, np.arange(1, classes) / classes) + 1
    return tuple(np.unique(np.concatenate([[0], np.minimum(cuts, len(counts)), [len(counts)]])).tolist())


def start(shape: Shape, counts: np.ndarray, unlisted: float, seed: int = 1) -> np.ndarray:
    """Small random weights; the biases are the words' shares, so that the model begins with these."""
    draw = np.random.default_rng(seed)
    flat = (draw.normal(size=shape.count()) * 0.1).astype(_F)
    parts = shape.views(flat)
    weight = counts + 0.5
    parts["word_bias"][:] = np.log(weight)
    of_class = np.add.reduceat(weight, shape.cuts[:-1])
    parts["class_bias"][:] = np.log(np.append(of_class, unlisted + 0.5))
    for c in range(shape.classes):
        parts["word_bias"][shape.cuts[c] : shape.cuts[c + 1]] -= np.log(of_class[c])
    parts["class_bias"][:] -= np.log(of_class.sum() + unlisted + 0.5)
    return flat


def lanes(docs: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all documents in ``width`` columns, which documents they are from (-1: none), and
    how many columns reach each row: the longest column comes first."""
    lengths = np.array([len(d) for d in docs], np.int64)
    filled: list[tuple[int, int]] = [(0, b) for b in range(width)]
    column: list[list[int]] = [[] for _ in range(width)]
    for i in np.argsort(-lengths, kind="stable").tolist():
        n, b = heapq.heappop(filled)
        column[b].append(i)
        heapq.heappush(filled, (n + int(lengths[i]), b))
    total = np.zeros(width, np.int64)
    for n, b in filled:
        total[b] = n
    order = np.argsort(-total, kind="stable")
    rows = int(total.max(initial=0))
    symbol, owner = np.zeros((rows, width), np.int32), np.full((rows, width), -1, np.int32)
    for k, b in enumerate(order.tolist()):
        at = 0
        for i in column[b]:
            symbol[at : at + len(docs[i]), k] = docs[i]
            owner[at : at + len(docs[i]), k] = i
            at += len(docs[i])
    return symbol, owner, np.searchsorted(-total[order], -np.arange(rows), "left")


def windows(docs: list[np.ndarray], width: int, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``previous symbols, symbols, whether the state goes on, owners`` of each window."""
    symbol, owner, reach = lanes(docs, width)
    for at in range(0, len(symbol), length):
        b = int(reach[at])
        y, who = symbol[at : at + length, :b], owner[at : at + length, :b]
        before = np.zeros_like(who) - 2
        x = np.zeros_like(y)
        x[1:], before[1:] = y[:-1], who[:-1]
        if at:
            x[0], before[0] = symbol[at - 1, :b], owner[at - 1, :b]
        goes_on = before == who
        yield np.where(goes_on, x, 0), y, goes_on.astype(_F), who


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def forward(p: dict[str, np.ndarray], x: np.ndarray, goes_on: np.ndarray, state: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """The states of a window after each symbol; with ``keep`` also what the way back needs."""
    h, steps, kept = p["recur"].shape[0], np.empty((*x.shape, p["recur"].shape[0]), _F), []
    gates = p["inputs"][x]
    for t in range(len(x)):
        state = state * goes_on[t][:, None]
        u = state @ p["recur"]
        a = gates[t]
        rz = _sigmoid(a[:, : 2 * h] + u[:, : 2 * h])
        r, z = rz[:, :h], rz[:, h:]
        n = np.tanh(a[:, 2 * h :] + r * u[:, 2 * h :])
        if keep:
            kept.append((state, rz, n, u[:, 2 * h :]))
        state = n + z * (state - n)
        steps[t] = state
    return steps, kept


def backward(p: dict[str, np.ndarray], goes_on: np.ndarray, kept: list, dsteps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gradients of each symbol's gate inputs, and of the recurrent weights."""
    h, rows = p["recur"].shape[0], len(kept)
    da = np.empty((rows, dsteps.shape[1], 3 * h), _F)
    drecur = np.zeros_like(p["recur"])
    back = np.zeros(dsteps.shape[1:], _F)
    for t in range(rows - 1, -1, -1):
        state, rz, n, un = kept[t]
        r, z = rz[:, :h], rz[:, h:]
        d = dsteps[t] + back
        dn = d * (1 - z) * (1 - n * n)
        da[t, :, 2 * h :] = dn
        da[t, :, :h] = dn * un
        da[t, :, h : 2 * h] = d * (state - n)
        da[t, :, : 2 * h] *= rz * (1 - rz)
        du = da[t].copy()
        du[:, 2 * h :] *= r
        drecur += state.T @ du
        back = (d * z + du @ p["recur"].T) * goes_on[t][:, None]
    return da, drecur


def _softmax(logits: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The logarithms of the ``own`` columns' probabilities, and all probabilities."""
    rows = np.arange(len(own))
    logits -= logits.max(axis=1, keepdims=True)
    chosen = logits[rows, own]
    e = np.exp(logits, out=logits)
    total = e.sum(axis=1, keepdims=True)
    chosen -= np.log(total[:, 0])
    e /= total
    return chosen, e


def _towards(e: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The gradient of the logarithm by the softmax's inputs, in place of the probabilities."""
    np.negative(e, out=e)
    e[np.arange(len(own)), own] += 1
    return e


def outputs(p: dict[str, np.ndarray], shape: Shape, states: np.ndarray, y: np.ndarray, gradient: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """The natural logarithm of each symbol's probability; with ``gradient`` also those of the weights
    (added to it) and of the states, for the sum of all."""
    cls = class_of(shape)[y]
    logs, e = _softmax(states @ p["class_out"] + p["class_bias"], cls)
    out = logs.astype(np.float64)
    dstates = None
    if gradient is not None:
        d = _towards(e, cls)
        gradient["class_out"] += states.T @ d
        gradient["class_bias"] += d.sum(axis=0)
        dstates = d @ p["class_out"].T
    order = np.argsort(cls, kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(shape.classes + 1))
    for c in range(shape.classes):
        first, last = shape.cuts[c], shape.cuts[c + 1]
        some = order[bounds[c] : bounds[c + 1]]
        # The one word of a class is certain.
        if last - first < 2 or not len(some):
            continue
        seen, word = states[some], y[some] - first
        logs, e = _softmax(seen @ p["word_out"][first:last].T + p["word_bias"][first:last], word)
        out[some] += logs
        if gradient is not None:
            d = _towards(e, word)
            gradient["word_out"][first:last] += d.T @ seen
            gradient["word_bias"][first:last] += d.sum(axis=0)
            dstates[some] += d @ p["word_out"][first:last]
    return out, dstates


def train(shape: Shape, flat: np.ndarray, squares: np.ndarray, docs: list[np.ndarray], width: int, length: int, rate: float) -> float:
    """One pass over the documents, changing ``flat`` and its sums of squared gradients in place:
    backpropagation goes back to the beginning of the window, each step is scaled by what its weight
    has seen (Adagrad). The sum of the logarithms on the way."""
    p, s = shape.views(flat), shape.views(squares)
    state, total = np.zeros((width, shape.hidden), _F), 0.0
    for x, y, goes_on, who in windows(docs, width, length):
        steps, kept = forward(p, x, goes_on, state[: x.shape[1]], keep=True)
        state = steps[-1]
        real = np.flatnonzero(who.ravel() >= 0)
        g = {name: np.zeros_like(v) for name, v in p.items() if name != "inputs"}
        flat_states = steps.reshape(-1, shape.hidden)
        logs, dreal = outputs(p, shape, flat_states[real], y.ravel()[real], g)
        total += float(logs.sum())
        dsteps = np.zeros_like(flat_states)
        dsteps[real] = dreal
        da, g["recur"] = backward(p, goes_on, kept, dsteps.reshape(steps.shape))
        scale = _F(1.0 / len(real))
        for name, d in g.items():
            d *= scale
            s[name] += d * d
            p[name] += rate * d / np.sqrt(s[name])
        # Of the inputs only the symbols of the window change.
        order = np.argsort(x.ravel(), kind="stable")
        ids = x.ravel()[order]
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        d = np.add.reduceat(da.reshape(-1, da.shape[2])[order], first, axis=0) * scale
        ids = ids[first]
        s["inputs"][ids] += d * d
        p["inputs"][ids] += rate * d / np.sqrt(s["inputs"][ids])
    return total


def log_likelihoods(shape: Shape, flat: np.ndarray, docs: list[np.ndarray], width: int, length: int) -> np.ndarray:
    """The natural logarithm of each whole document's probability, words outside the list as one symbol."""
    p, out = shape.views(flat), np.zeros(len(docs))
    state = np.zeros((width, shape.hidden), _F)
    for x, y, goes_on, who in windows(docs, width, length):
        steps, _ = forward(p, x, goes_on, state[: x.shape[1]], keep=False)
        state = steps[-1]
        owner = who.ravel()
        real = np.flatnonzero(owner >= 0)
        logs, _ = outputs(p, shape, steps.reshape(-1, shape.hidden)[real], y.ravel()[real])
        out += np.bincount(owner[real], logs, len(docs))
    return out
