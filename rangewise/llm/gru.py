"""A small gated recurrent language model in numpy.

Vocabulary: frequent words, a square number of them, dealt by rank to as many
classes as a class has words, and one more class for every other word. The
parameters' shapes carry the vocabulary's size. P(word) is P(class | state) * P(word | class,
state), both softmaxes; a word of the last class has its share of that class
from corpus counts, which the caller adds. Texts run back to back in lanes;
the state starts at zero with each text and is carried from window to window.
Training is truncated backpropagation through one window, with Adam.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np

#: Units of the state, steps in a window, least words of the vocabulary.
UNITS, STEPS, WORDS = 16, 16, 256
#: Steps in a window where nothing is learned.
SCORE_STEPS = 64
#: Texts run side by side.
LANES = 1024
#: Most steps in a window where few lanes run; rows of scores held at once.
LONGEST, CACHED = 1024, 512
#: Words in a window that is learned, if its lanes have as many.
LEARNED = 1 << 10
RATE, DECAY1, DECAY2 = 0.01, 0.9, 0.98
#: Parameters that one step of Adam takes at once.
BLOCK, ALL = 1 << 14, slice(None)
#: The word before a text's first: the last row of ``embed``. "Any other
#: word" has the id that follows the vocabulary's.
START = -1

Params = dict[str, np.ndarray]


def grid(words: int) -> int:
    """Classes of a vocabulary of at least ``words`` words, and words a class."""
    return max(math.isqrt(max(words, WORDS) - 1) + 1, 1)


def _shapes(size: int) -> dict[str, tuple[int, ...]]:
    return {"embed": (size * size + 2, 3 * UNITS), "state": (UNITS, 3 * UNITS),
            "class_w": (UNITS, size + 1), "class_b": (size + 1,),
            "word_w": (size, UNITS, size), "word_b": (size, size)}


def initial(counts: np.ndarray, rest: float) -> Params:
    """Parameters that give corpus frequencies whatever the state. ``counts``:
    of the vocabulary's words, in order; ``rest``: of all others."""
    rng = np.random.default_rng(7)
    size = grid(len(counts))
    p = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in _shapes(size).items()}
    by_class = (counts.astype(float) + 1).reshape(size, size)
    total = np.append(by_class.sum(axis=1), rest + 1)
    p["class_b"] = np.log(total / total.sum()).astype(np.float32)
    p["word_b"] = np.log(by_class / by_class.sum(axis=1, keepdims=True)).astype(np.float32)
    p["class_w"] *= 0
    p["word_w"] *= 0
    return p


def flat(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in _shapes(len(p["word_b"]))])


def unflat(x: np.ndarray, size: int) -> Params:
    out, at = {}, 0
    for k, s in _shapes(size).items():
        n = int(np.prod(s))
        out[k] = x[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


@dataclass
class Lanes:
    """Texts dealt to lanes, longest first to the shortest lane; lanes are in
    order of falling length, so those still running are a prefix."""

    target: np.ndarray
    given: np.ndarray  # the word before, or START
    text: np.ndarray
    start: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, offsets: np.ndarray, lanes: int = LANES) -> Lanes:
        sizes = np.diff(offsets)
        heap = [(0, k) for k in range(min(lanes, max(len(sizes), 1)))]
        dealt: list[list[int]] = [[] for _ in heap]
        for d in np.argsort(-sizes, kind="stable").tolist():
            load, k = heapq.heappop(heap)
            dealt[k].append(d)
            heapq.heappush(heap, (load + int(sizes[d]), k))
        loads = np.zeros(len(dealt), np.int64)
        for load, k in heap:
            loads[k] = load
        order = np.argsort(-loads, kind="stable")
        text_order = np.array([d for k in order.tolist() for d in dealt[k]], np.int64)
        n = sizes[text_order]
        at = np.cumsum(n) - n
        place = np.arange(int(n.sum())) + np.repeat(offsets[text_order] - at, n)
        target = ids[place]
        given = np.concatenate([np.array([START], target.dtype), target[:-1]])
        given[at[n > 0]] = START
        length = loads[order]
        return cls(target, given, np.repeat(text_order.astype(np.int32), n), np.cumsum(length) - length, length)

    def windows(self, steps: int = STEPS, least: int = LEARNED):
        """(places, whether there is a word) of each window, both (steps,
        lanes still running). Where few lanes run, windows are longer, so that
        they hold about ``least`` words."""
        t, end = 0, int(self.length.max(initial=0))
        while t < end:
            running = int(np.searchsorted(-self.length, -t, side="left"))
            n = min(max(steps, min(least // running, LONGEST)), end - t)
            at = t + np.arange(n)[:, None]
            valid = at < self.length[:running]
            yield self.start[:running] + np.minimum(at, self.length[:running] - 1), valid
            t += n


def _order(ids: np.ndarray, end: int) -> np.ndarray:
    """The order of ``ids``, all from 0 to under ``end``; narrow numbers are
    put in order by their digits."""
    return np.argsort(ids.astype(np.uint16) if end <= 1 << 16 else ids, kind="stable")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _run(p: Params, given: np.ndarray, h: np.ndarray, keep: list | None) -> np.ndarray:
    """States after each step of a window, and what backpropagation needs.
    A step's numbers lie unit by unit, so that gates are whole blocks."""
    steps, lanes = given.shape
    out = np.empty((steps, lanes, UNITS), p["embed"].dtype)
    fresh = given == START
    some = fresh.any(axis=1)
    state = np.ascontiguousarray(p["state"].T)
    h = np.ascontiguousarray(h.T, p["embed"].dtype)
    for t in range(steps):
        if some[t]:
            h = np.where(fresh[t], h.dtype.type(0), h)
        a, s = np.ascontiguousarray(p["embed"][given[t]].T), state @ h
        a[:2 * UNITS] += s[:2 * UNITS]
        gates, n, s = _sigmoid(a[:2 * UNITS]), a[2 * UNITS:], s[2 * UNITS:]
        r, z = gates[:UNITS], gates[UNITS:]
        n += r * s
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((h, r, z, n, s, fresh[t] if some[t] else None))
        h = h - n
        h *= z
        h += n
        out[t] = h.T
    return out


def _shifted(w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights with the bias as last row, lowered so that no state (its values
    lie between -1 and 1) gives a score above zero; and whether, whatever the
    state, some score stays far from vanishing as an exponential. Both by softmax."""
    reach = np.abs(w).sum(axis=-2)
    top = (b + reach).max(axis=-1, keepdims=True)
    return (np.concatenate([w, (b - top)[..., None, :]], axis=-2),
            top[..., 0] - (b - reach).max(axis=-1) < 60)


def _exponentials(h: np.ndarray, w: np.ndarray, close: bool, target: np.ndarray | None,
                  room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Exponentials of each row's scores, their sums, and with ``target`` the
    log probability of each row's target. ``h`` has ones as last column."""
    x = np.matmul(h, w, out=room[:h.shape[0] * w.shape[1]].reshape(len(h), -1))
    if not close:
        x -= x.max(axis=1, keepdims=True)
    chosen = None if target is None else x[np.arange(len(x)), target]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    return x, total, None if target is None else chosen - np.log(total)


def _learned(h: np.ndarray, w: np.ndarray, close: bool, target: np.ndarray, weight: np.ndarray,
             room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of weights and bias, and of the states. Rows are divided by
    their sums where they are as narrow as a state."""
    x, total, _ = _exponentials(h, w, close, None, room)
    x[np.arange(len(x)), target] -= total
    scale = (weight / total)[:, None]
    back = x @ w[:-1].T
    back *= scale
    return (x.T @ (h * scale)).T, back


def _predict(p: Params, h: np.ndarray, target: np.ndarray, grad: Params | None,
             weight: np.ndarray | None = None) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Log probabilities of the targets from states (n, units); with ``grad``
    instead adds the gradients and returns that of the states. Rows are taken
    by target, so many at once that their scores stay in the processor's cache."""
    size, n = len(p["word_b"]), len(h)
    order = _order(target, size * size + 1)
    target = target[order]
    edge = np.searchsorted(target, np.arange(size + 1) * size)
    cls = np.repeat(np.arange(size + 1), np.diff(edge, append=n))  # of any other word: the last
    rows = np.empty((n, UNITS + 1), h.dtype)
    rows[:, :UNITS], rows[:, UNITS] = h[order], 1
    room = np.empty(CACHED * (size + 1), np.result_type(h, p["word_w"]))
    w, close = _shifted(p["class_w"], p["class_b"])
    if grad is None:
        logs = np.empty(n)
    else:
        weight, back = weight[order], np.empty_like(rows[:, :UNITS])
    for a in range(0, n, CACHED):
        k = slice(a, a + CACHED)
        if grad is None:
            logs[k] = _exponentials(rows[k], w, close, cls[k], room)[2]
            continue
        g, back[k] = _learned(rows[k], w, close, cls[k], weight[k], room)
        grad["class_w"] += g[:-1]
        grad["class_b"] += g[-1]
    words, near = _shifted(p["word_w"], p["word_b"])
    for c in np.flatnonzero(np.diff(edge)).tolist():
        w, close = words[c], near[c]
        for a in range(edge[c], edge[c + 1], CACHED):
            k = slice(a, min(a + CACHED, edge[c + 1]))
            word = target[k] - c * size
            if grad is None:
                logs[k] += _exponentials(rows[k], w, close, word, room)[2]
                continue
            g, d = _learned(rows[k], w, close, word, weight[k], room)
            grad["word_w"][c] += g[:-1]
            grad["word_b"][c] += g[-1]
            back[k] += d
    if grad is None:
        out = np.empty(n)
        out[order] = logs
        return out, None
    out = np.empty_like(back)
    out[order] = back
    return None, out


def _backward(p: Params, given: np.ndarray, kept: list, back: np.ndarray, grad: Params) -> None:
    """Backpropagation through one window."""
    steps, lanes = given.shape
    d_in = np.empty((steps, lanes, 3 * UNITS), back.dtype)
    carry = np.zeros((UNITS, lanes), back.dtype)
    d_step = np.empty((3 * UNITS, lanes), back.dtype)
    dr, dz, dn = d_step[:UNITS], d_step[UNITS:2 * UNITS], d_step[2 * UNITS:]
    for t in range(steps - 1, -1, -1):
        h, r, z, n, s, fresh = kept[t]
        carry += back[t].T
        rest = 1 - z
        np.multiply(carry, rest, out=dn)
        np.subtract(h, n, out=dz)
        dz *= z
        dz *= dn
        dn *= 1 - n * n
        np.multiply(dn, s, out=dr)
        dr *= r
        dr *= 1 - r
        d_in[t] = d_step.T
        dn *= r
        grad["state"] += h @ d_step.T
        carry *= z
        carry += p["state"] @ d_step
        if fresh is not None:
            carry[:, fresh] = 0
    word = given.ravel() + 1
    order = _order(word, len(p["embed"]))
    word = word[order]
    edge = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    grad["embed"][word[edge] - 1] += np.add.reduceat(d_in.reshape(-1, 3 * UNITS)[order], edge, axis=0)


class Trainer:
    """Truncated backpropagation with Adam, one step a window. Words and
    classes that a window does not have keep their parameters and moments."""

    def __init__(self, params: Params):
        self.p = {k: v.copy() for k, v in params.items()}
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}
        self.n = self.tokens = 0

    def learn(self, lanes: Lanes) -> None:
        h = np.zeros((len(lanes.length), UNITS), np.float32)
        size = len(self.p["word_b"])
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        for at, valid in lanes.windows():
            given, target, kept = lanes.given[at], lanes.target[at], []
            states = _run(self.p, given, h[:at.shape[1]], kept)
            h = states[-1]
            use, back = valid.ravel(), np.zeros((valid.size, UNITS), np.float32)
            n = int(use.sum())
            back[use] = _predict(self.p, states.reshape(-1, UNITS)[use], target.ravel()[use], grad,
                                 np.full(n, 1 / n, np.float32))[1]
            _backward(self.p, given, kept, back.reshape(states.shape), grad)
            classes = np.flatnonzero(np.bincount(target.ravel() // size, minlength=size)[:size])
            words = np.flatnonzero(np.bincount(given.ravel() + 1, minlength=size * size + 2))
            rows = {"embed": words - 1, "word_w": classes, "word_b": classes}
            self._step(grad, rows)
            self.tokens += n

    def _step(self, grad: Params, rows: dict[str, np.ndarray]) -> None:
        """One step with the gradients' ``rows`` (all, if not given), which
        are zero afterwards."""
        self.n += 1
        at = {k: rows[k] if k in rows and len(rows[k]) < len(g) else ALL for k, g in grad.items()}
        some = {k: g[at[k]].reshape(-1) for k, g in grad.items()}
        norm = float(np.sqrt(sum(float(g @ g) for g in some.values())))
        clip = np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
        for k, g in some.items():
            m, v = (x[k][at[k]].reshape(-1) for x in (self.m, self.v))
            for a in range(0, len(g), BLOCK):
                self._moments(g[a:a + BLOCK], m[a:a + BLOCK], v[a:a + BLOCK], clip)
            shape = (-1, *grad[k].shape[1:])
            if at[k] is not ALL:
                self.m[k][at[k]], self.v[k][at[k]] = m.reshape(shape), v.reshape(shape)
            self.p[k][at[k]] -= g.reshape(shape)
            grad[k][at[k]] = 0

    def _moments(self, g: np.ndarray, m: np.ndarray, v: np.ndarray, clip: np.float32) -> None:
        """Moments with the gradient ``g``, which becomes the step."""
        g *= clip
        m *= np.float32(DECAY1)
        m += np.float32(1 - DECAY1) * g
        g *= g
        g *= np.float32(1 - DECAY2)
        v *= np.float32(DECAY2)
        v += g
        np.multiply(v, np.float32(1 / (1 - DECAY2 ** self.n)), out=g)
        np.sqrt(g, out=g)
        g += np.float32(1e-6)
        np.divide(m, g, out=g)
        g *= np.float32(RATE / (1 - DECAY1 ** self.n))


def log_likelihood(p: Params, lanes: Lanes, texts: int) -> np.ndarray:
    """Natural log probability of each whole text."""
    out = np.zeros(texts)
    h = np.zeros((len(lanes.length), UNITS), np.float32)
    for at, valid in lanes.windows(SCORE_STEPS, SCORE_STEPS * LANES):
        states = _run(p, lanes.given[at], h[:at.shape[1]], None)
        h = states[-1]
        use = valid.ravel()
        place = at.ravel()[use]
        logs, _ = _predict(p, states.reshape(-1, UNITS)[use], lanes.target[place], None)
        out += np.bincount(lanes.text[place], logs, minlength=texts)
    return out
