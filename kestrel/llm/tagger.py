"""A character tagger in numpy: bidirectional LSTM with CRF transitions.

Characters are folded to a small alphabet (case, digits and letters beyond ASCII are
one symbol each). Two LSTMs read a window forwards and backwards; their states give
scores for the labels O, B-kind and I-kind, and a linear chain with learned
transitions joins them. Windows of a batch run in step, so each position is a few
matrix products. A window shorter than ``width`` is filled up with a symbol of its own.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

PAD, SPACE, BREAK, DIGIT, LETTER, MARK, OTHER = 0, 1, 2, 3, 4, 30, 62
SYMBOLS = 63


def _alphabet() -> np.ndarray:
    table = np.full(129, OTHER, np.uint8)
    table[:32], table[127] = BREAK, BREAK
    table[0x20] = SPACE
    table[0x30:0x3A] = DIGIT
    for at in (0x41, 0x61):
        table[at:at + 26] = LETTER + np.arange(26)
    marks = [c for c in range(33, 127) if not chr(c).isalnum()]
    table[marks] = MARK + np.arange(len(marks))
    return table


_TABLE = _alphabet()


def symbols(text: str) -> np.ndarray:
    """The symbol of each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.minimum(points, 128)]


class Model(NamedTuple):
    """Input rows, recurrent weights (both by direction), output weights and bias,
    transitions and first labels."""
    kinds: tuple[str, ...]
    width: int
    u: np.ndarray
    r: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    trans: np.ndarray
    first: np.ndarray


def allowed(n: int) -> np.ndarray:
    """Which label may follow which: I-k only B-k or I-k."""
    out = np.ones((n, n), np.float32)
    for inside in range(2, n, 2):
        out[:, inside] = 0
        out[[inside - 1, inside], inside] = 1
    return out


def _lstm(u: np.ndarray, r: np.ndarray, sym: np.ndarray, keep: bool):
    """(states, and with ``keep`` gates and cells) over sym (steps, 2, windows); both
    directions run in step."""
    steps, _, n = sym.shape
    hidden = r.shape[1]
    flat, at = u.reshape(2 * SYMBOLS, -1), sym + np.array([[0], [SYMBOLS]])
    h, c = np.zeros((2, n, hidden), np.float32), np.zeros((2, n, hidden), np.float32)
    states = np.empty((steps, 2, n, hidden), np.float32)
    gates = np.empty((steps, 2, n, 4 * hidden), np.float32) if keep else None
    cells = np.empty((steps, 2, n, hidden), np.float32) if keep else None
    for t in range(steps):
        z = flat[at[t]] + h @ r
        z[..., :3 * hidden] *= 0.5  # a sigmoid is a tanh of half the size
        np.tanh(z, out=z)
        z[..., :3 * hidden] = 0.5 + 0.5 * z[..., :3 * hidden]
        c = z[..., hidden:2 * hidden] * c + z[..., :hidden] * z[..., 3 * hidden:]
        h = z[..., 2 * hidden:3 * hidden] * np.tanh(c)
        states[t] = h
        if keep:
            gates[t], cells[t] = z, c
    return states, gates, cells


def _lstm_back(r: np.ndarray, sym: np.ndarray, states, gates, cells, grad: np.ndarray):
    """Gradients of u and r for the gradient of the states."""
    steps, _, n, hidden = states.shape
    zs = np.empty_like(gates)
    dh, dc = np.zeros((2, n, hidden), np.float32), np.zeros((2, n, hidden), np.float32)
    across = r.transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        i, f, o, g = (gates[t][..., k * hidden:(k + 1) * hidden] for k in range(4))
        tc = np.tanh(cells[t])
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - tc * tc)
        before = cells[t - 1] if t else np.zeros_like(dc)
        z = zs[t]
        z[..., :hidden] = dc * g * i * (1 - i)
        z[..., hidden:2 * hidden] = dc * before * f * (1 - f)
        z[..., 2 * hidden:3 * hidden] = dh * tc * o * (1 - o)
        z[..., 3 * hidden:] = dc * i * (1 - g * g)
        dc = dc * f
        dh = z @ across
    du, dr = [], []
    for d in range(2):
        seen = (sym[:, d].reshape(-1)[:, None] == np.arange(SYMBOLS)).astype(np.float32)
        du.append(seen.T @ zs[:, d].reshape(steps * n, -1))
        dr.append(states[:-1, d].reshape(-1, hidden).T @ zs[1:, d].reshape((steps - 1) * n, -1))
    return np.stack(du), np.stack(dr)


def _scores(m: Model, windows: np.ndarray, keep: bool = False):
    """Label scores (steps, windows, labels), and what training needs."""
    sym = np.stack([windows.T, windows.T[::-1]], axis=1).astype(np.int64)
    run = _lstm(m.u, m.r, sym, keep)
    both = np.concatenate([run[0][:, 0], run[0][::-1, 1]], axis=2)
    return both @ m.out + m.bias, both, sym, run


def _chain(m: Model, scores: np.ndarray):
    """Scaled forward and backward passes: (marginals, transitions' expected counts,
    log of the sum over all labellings, by window)."""
    steps, n, labels = scores.shape
    top = scores.max(2, keepdims=True)
    e = np.exp(scores - top)
    x = np.exp(m.trans) * allowed(labels)
    a, b, scale = np.empty_like(e), np.empty_like(e), np.empty((steps, n, 1), np.float32)
    for t in range(steps):
        a[t] = e[t] * (a[t - 1] @ x if t else np.exp(m.first))
        scale[t] = a[t].sum(1, keepdims=True)
        a[t] /= scale[t]
    b[-1] = 1
    for t in range(steps - 2, -1, -1):
        b[t] = (e[t + 1] * b[t + 1] / scale[t + 1]) @ x.T
    pairs = np.einsum("tni,tnj->ij", a[:-1], e[1:] * b[1:] / scale[1:], optimize=True) * x
    return a * b, pairs, (np.log(scale) + top).sum((0, 2))


def train(windows: np.ndarray, labels: np.ndarray, kinds: tuple[str, ...], hidden: int = 24, steps: int = 360,
          batch: int = 48, rate: float = 0.025, seed: int = 7) -> Model:
    """Fit on symbols and labels (windows, width) by Adam on the chain's log loss."""
    rng = np.random.default_rng(seed)
    n, width = windows.shape
    k = 1 + 2 * len(kinds)

    def draw(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.15).astype(np.float32)

    p = [draw(2, SYMBOLS, 4 * hidden), draw(2, hidden, 4 * hidden), draw(2 * hidden, k), np.zeros(k, np.float32), draw(k, k), draw(k)]
    p[0][:, :, hidden:2 * hidden] += 1  # remember at first
    first, second = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    queue = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        while len(queue) < batch:
            queue = np.concatenate([queue, rng.permutation(n)])
        take, queue = queue[:batch], queue[batch:]
        m = Model(kinds, width, *p)
        want = labels[take].T
        scores, both, sym, run = _scores(m, windows[take], keep=True)
        marginal, pairs, _ = _chain(m, scores)
        truth = np.eye(k, dtype=np.float32)[want]
        error = (marginal - truth) / batch
        seen = np.einsum("tni,tnj->ij", truth[:-1], truth[1:], optimize=True)
        flat = both.reshape(-1, 2 * hidden)
        d_both = error @ m.out.T
        du, dr = _lstm_back(m.r, sym, *run, np.stack([d_both[:, :, :hidden], d_both[::-1, :, hidden:]], axis=1))
        grads = [du, dr, flat.T @ error.reshape(-1, k), error.sum((0, 1)),
                 (pairs - seen) / batch, error[0].sum(0)]
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1))) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for x, g, f, s in zip(p, grads, first, second):
            g = g * min(1.0, 5.0 / max(size, 1e-9))
            f += 0.1 * (g - f)
            s += 0.001 * (g * g - s)
            x -= (pace * f / (np.sqrt(s) + 1e-8)).astype(np.float32)
    return Model(kinds, width, *p)


def loss(m: Model, windows: np.ndarray, labels: np.ndarray) -> float:
    """Mean log loss of the labellings."""
    scores = _scores(m, windows)[0]
    want = labels.T
    total = _chain(m, scores)[2]
    own = np.take_along_axis(scores, want[:, :, None], 2)[:, :, 0].sum(0) + m.first[want[0]] + m.trans[want[:-1], want[1:]].sum(0)
    return float((total - own).mean())


def decode(m: Model, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best labelling of each window and its labels' marginals, (windows, width)."""
    scores = _scores(m, windows)[0]
    steps, n, k = scores.shape
    moves = np.where(allowed(k) > 0, m.trans, np.float32(-1e9))
    came = np.empty((steps, n, k), np.uint8)
    best = m.first + scores[0]
    for t in range(1, steps):
        ways = best[:, :, None] + moves
        came[t] = ways.argmax(1)
        best = np.take_along_axis(ways, came[t][:, None, :].astype(np.int64), 1)[:, 0] + scores[t]
    labels = np.empty((steps, n), np.int64)
    labels[-1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        labels[t - 1] = came[t][np.arange(n), labels[t]]
    marginal = _chain(m, scores)[0]
    return labels.T, np.take_along_axis(marginal, labels[:, :, None], 2)[:, :, 0].T
