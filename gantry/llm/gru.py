"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, carried state.

Tokens are numbers: 0 is the end of a document, 1..words-1 are frequent words, words..words+groups-1 stand for a word
of each group of rarer ones. A document begins from a zero state with input 0 (its neighbour's end), and its state is
carried from window to window, so the score is that of the whole document. The output is P(class | state), times
P(word | class, state) for frequent words; a group is a class of its own, within which the caller's counts decide.

Many documents run side by side in lanes, one behind the other. Backpropagation stops at the edge of a window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

IN_CLASS = 32
#: Rows whose outputs are found at a time: they stay in a core's own cache.
ROWS = 1024


class Model:
    """Parameters as views into one flat float32 vector."""

    def __init__(self, words: int, groups: int, hidden: int = 16, seed: int = 1) -> None:
        self.words, self.groups, self.hidden = words, groups, hidden
        self.classes = -(-words // IN_CLASS)
        h, slots = hidden, self.classes * IN_CLASS
        self.shapes = {"x": (words + groups, 3 * h), "u": (h, 2 * h), "v": (h, h), "wc": (h, self.classes + groups), "bc": (self.classes + groups,), "ww": (slots, h), "bw": (slots,)}
        self.flat = np.zeros(sum(int(np.prod(s)) for s in self.shapes.values()), np.float32)
        p = self.views(self.flat)
        rng = np.random.default_rng(seed)
        for name in ("x", "u", "v", "wc", "ww"):
            p[name][...] = rng.normal(0, 0.3 if name in ("u", "v") else 0.1, p[name].shape)
        p["x"][:, :h] += 1.0  # gates begin half open to the past
        self.slot = np.arange(words)  # of each word: class * IN_CLASS + place
        self.empty = np.ones(slots, bool)
        self.set_slots(self.slot)

    def set_slots(self, slot: np.ndarray) -> None:
        self.slot = slot
        self.empty[:] = True
        self.empty[slot] = False
        self.views(self.flat)["bw"][self.empty] = -1e4

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out

    def class_of(self, token: np.ndarray) -> np.ndarray:
        """Of every token: its class."""
        table = np.concatenate([self.slot // IN_CLASS, self.classes + np.arange(self.groups)])
        return table.take(token)


def lanes(sizes: np.ndarray, most: int) -> tuple[list[list[int]], np.ndarray]:
    """Documents of each lane and its tokens: longest first, to the lane that is shortest so far; longest lane first."""
    n = int(min(most, len(sizes)))
    heap = [(0, k) for k in range(n)]
    own: list[list[int]] = [[] for _ in range(n)]
    for i in np.argsort(-sizes, kind="stable").tolist():
        length, k = heapq.heappop(heap)
        own[k].append(i)
        heapq.heappush(heap, (length + int(sizes[i]), k))
    total = np.array([sum(int(sizes[i]) for i in x) for x in own])
    order = np.argsort(-total, kind="stable")
    return [own[k] for k in order.tolist()], total[order]


def windows(starts: np.ndarray, sizes: np.ndarray, most: int, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, fresh) of each window in turn: places in the flat tokens or -1, and where a document begins.

    Lanes that have ended fall away.
    """
    if not len(sizes):
        return
    own, total = lanes(sizes, most)
    turn = np.concatenate([np.array(x, np.int64) for x in own])
    size = sizes[turn]
    begin = np.cumsum(size) - size  # of each document where all lanes stand one behind the other
    places = np.arange(size.sum()) + np.repeat(starts[turn] - begin, size)
    first = np.zeros(len(places), bool)
    first[begin[size > 0]] = True
    lane = np.cumsum(total) - total
    for at in range(0, int(total[0]), steps):
        step = np.arange(at, min(at + steps, int(total[0])))[:, None]
        active = int((total > at).sum())
        inside = step < total[:active]
        where = np.where(inside, lane[:active] + step, 0)
        yield np.where(inside, places[where], -1), inside & first[where]


def forward(m: Model, p: dict[str, np.ndarray], tokens_in: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool = False):
    """States after each step (steps, lanes, hidden), and what backward steps need: the states before, the two gates, the candidates.

    Gates lie one behind the other, (2, lanes, hidden), so that all a step does runs over unbroken memory.
    """
    steps, n = tokens_in.shape
    h, width = state, m.hidden
    # the gates' weights are turned to their negatives here, which spares a pass at each step of 1 / (1 + exp(-a))
    x, u = p["x"].reshape(-1, 3, width).transpose(1, 0, 2).copy(), p["u"].reshape(width, 2, width).transpose(1, 0, 2).copy()
    np.negative(x[:2], out=x[:2])
    np.negative(u, out=u)
    xs = x.take(tokens_in, axis=1)
    out = np.empty((steps, n, width), np.float32)
    kept = steps if keep else 1
    before, zr, c = np.empty((kept, n, width), np.float32), np.empty((kept, 2, n, width), np.float32), np.empty((kept, n, width), np.float32)
    carried = ~fresh
    whole = carried.all(axis=1)
    reset = np.empty((n, width), np.float32)
    for t in range(steps):
        if not whole[t]:
            h = h * carried[t][:, None]
        k = t if keep else 0
        gates, cand, new = zr[k], c[k], out[t]
        np.matmul(h, u, out=gates)
        gates += xs[:2, t]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[1], h, out=reset)
        np.matmul(reset, p["v"], out=cand)
        cand += xs[2, t]
        np.tanh(cand, out=cand)
        if keep:
            before[t] = h
        np.subtract(h, cand, out=new)
        new *= gates[0]
        new += cand
        h = new
    return out, (before, zr, c)


def class_scores(m: Model, p: dict[str, np.ndarray], states: np.ndarray, target: np.ndarray, grads: dict[str, np.ndarray] | None = None):
    """Natural log probability of each target given the state (rows), and with grads the gradient by the states.

    Rows are taken by the class of their target, some at a time: the outputs of all classes and of the words in this one
    come from one product, with an output's values for all rows side by side.
    """
    kinds = m.classes + m.groups
    cls = m.class_of(target).astype(np.uint16)
    order = np.argsort(cls, kind="stable")
    target = target.take(order)
    cuts = np.concatenate([[0], np.cumsum(np.bincount(cls, minlength=kinds))]).tolist()
    states = states.take(order, axis=0)
    logp, d = np.empty(len(target), np.float32), np.empty_like(states) if grads is not None else None
    place = (m.slot % IN_CLASS + kinds).take(target, mode="clip")
    weights, bias = np.empty((kinds + IN_CLASS, m.hidden), p["wc"].dtype), np.empty((kinds + IN_CLASS, 1), p["bc"].dtype)
    weights[:kinds], bias[:kinds, 0] = p["wc"].T, p["bc"]
    for k in range(m.classes + 1):  # the last: words of all groups, which are classes of their own
        begin, end, inner = cuts[k], cuts[k + 1] if k < m.classes else len(target), k < m.classes
        if begin == end:
            continue
        s = slice(k * IN_CLASS, (k + 1) * IN_CLASS)
        if inner:
            weights[kinds:], bias[kinds:, 0] = p["ww"][s], p["bw"][s]
        own, shift = (weights, bias) if inner else (weights[:kinds], bias[:kinds])
        for a in range(begin, end, ROWS):
            b = min(a + ROWS, end)
            rows, at = np.arange(b - a), place[a:b]
            first = k if inner else m.classes + target[a:b] - m.words
            e = own @ states[a:b].T
            e += shift
            picked = e[k] + e[at, rows] if inner else e[first, rows]
            np.exp(e, out=e)
            z = e[:kinds].sum(axis=0)
            picked -= np.log(z)
            if inner:
                z_in = e[kinds:].sum(axis=0)
                picked -= np.log(z_in)
            logp[a:b] = picked
            if grads is not None:
                e[:kinds] *= np.reciprocal(z)
                if inner:
                    e[kinds:] *= np.reciprocal(z_in)
                    e[k] -= 1
                    e[at, rows] -= 1
                else:
                    e[first, rows] -= 1
                by_weight, by_bias = e @ states[a:b], e.sum(axis=1)
                grads["wc"] += by_weight[:kinds].T
                grads["bc"] += by_bias[:kinds]
                if inner:
                    grads["ww"][s] += by_weight[kinds:]
                    grads["bw"][s] += by_bias[kinds:]
                np.matmul(e.T, own, out=d[a:b])
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return logp.take(back), d.take(back, axis=0) if grads is not None else None


def inputs_of(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each token's input is the token before it; a document's first has input 0."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[starts] = 0
    return out


def score(m: Model, tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int = 512, steps: int = 64) -> np.ndarray:
    """Natural log probability of every token, with the state carried from window to window."""
    p = m.views(m.flat)
    ins, out = inputs_of(tokens, starts), np.zeros(len(tokens), np.float32)
    state = None
    for pos, fresh in windows(starts, sizes, most, steps):
        state = np.zeros((pos.shape[1], m.hidden), np.float32) if state is None else state[: pos.shape[1]]
        states, _ = forward(m, p, ins.take(pos, mode="wrap"), fresh, state)
        state = states[-1]
        valid = np.flatnonzero(pos >= 0)
        at = pos.take(valid)
        out[at] = class_scores(m, p, states.reshape(-1, m.hidden).take(valid, axis=0), tokens.take(at))[0]
    return out


class Adam:
    def __init__(self, size: int, rate: float, fall: float = 0.0) -> None:
        """The rate falls to rate / (1 + fall * steps)."""
        self.m, self.v, self.n, self.rate, self.fall = np.zeros(size, np.float32), np.zeros(size, np.float32), 0, rate, fall

    def step(self, flat: np.ndarray, grad: np.ndarray) -> None:
        self.n += 1
        self.m += 0.1 * (grad - self.m)
        grad *= grad
        self.v += 0.01 * (grad - self.v)
        a, b = 1 - 0.9**self.n, 1 - 0.99**self.n
        flat -= (self.rate / (1 + self.fall * self.n) / a) * self.m / (np.sqrt(self.v / b) + 1e-8)


def spans(starts: np.ndarray, sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, sizes) of the documents cut into spans of at most so many tokens."""
    n = -(-sizes // most)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(starts, n) + k * most, np.minimum(np.repeat(sizes, n) - k * most, most)


def train(m: Model, tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray, optimizer: Adam, most: int = 512, steps: int = 32, span: int | None = None) -> tuple[float, int]:
    """One pass over the documents; returns the natural log probability and the number of tokens met.

    With a span, the state begins anew after so many tokens, so a long document does not run on alone beside empty lanes.
    """
    p, grad = m.views(m.flat), np.zeros_like(m.flat)
    g, w = m.views(grad), m.hidden
    ins = inputs_of(tokens, starts)
    if span:
        starts, sizes = spans(starts, sizes, span)
    state, total, count = None, 0.0, 0
    for pos, fresh in windows(starts, sizes, most, steps):
        state = np.zeros((pos.shape[1], w), np.float32) if state is None else state[: pos.shape[1]]
        tokens_in = ins.take(pos, mode="wrap")
        states, (before, zr, c) = forward(m, p, tokens_in, fresh, state, keep=True)
        state = states[-1]
        valid = np.flatnonzero(pos >= 0)
        grad[:] = 0
        target = tokens.take(pos.take(valid))
        logp, d = class_scores(m, p, states.reshape(-1, w).take(valid, axis=0), target, g)
        total, count = total + float(logp.sum(dtype=np.float64)), count + len(target)
        dh_out = np.zeros_like(states)
        dh_out.reshape(-1, w)[valid] = d
        da = np.empty((3, *states.shape), np.float32)
        dh, rest, both = np.zeros_like(states[0]), np.empty_like(states[0]), np.empty((2, *states[0].shape), np.float32)
        v_back, u_back, begins = p["v"].T.copy(), p["u"].reshape(w, 2, w).transpose(1, 2, 0).copy(), fresh.any(axis=1)
        for t in range(len(pos) - 1, -1, -1):
            dh += dh_out[t]
            (z, r), cand, h = zr[t], c[t], before[t]
            by_z, by_r, by_c = da[0, t], da[1, t], da[2, t]
            np.subtract(1, z, out=rest)
            rest *= dh
            np.multiply(cand, cand, out=by_c)
            np.subtract(1, by_c, out=by_c)
            by_c *= rest
            np.subtract(h, cand, out=by_z)
            by_z *= z
            by_z *= rest
            np.matmul(by_c, v_back, out=by_r)
            by_r *= r
            dh *= z
            dh += by_r
            np.subtract(1, r, out=rest)
            rest *= h
            by_r *= rest
            np.matmul(da[:2, t], u_back, out=both)
            dh += both[0]
            dh += both[1]
            if begins[t]:
                dh[fresh[t]] = 0
        flat_h = before.reshape(-1, w)
        by_z, by_r, by_c = flat_da = da.reshape(3, -1, w)
        g["u"][:, :w] += flat_h.T @ by_z
        g["u"][:, w:] += flat_h.T @ by_r
        g["v"] += (zr[:, 1].reshape(-1, w) * flat_h).T @ by_c
        # rows past a lane's end have zero gradients from the output and so none at all
        ids = tokens_in.ravel().astype(np.uint16)
        order = np.argsort(ids, kind="stable")
        ids = ids.take(order)
        cut = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        for k in range(3):
            g["x"][ids[cut], k * w : (k + 1) * w] += np.add.reduceat(flat_da[k].take(order, axis=0), cut, axis=0)
        grad /= max(1, len(target))
        norm = float(np.sqrt(np.dot(grad, grad)))
        if norm > 1:
            grad /= norm
        optimizer.step(m.flat, grad)
        m.views(m.flat)["bw"][m.empty] = -1e4
    return total, count
