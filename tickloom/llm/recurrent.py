"""A gated recurrent language model in numpy.

Inputs and outputs are word ids 0 .. n-1 by falling frequency, and from n on ids of classes of rarer words.
The output is factored: a softmax over classes of neighbouring ids (and the classes of rarer words), then a
softmax over the words of the class. Classes share the sum of the roots of the counts evenly, so frequent
words lie in small classes and a token costs little in a large vocabulary. Documents lie on lanes; a lane's
state passes from window to window and starts at zero with each document, so a document is scored whole,
whatever its length.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

WINDOW = 32
F32 = np.float32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.minimum(x, F32(60), out=x), out=x)
    x += F32(1)
    return np.reciprocal(x, out=x)


def _choose(logits: np.ndarray, chosen: np.ndarray, slopes: bool, weight: float) -> tuple:
    """Log probabilities of the chosen rows of logits (choices x tokens), and the loss's slopes."""
    np.clip(logits, -60, 60, out=logits)
    at = np.arange(len(chosen))
    picked = logits[chosen, at]
    odds = np.exp(logits, out=logits)
    total = odds.sum(0)
    logs = picked.astype(np.float64) - np.log(total)
    if not slopes:
        return logs, None
    odds *= F32(weight) / total
    odds[chosen, at] -= F32(weight)
    return logs, odds


@dataclass
class Lanes:
    """Documents laid on lanes, the fullest lane first; a lane's tokens stand one after the other.

    place: the token's place in the input, lane by lane; begins: whether a document begins there.
    """

    place: np.ndarray
    begins: np.ndarray
    first: np.ndarray  # where each lane begins in `place`
    active: np.ndarray  # lanes in use at each step

    def at(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of step `t`, and which of them begin a document."""
        k = self.first[: self.active[t]] + t
        return self.place[k], self.begins[k]


def lanes(lengths: np.ndarray, most: int) -> Lanes:
    """Each document goes, longest first, to the lane with the fewest tokens."""
    ends = np.cumsum(lengths)
    n = int(max(1, min(most, ends[-1] // (4 * WINDOW), len(lengths))))
    heap = [(0, k) for k in range(n)]
    held: list[list[int]] = [[] for _ in range(n)]
    for d in np.argsort(-lengths, kind="stable"):
        used, k = heap[0]
        held[k].append(int(d))
        heapq.heapreplace(heap, (used + int(lengths[d]), k))
    sizes = np.array([sum(int(lengths[d]) for d in ds) for ds in held])
    order = np.argsort(-sizes, kind="stable")
    docs = np.array([d for k in order for d in held[k]])
    size = lengths[docs]
    start = np.cumsum(size) - size
    place = np.arange(int(ends[-1])) + np.repeat(ends[docs] - size - start, size)
    begins = np.zeros(int(ends[-1]), bool)
    begins[start] = True
    sizes = sizes[order]
    return Lanes(place, begins, np.cumsum(sizes) - sizes, np.searchsorted(-sizes, -np.arange(int(sizes.max())), "left"))


class Network:
    """Weights by name: inputs X, recurrence U and u, classes C and c, words W and w."""

    def __init__(self, words: int, classes: int, hidden: int = 24, weights: dict | None = None, seed: int = 5, rare: int = 1,
                 edges: np.ndarray | None = None):
        self.words, self.classes, self.hidden, self.rare = words, max(1, min(classes, words)), hidden, rare
        self.edges = self._edges(np.ones(words)) if edges is None else edges
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale=0.1: rng.normal(0, scale, shape).astype(F32)
        self.p = weights or {
            "X": normal(words + rare, 3 * hidden), "U": normal(hidden, 3 * hidden, scale=hidden**-0.5), "u": np.zeros(hidden, F32),
            "C": normal(hidden, self.classes + rare), "c": np.zeros(self.classes + rare, F32),
            "W": normal(words, hidden), "w": np.zeros(words, F32),
        }

    def _edges(self, counts: np.ndarray) -> np.ndarray:
        """Where each class begins, and the end: even sums of the roots of the counts, no class empty."""
        upto, k = np.cumsum(np.sqrt(np.asarray(counts, np.float64) + 1e-3)), np.arange(self.classes)
        begin = np.searchsorted(upto, upto[-1] * k / self.classes * (1 - 1e-9))
        begin = np.minimum(np.maximum.accumulate(begin - k) + k, self.words - self.classes + k)
        return np.append(begin, self.words)

    def with_frequencies(self, counts: np.ndarray, rare: np.ndarray) -> Network:
        """Classes by frequency, and output biases that give each word and each class of rarer words its share."""
        self.edges = self._edges(counts)
        self.p["w"] = np.log(counts + 1e-3).astype(F32)
        share = np.append(np.add.reduceat(counts, self.edges[:-1]), rare) + 1.0
        self.p["c"] = np.log(share / share.sum()).astype(F32)
        return self

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def from_flat(self, flat: np.ndarray) -> Network:
        out, at = {}, 0
        for k in sorted(self.p):
            n = self.p[k].size
            out[k] = flat[at : at + n].reshape(self.p[k].shape).astype(F32)
            at += n
        return Network(self.words, self.classes, self.hidden, out, rare=self.rare, edges=self.edges)

    def _step(self, h: np.ndarray, ids: np.ndarray) -> tuple:
        m = self.hidden
        x, g = self.p["X"][ids], h @ self.p["U"]
        zr = _sigmoid(x[:, : 2 * m] + g[:, : 2 * m])
        z, r = zr[:, :m], zr[:, m:]
        back = g[:, 2 * m :] + self.p["u"]
        n = x[:, 2 * m :] + r * back
        n *= F32(2)
        n = _sigmoid(n)
        n *= F32(2)
        n -= F32(1)
        return n + z * (h - n), z, r, n, back

    def _class_of(self) -> np.ndarray:
        return np.append(np.repeat(np.arange(self.classes), np.diff(self.edges)), self.classes + np.arange(self.rare))

    def _outputs(self, h: np.ndarray, ids: np.ndarray, gradients: dict | None = None, weight: float = 1.0):
        """Log probabilities of ids after states h; with `gradients`, also those of the states.

        Logits lie as choices x tokens, so sums over choices run along contiguous rows.
        """
        p, ht = self.p, np.ascontiguousarray(h.T)
        kind = self._class_of()[ids]
        out, dt = np.empty(len(ids)), None
        if gradients is not None:
            gradients["W"], gradients["w"] = np.zeros_like(p["W"]), np.zeros_like(p["w"])
        out, d = _choose(p["C"].T @ ht + p["c"][:, None], kind, gradients is not None, weight)
        if gradients is not None:
            gradients["C"], gradients["c"] = (d @ h).T, d.sum(1)
            dt = p["C"] @ d
        order = np.argsort(kind.astype(np.uint16) if self.classes + self.rare < 1 << 16 else kind, kind="stable")
        edges = np.searchsorted(kind[order], np.arange(self.classes + 1))
        for k in range(self.classes):
            take = order[edges[k] : edges[k + 1]]
            if not len(take):
                continue
            own = slice(self.edges[k], self.edges[k + 1])
            hk = h[take]
            logs, d = _choose(p["W"][own] @ hk.T + p["w"][own, None], ids[take] - own.start, gradients is not None, weight)
            out[take] += logs
            if gradients is not None:
                gradients["W"][own], gradients["w"][own] = d @ hk, d.sum(1)
                dt[:, take] += p["W"][own].T @ d
        return out, None if dt is None else dt.T

    def score(self, ids: np.ndarray, lengths: np.ndarray, most: int = 1024) -> np.ndarray:
        """Natural log probability of each token (of its class alone, for rarer words)."""
        out = np.zeros(len(ids))
        lay = lanes(lengths, most)
        h = np.zeros((len(lay.first), self.hidden), F32)
        states, places, held = [], [], 0
        for t in range(len(lay.active)):
            at, begins = lay.at(t)
            h = h[: len(at)]
            if begins.any():
                h[begins] = 0
            states.append(h)
            places.append(at)
            held += len(at)
            h = self._step(h, ids[at])[0]
            if held >= WINDOW * most or t + 1 == len(lay.active):
                at = np.concatenate(places)
                out[at] = self._outputs(np.concatenate(states), ids[at])[0]
                states, places, held = [], [], 0
        return out

    def train(self, ids: np.ndarray, lengths: np.ndarray, adam: Adam, most: int = 256) -> None:
        """One pass; gradients stop at a window's start, the state goes on.

        A window has `WINDOW` steps, or more where few lanes are left, so that updates rest on similar numbers
        of tokens.
        """
        lay = lanes(lengths, most)
        h = np.zeros((len(lay.first), self.hidden), F32)
        t, last = 0, len(lay.active)
        while t < last:
            a = int(lay.active[t])
            steps = min(last - t, WINDOW * max(1, min(16, most // (4 * a))))
            tokens, begins, there = np.zeros((steps, a), np.int64), np.zeros((steps, a), bool), np.zeros((steps, a), bool)
            for k in range(steps):
                at, start = lay.at(t + k)
                tokens[k, : len(at)], begins[k, : len(at)], there[k, : len(at)] = ids[at], start, True
            h = self._window(h[:a], tokens, begins, there, adam, WINDOW * most // 4)
            t += steps

    def _window(self, h: np.ndarray, tokens: np.ndarray, start: np.ndarray, there: np.ndarray, adam: Adam, least: int = 1) -> np.ndarray:
        """`least`: a window of fewer tokens weighs less than a whole update."""
        steps, n = tokens.shape
        m = self.hidden
        before, kept = np.empty((steps, n, m), F32), []
        for t in range(steps):
            h = np.where(start[t][:, None], F32(0), h)
            before[t] = h
            h, *gates = self._step(h, tokens[t])
            kept.append(gates)
        g: dict[str, np.ndarray] = {}
        use = np.flatnonzero(there.ravel())
        flat = before.reshape(-1, m)
        _, d = self._outputs(flat[use], tokens.ravel()[use], g, 1.0 / max(1, least, len(use)))
        dout = np.zeros_like(flat)
        dout[use] = d
        dout = dout.reshape(steps, n, m)
        dx, dg = np.empty((steps, n, 3 * m), F32), np.empty((steps, n, 3 * m), F32)
        after, back = np.zeros((n, m), F32), self.p["U"].T
        for t in range(steps - 1, -1, -1):
            z, r, c, past = kept[t]
            after *= there[t][:, None]
            dc = after * (1 - z) * (1 - c * c)
            dz = after * (before[t] - c) * z * (1 - z)
            dr = dc * past * r * (1 - r)
            dx[t, :, :m], dx[t, :, m : 2 * m], dx[t, :, 2 * m :] = dz, dr, dc
            dg[t, :, : 2 * m], dg[t, :, 2 * m :] = dx[t, :, : 2 * m], dc * r
            after = after * z + dg[t] @ back + dout[t]
            after *= ~start[t][:, None]
        g["U"] = flat.T @ dg.reshape(-1, 3 * m)
        g["u"] = dg[:, :, 2 * m :].sum((0, 1))
        by = tokens.ravel().astype(np.uint16) if self.words + self.rare <= 1 << 16 else tokens.ravel()  # short keys sort faster
        order = np.argsort(by, kind="stable")
        by = by[order]
        first = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
        sums = np.add.reduceat(dx.reshape(-1, 3 * m)[order], first, axis=0)
        adam.update(self.p, g, by[first], sums)
        return h


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01, clip: float = 1.0):
        self.rate, self.clip, self.step = rate, clip, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def update(self, p: dict, g: dict, rows: np.ndarray, x: np.ndarray) -> None:
        """`x`: gradients of these rows of the inputs; all other gradients are dense."""
        self.step += 1
        norm = np.sqrt(sum(float((a * a).sum()) for a in [*g.values(), x]))
        scale = F32(min(1.0, self.clip / (norm + 1e-9)))
        fix = F32(self.rate * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step))
        for k, a, at in [*((k, a, slice(None)) for k, a in g.items()), ("X", x, rows)]:
            a = a * scale
            m = self.m[k][at] * F32(0.9) + a * F32(0.1)
            v = self.v[k][at] * F32(0.99) + a * a * F32(0.01)
            self.m[k][at], self.v[k][at] = m, v
            p[k][at] -= fix * m / (np.sqrt(v) + F32(1e-6))
