"""A bidirectional gated recurrent network over bytes, in numpy.

Gates of one direction at step t (x a byte, E a 256-row table that holds
input weights and bias together)::

    z = sigmoid(E[x]_z + h U_z)      r = sigmoid(E[x]_r + h U_r)
    n = tanh(E[x]_n + r * (h U_n))   h' = (1 - z) n + z h

A softmax layer over both directions' states labels every byte.
"""

from __future__ import annotations

import numpy as np


def _sigmoid(x):
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _softmax(x):
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


class ByteGRU:
    """Weights and their use; the class holds numpy arrays only, so it travels to tasks by pickling."""

    def __init__(self, classes: int, hidden: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden, self.classes = hidden, classes
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.w = {"Ef": draw(256, 3 * hidden), "Eb": draw(256, 3 * hidden),
                  "Uf": draw(hidden, 3 * hidden), "Ub": draw(hidden, 3 * hidden),
                  "V": draw(2 * hidden, classes), "c": np.zeros(classes, np.float32)}

    # -- scoring ---------------------------------------------------------

    def _scaled(self, d: str) -> tuple[np.ndarray, np.ndarray]:
        """Weights for ``sigmoid(x) = (1 + tanh(x / 2)) / 2``: halved gates, and U_n halved for r * (h U_n)."""
        h = self.hidden
        table, u = self.w["E" + d].copy(), self.w["U" + d] * np.float32(0.5)
        table[:, :2 * h] *= 0.5
        return table, np.ascontiguousarray(u.T)

    def _run(self, d: str, x: np.ndarray, alive: np.ndarray | None, steps) -> np.ndarray:
        """States of one direction, (T, H, N); ``alive`` (T, N) zeroes the state on padding.

        Rows lie along the last axis, so every elementwise step runs over contiguous memory.
        """
        size, rows = self.hidden, x.shape[1]
        table, u = self._scaled(d)
        out = np.empty((x.shape[0], size, rows), np.float32)
        taken, a, g = np.empty((rows, 3 * size), np.float32), *np.empty((2, 3 * size, rows), np.float32)
        h = np.zeros((size, rows), np.float32)
        zr, hn = a[:2 * size], g[2 * size:]
        for t in steps:
            np.take(table, x[t], axis=0, out=taken, mode="clip")
            a[...] = taken.T
            np.matmul(u, h, out=g)
            zr += g[:2 * size]
            np.tanh(zr, out=zr)
            zr += 1                      # twice the sigmoids
            hn *= zr[size:]
            hn += a[2 * size:]
            np.tanh(hn, out=hn)
            h = np.subtract(h, hn, out=out[t])
            z = zr[:size]
            z *= 0.5
            h *= z
            h += hn
            if alive is not None:
                h *= alive[t]
        return out

    def pooled_probabilities(self, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Sum over each row's bytes of their class probabilities: x (T, N) byte numbers, length (N,) -> (C, N)."""
        steps, size = x.shape[0], self.hidden
        alive = None
        if (length < steps).any():
            alive = (np.arange(steps)[:, None] < length).astype(np.float32)
        f = self._run("f", x, alive, range(steps))
        b = self._run("b", x, alive, range(steps - 1, -1, -1))
        vf, vb = np.ascontiguousarray(self.w["V"][:size].T), np.ascontiguousarray(self.w["V"][size:].T)
        total = np.zeros((self.classes, x.shape[1]), np.float32)
        for t in range(steps):
            p = vf @ f[t]
            p += vb @ b[t]
            p += self.w["c"][:, None]
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            if alive is not None:
                p *= alive[t]
            total += p
        return total

    # -- training --------------------------------------------------------

    def _loss_grads(self, x: np.ndarray, y: np.ndarray):
        """Mean cross entropy over all positions and its gradients by backpropagation through time."""
        steps, rows, h_size, w = x.shape[0], x.shape[1], self.hidden, self.w
        runs = {}
        for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            h, kept = np.zeros((rows, h_size), np.float32), {}
            for t in order:
                a, g = w["E" + d][x[t]], h @ w["U" + d]
                zr = _sigmoid(a[:, :2 * h_size] + g[:, :2 * h_size])
                z, r, hn = zr[:, :h_size], zr[:, h_size:], g[:, 2 * h_size:]
                n = np.tanh(a[:, 2 * h_size:] + r * hn)
                new = (1 - z) * n + z * h
                kept[t], h = (h, z, r, n, hn, new), new
            runs[d] = kept
        states = np.concatenate([np.stack([runs["f"][t][5] for t in range(steps)]),
                                 np.stack([runs["b"][t][5] for t in range(steps)])], axis=2)
        flat = states.reshape(-1, 2 * h_size)
        p = _softmax(flat @ w["V"] + w["c"])
        target = np.tile(y, steps)
        picked = np.arange(len(target))
        loss = float(-np.log(p[picked, target] + 1e-12).mean())
        p[picked, target] -= 1
        p /= len(target)
        grads = {"V": flat.T @ p, "c": p.sum(axis=0)}
        d_states = (p @ w["V"].T).reshape(steps, rows, 2 * h_size)
        for d, order, cut in (("f", range(steps - 1, -1, -1), slice(0, h_size)),
                              ("b", range(steps), slice(h_size, None))):
            d_u, d_x = np.zeros_like(w["U" + d]), np.empty((steps, rows, 3 * h_size), np.float32)
            back = np.zeros((rows, h_size), np.float32)
            for t in order:
                h, z, r, n, hn, _ = runs[d][t]
                dh = d_states[t][:, cut] + back
                dz = dh * (h - n) * z * (1 - z)
                dn = dh * (1 - z) * (1 - n * n)
                dr = dn * hn * r * (1 - r)
                d_x[t] = np.concatenate([dz, dr, dn], axis=1)
                dg = np.concatenate([dz, dr, dn * r], axis=1)
                d_u += h.T @ dg
                back = dh * z + dg @ w["U" + d].T
            table = np.zeros_like(w["E" + d])
            np.add.at(table, x.reshape(-1), d_x.reshape(-1, 3 * h_size))
            grads |= {"U" + d: d_u, "E" + d: table}
        return loss, grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 250, batch: int = 200,
            rate: float = 0.02, seed: int = 11) -> ByteGRU:
        """Adam on class-balanced batches; x (rows, T) uint8, y (rows,) class numbers."""
        rng = np.random.default_rng(seed)
        members = [np.flatnonzero(y == c) for c in range(self.classes)]
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(a) for k, a in self.w.items()}
        for i in range(1, steps + 1):
            pick = np.concatenate([rng.choice(rows, -(-batch // self.classes)) for rows in members])
            _, grads = self._loss_grads(np.ascontiguousarray(x[pick].T), y[pick])
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step = rate * (1 - i / (steps + 1)) ** 0.5
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / (size + 1e-12))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.w[k] -= (step * (m[k] / (1 - 0.9 ** i))
                              / (np.sqrt(v[k] / (1 - 0.999 ** i)) + 1e-8)).astype(np.float32)
        return self
