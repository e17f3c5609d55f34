"""First and second derivatives of the Pareto/NBD and Gamma/Gamma log-likelihoods (V3, V4, V7).

Self-contained (numpy and math only) like :mod:`kernels`: tasks get it by value.

A Pareto/NBD term is ``head + ln(alive + dead)``, where ``dead`` is an
integral over the unseen time y of death. With the posterior weights of
"alive" and of every quadrature node (they sum to 1) and u the derivatives
of the logarithm of each part, the score is ``E[u]`` and the second
derivative ``E[u u' + du] - E[u] E[u]'``; no differences are taken. x is a
count, so the gamma functions give finite sums.
"""

from __future__ import annotations

import math

import numpy as np

# Fixed value: number of Gauss-Legendre nodes, as in the likelihood.
_Z, _W = np.polynomial.legendre.leggauss(64)


def _count_sums(r: float, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """lnG(r+x) - lnG(r), its derivative and second derivative in r, for whole x."""
    uniq, inv = np.unique(x, return_inverse=True)
    steps = r + np.arange(int(uniq.max()) if len(uniq) else 0)
    at = uniq.astype(int)
    def upto(values):
        return np.concatenate([[0.0], np.cumsum(values)])[at][inv]
    return upto(np.log(steps)), upto(1 / steps), upto(-1 / steps ** 2)


def pnbd_terms(params, x, t, T) -> np.ndarray:
    """(n, 15): log-likelihood, score (r, a, s, b) and the upper triangle of the second derivatives, row by row."""
    r, a, s, b = (float(v) for v in params)
    x, t, T = (np.asarray(v, float) for v in (x, t, T))
    m = min(a, b)
    lo, hi = np.log(t + m), np.log(T + m)
    half = (hi - lo) / 2
    v = half[:, None] * _Z + ((hi + lo) / 2)[:, None]
    ay, by = np.exp(v) + (a - m), np.exp(v) + (b - m)       # a + y, b + y at the nodes
    rx = (r + x)[:, None]
    with np.errstate(divide="ignore"):
        dead = np.log(half)[:, None] + np.log(_W) + v - rx * np.log(ay) - (s + 1) * np.log(by) + math.log(s)
    alive = -(r + x) * np.log(a + T) - s * np.log(b + T)
    parts = np.concatenate([alive[:, None], dead], axis=1)
    top = parts.max(axis=1, keepdims=True)
    weights = np.exp(parts - top)
    total = weights.sum(axis=1, keepdims=True)
    weights /= total
    lg, d_lg, dd_lg = _count_sums(r, x)
    log_part = (top + np.log(total))[:, 0]
    # the same derivatives at T (alive) and at the nodes (dead), side by side
    A = np.concatenate([(a + T)[:, None], ay], axis=1)
    B = np.concatenate([(b + T)[:, None], by], axis=1)
    died = np.concatenate([[0.0], np.ones(len(_Z))])
    u = [-np.log(A), -rx / A, died / s - np.log(B), -(s + died) / B]
    du = {(0, 1): -1 / A, (1, 1): rx / A ** 2, (2, 2): -died / s ** 2 + np.zeros_like(A), (2, 3): -1 / B, (3, 3): (s + died) / B ** 2}
    mean = [(weights * k).sum(axis=1) for k in u]
    zero = np.zeros_like(x)
    head = [d_lg + math.log(a), r / a + zero, math.log(b) + zero, s / b + zero]
    head2 = {(0, 0): dd_lg, (0, 1): 1 / a + zero, (1, 1): -r / a ** 2 + zero, (2, 3): 1 / b + zero, (3, 3): -s / b ** 2 + zero}
    out = [lg + r * math.log(a) + s * math.log(b) + log_part, *[h + k for h, k in zip(head, mean)]]
    for i in range(4):
        for j in range(i, 4):
            second = (weights * (u[i] * u[j] + du.get((i, j), 0.0))).sum(axis=1) - mean[i] * mean[j]
            out.append(second + head2.get((i, j), zero))
    return np.stack(out, axis=1)


def _digamma(x: np.ndarray) -> np.ndarray:
    """psi(x), x > 0: shifted up by ten, then the asymptotic series."""
    x = np.asarray(x, float)
    low = sum(1 / (x + k) for k in range(10))
    y = x + 10
    z = 1 / (y * y)
    return np.log(y) - 1 / (2 * y) - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z / 240))) - low


def _trigamma(x: np.ndarray) -> np.ndarray:
    """psi'(x), likewise."""
    x = np.asarray(x, float)
    low = sum(1 / (x + k) ** 2 for k in range(10))
    y = x + 10
    z = 1 / (y * y)
    return 1 / y + z / 2 + z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z / 30))) + low


def gg_terms(params, n, z) -> np.ndarray:
    """(n, 10): log-likelihood, score (p, q, g) and the upper triangle of the second derivatives."""
    p, q, g = (float(v) for v in params)
    n, z = (np.asarray(v, float) for v in (n, z))
    uniq, inv = np.unique(n, return_inverse=True)
    pu = p * uniq
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    lg = (lgamma(pu + q) - lgamma(pu) - math.lgamma(q))[inv] if len(uniq) else np.zeros(0)
    both, own = _digamma(pu + q)[inv], _digamma(pu)[inv]
    both2, own2 = _trigamma(pu + q)[inv], _trigamma(pu)[inv]
    pn, all_ = p * n, g + n * z
    one = np.ones_like(n)
    return np.stack([
        lg + q * math.log(g) + (pn - 1) * np.log(z) + pn * np.log(n) - (pn + q) * np.log(all_),
        n * (both - own + np.log(z) + np.log(n) - np.log(all_)),
        both - _digamma(q) + math.log(g) - np.log(all_),
        q / g - (pn + q) / all_,
        n * n * (both2 - own2), n * both2, -n / all_, both2 - _trigamma(q) * one, 1 / g - 1 / all_,
        -q / g ** 2 + (pn + q) / all_ ** 2], axis=1)
