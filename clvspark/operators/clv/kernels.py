"""Vectorised per-customer formulas of the Pareto/NBD and Gamma/Gamma models.

This module is self-contained (numpy, pandas, math only): it is pickled by
value into ``mapInPandas`` tasks, so executors need nothing but numpy.
Every function takes K parameter vectors at once and a batch of customers.

Pareto/NBD (Schmittlein, Morrison, Colombo 1987; Fader, Hardie 2005), per
customer with ``x`` repeat purchases, last at ``t``, observed until ``T``::

    LL = lnG(r+x) - lnG(r) + r ln a + s ln b
         + ln[ (a+T)^-(r+x) (b+T)^-s + s I ],
    I  = integral_t^T (a+y)^-(r+x) (b+y)^-(s+1) dy

``I`` is evaluated by Gauss-Legendre quadrature after ``y = e^v - min(a, b)``,
summed in log space. ``lnG(r+x) - lnG(r)`` only needs ``lgamma`` at the
distinct ``x`` of a batch.

Gamma/Gamma (Fader, Hardie 2013), mean spend ``z`` over ``n`` transactions::

    LL = lnG(pn+q) - lnG(pn) - lnG(q) + q ln g + (pn-1) ln z + pn ln n
         - (pn+q) ln(g + n z)
"""

from __future__ import annotations

import math

import numpy as np

# Fixed value: number of Gauss-Legendre nodes for the Pareto/NBD integrals.
QUAD_NODES = 64
_Z, _W = np.polynomial.legendre.leggauss(QUAD_NODES)
_LOG_W = np.log(_W)


def _lgamma(a) -> np.ndarray:
    """Element-wise log-gamma (the arrays are small: parameters x distinct counts)."""
    arr = np.asarray(a, float)
    return np.fromiter((math.lgamma(v) for v in arr.ravel()), float, arr.size).reshape(arr.shape)


def _logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    m = np.max(a, axis=axis, keepdims=True)
    m = np.where(np.isfinite(m), m, 0.0)
    return np.squeeze(m, axis) + np.log(np.sum(np.exp(a - m), axis=axis))


def lgamma_ratio(base: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``lgamma(base[k] + counts[i]) - lgamma(base[k])`` as a (K, n) array."""
    uniq, inv = np.unique(counts, return_inverse=True)
    table = _lgamma(base[:, None] + uniq[None, :]) - _lgamma(base)[:, None]
    return table[:, inv]


def pnbd_log_integral(r, a, s, b, x, t, T) -> np.ndarray:
    """ln I for K parameter vectors (shape (K,)) and n customers -> (K, n)."""
    r, a, s, b = (np.asarray(v, float)[:, None, None] for v in (r, a, s, b))
    x, t, T = (np.asarray(v, float)[None, :, None] for v in (x, t, T))
    m = np.minimum(a, b)
    lo = np.log(t + m)
    hi = np.log(T + m)
    half = (hi - lo) / 2.0
    v = half * _Z[None, None, :] + (hi + lo) / 2.0
    ev = np.exp(v)
    log_g = v - (r + x) * np.log(ev + (a - m)) - (s + 1.0) * np.log(ev + (b - m))
    with np.errstate(divide="ignore"):
        log_half = np.log(half[..., 0])
    out = log_half + _logsumexp(_LOG_W[None, None, :] + log_g, axis=2)
    return np.where(half[..., 0] > 0, out, -np.inf)


def pnbd_loglik(params: np.ndarray, x, t, T) -> np.ndarray:
    """Per-customer log-likelihood, (K, n); ``params`` rows are (r, a, s, b)."""
    r, a, s, b = (params[:, i] for i in range(4))
    x = np.asarray(x, float)
    t = np.asarray(t, float)
    T = np.asarray(T, float)
    log_i = pnbd_log_integral(r, a, s, b, x, t, T)
    rc, ac, sc, bc = (v[:, None] for v in (r, a, s, b))
    alive = -(rc + x) * np.log(ac + T) - sc * np.log(bc + T)
    dead = np.log(sc) + log_i
    head = lgamma_ratio(r, x) + rc * np.log(ac) + sc * np.log(bc)
    return head + np.logaddexp(alive, dead)


def pnbd_p_alive(params: np.ndarray, x, t, T) -> np.ndarray:
    """P(alive at T), (K, n)."""
    r, a, s, b = (params[:, i] for i in range(4))
    log_i = pnbd_log_integral(r, a, s, b, x, t, T)
    rc, ac, sc, bc = (v[:, None] for v in (r, a, s, b))
    z = np.log(sc) + log_i + (rc + x) * np.log(ac + T) + sc * np.log(bc + T)
    return 1.0 / (1.0 + np.exp(z))


def pnbd_conditional_expectation(params: np.ndarray, x, t, T, horizon: float) -> np.ndarray:
    """Expected transactions in (T, T + horizon], (K, n)."""
    p_alive = pnbd_p_alive(params, x, t, T)
    r, a, s, b = (params[:, i][:, None] for i in range(4))
    bt = b + T
    if horizon <= 0:
        return np.zeros_like(p_alive)
    with np.errstate(divide="ignore", invalid="ignore"):
        general = (bt / (s - 1.0)) * (1.0 - (bt / (bt + horizon)) ** (s - 1.0))
    at_one = bt * np.log((bt + horizon) / bt)
    growth = np.where(np.abs(s - 1.0) < 1e-10, at_one, general)
    return p_alive * (r + x) / (a + T) * growth


def pnbd_dert(params: np.ndarray, x, t, T, delta: float) -> np.ndarray:
    """Discounted expected residual transactions at continuous rate ``delta``
    per time unit, (K, n)."""
    p_alive = pnbd_p_alive(params, x, t, T)
    r, a, s, b = (params[:, i][:, None, None] for i in range(4))
    bt = b + np.asarray(T, float)[None, :, None]
    upper = np.log1p(40.0 / (delta * bt))
    u = upper / 2.0 * (_Z[None, None, :] + 1.0)
    log_f = -delta * bt * np.expm1(u) - s * u + np.log(bt) + u
    integral = upper[..., 0] / 2.0 * np.sum(_W[None, None, :] * np.exp(log_f), axis=2)
    rate = (r[..., 0] + np.asarray(x, float)[None, :]) / (a[..., 0] + np.asarray(T, float)[None, :])
    return p_alive * rate * integral


def pnbd_unconditional_expectation(params: np.ndarray, t) -> np.ndarray:
    """E[X(t)] for a customer observed from time 0, (K, n)."""
    r, a, s, b = (params[:, i][:, None] for i in range(4))
    t = np.asarray(t, float)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        general = r * b / (a * (s - 1.0)) * (1.0 - (b / (b + t)) ** (s - 1.0))
    at_one = r * b / a * np.log1p(t / b)
    return np.where(np.abs(s - 1.0) < 1e-10, at_one, general)


def gg_loglik(params: np.ndarray, n, z) -> np.ndarray:
    """Gamma/Gamma per-customer log-likelihood, (K, n); rows are (p, q, g)."""
    p, q, g = (params[:, i] for i in range(3))
    n = np.asarray(n, float)
    z = np.asarray(z, float)
    pn = p[:, None] * n[None, :]
    uniq, inv = np.unique(n, return_inverse=True)
    pu = p[:, None] * uniq[None, :]
    lg_pnq = _lgamma(pu + q[:, None])[:, inv]
    lg_pn = _lgamma(pu)[:, inv]
    qc, gc = q[:, None], g[:, None]
    return (lg_pnq - lg_pn - _lgamma(q)[:, None] + qc * np.log(gc)
            + (pn - 1.0) * np.log(z) + pn * np.log(n) - (pn + qc) * np.log(gc + n * z))


def gg_density(params: np.ndarray, n, z) -> np.ndarray:
    """Density of the mean spend ``z`` given ``n`` transactions, (K, n)."""
    return np.exp(gg_loglik(params, n, z))
