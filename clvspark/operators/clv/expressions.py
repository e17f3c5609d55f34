"""Pareto/NBD scores as Spark column expressions (V5): no Python worker touches a customer.

With M and m the larger and smaller of alpha and beta, p the exponent of the
smaller one's factor (s + 1 or r + x) and q the other's, the integral of the
likelihood has the primitive ``-(M+y)^-q (m+y)^(1-p) H(y) / (r+s+x)``, where
H(y) = 2F1(1, q; p+q; (M-m)/(M+y)) (Fader, Hardie 2005, after Euler's
transformation). Divided by the likelihood of being alive at T, nothing but
ratios of powers is left, and P(alive) = 1 / (1 + s / (r+s+x) * (g_t H(t) - g_T H(T))).

H is Gauss's continued fraction, evaluated from its end. Its convergents
come closer by (1-w)/(1+w) each, w = sqrt(1 - z), and z is largest at y = 0,
so their number follows from alpha and beta alone. Where these differ by a
factor over ten thousand it would grow without bound: it then follows from z
row by row, and rows with t near 0 take the integral by Gauss-Legendre
quadrature on a log scale instead.

DERT needs Tricomi's U(1, 2-s, delta (beta+T)), by the same quadrature of its
integral form. It depends on T alone, so it is a table over the calendar.

Defined results: a null in x, t or T gives null; t = T gives P(alive) = 1.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from clvspark.operators.clv.kernels import QUAD_NODES

LEAST_GAP = 1e-4     # 1 - z below which quadrature takes over: at most 1,860 convergents above it
_Z, _W = np.polynomial.legendre.leggauss(QUAD_NODES)


def _let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _nodes() -> Column:
    """The quadrature's nodes and weights, as one literal array of structs."""
    return F.arrays_zip(F.lit([float(z) for z in _Z]).alias("z"), F.lit([float(w) for w in _W]).alias("w"))


def _quadrature(lo, hi, log_f) -> Column:
    """Integral of exp(log_f(v)) for v from ``lo`` to ``hi``; 0 where they meet."""
    half, middle = (hi - lo) / 2.0, (hi + lo) / 2.0
    return half * F.aggregate(_nodes(), F.lit(0.0),
                              lambda total, n: total + n["w"] * F.exp(log_f(half * n["z"] + middle)))


def half_steps(gap: float) -> int:
    """Convergents that bring 2F1(1, q; p + q; z) to double precision for every 1 - z >= ``gap``."""
    w = math.sqrt(gap)
    return 2 if w == 1.0 else math.ceil(37.0 / math.log((1.0 + w) / (1.0 - w))) + 2


def hypergeometric_one(q: Column, p: Column, z: Column, count: int | None = None) -> Column:
    """2F1(1, q; p + q; z) for q, p > 0 and 0 <= z < 1, by Gauss's continued fraction.

    With ``count`` convergents, or as many as z needs. An aggregate over the
    step numbers: written out as one expression they outgrow what the JVM
    compiles, and run slower.
    """
    def tail(c: Column, q: Column, z: Column) -> Column:
        if count is None:
            steps = F.ceil(37.0 / 4.0 / F.sqrt(1.0 - z)).cast("int") + 4
            numbers = F.transform(F.sequence(steps, F.lit(1), F.lit(-1)), lambda n: n.cast("double"))
        else:
            steps = F.lit((count + 1) // 2)
            numbers = F.lit([float(n) for n in range((count + 1) // 2, 0, -1)])

        def step(inner: Column, n: Column) -> Column:
            odd = c + (n + (n - 1.0)) - (q + n) * (c + (n - 1.0)) * z / inner
            return c + (n + (n - 2.0)) - n * (c - q + (n - 1.0)) * z / odd

        return F.aggregate(numbers, (c + 2.0 * steps) * (1.0 + F.sqrt(1.0 - z)) / 2.0, step)

    # the values that each step uses are computed once
    return _let(F.struct((p + q).alias("c"), q.cast("double").alias("q"), z.alias("z")), lambda v: _let(
        v["c"], lambda c: _let(v["q"], lambda q: _let(v["z"], lambda z: 1.0 / (1.0 - q * z / tail(c, q, z))))))


def p_alive(params, x: Column, t: Column, T: Column) -> Column:
    """P(alive at T) for ``params`` = (r, alpha, s, beta)."""
    r, a, s, b = map(float, params)
    big, small = max(a, b), min(a, b)
    x, t, T = x.cast("double"), t.cast("double"), T.cast("double")
    later_first = a >= b
    p, q = (F.lit(s + 1.0), r + x) if later_first else (r + x, F.lit(s + 1.0))

    def log_ratio(y: Column) -> Column:
        """ln of the likelihood of being alive at y over that at T."""
        return (r + x) * F.log((a + T) / (a + y)) + s * F.log((b + T) / (b + y))

    near = small / big >= LEAST_GAP
    count = half_steps(small / big) if near else None

    def part(y: Column) -> Column:
        factor = F.lit(1.0) if later_first else (a + y) / (b + y)
        return F.exp(log_ratio(y)) * factor * hypergeometric_one(q, p, (big - small) / (big + y), count)

    odds = s / (r + s + x) * (part(t) - part(T))
    if not near:
        # s (b+y)^-1 over the likelihood at T, with y = e^v - small
        by_quadrature = _quadrature(F.log(t + small), F.log(T + small), lambda v: _let(
            F.exp(v) - small, lambda y: v + log_ratio(y) + F.lit(math.log(s)) - F.log(b + y)))
        odds = F.when((small + t) / (big + t) >= LEAST_GAP, odds).otherwise(by_quadrature)
    alive = 1.0 / (1.0 + F.greatest(odds, F.lit(0.0)))
    return F.when(x.isNotNull() & (t >= T), F.lit(1.0)).when(x.isNotNull() & (t < T), alive)


def expected_transactions(params, alive: Column, x: Column, T: Column, horizon: Column) -> Column:
    """Expected transactions in (T, T + horizon], given P(alive); 0 for an empty horizon."""
    r, a, s, b = map(float, params)
    bt = b + T.cast("double")
    if abs(s - 1.0) < 1e-10:
        growth = bt * F.log1p(horizon / bt)
    else:
        growth = bt / (s - 1.0) * (1.0 - F.pow(bt / (bt + horizon), F.lit(s - 1.0)))
    return F.when(horizon <= 0, F.lit(0.0)).otherwise(alive * (r + x) / (a + T) * growth)


def discounted_lifetime(params, T: Column, delta: float) -> Column:
    """Expected discounted lifetime after T of a customer alive then, at the continuous rate ``delta`` per time unit."""
    s, b = float(params[2]), float(params[3])
    bt = b + T.cast("double")
    # y = bt (e^u - 1); the discount is below e^-40 past the upper end
    return _quadrature(F.lit(0.0), F.log1p(40.0 / (delta * bt)),
                       lambda u: -delta * bt * F.expm1(u) - s * u + F.log(bt) + u)


def discounted_residual(params, alive: Column, x: Column, T: Column, lifetime: Column) -> Column:
    """Discounted expected residual transactions, given P(alive) and ``discounted_lifetime``."""
    return alive * (float(params[0]) + x) / (float(params[1]) + T) * lifetime
