"""Quasi-Newton maximisation where every step costs one batched evaluation.

The objective ``f(X) -> values`` takes a (K, d) matrix of parameter vectors
and returns K values; in the fits each call is one Spark pass over the
customer statistics. Per iteration there are two calls: the value and a
central finite-difference gradient (2d + 1 vectors), then a line search that
tries several step lengths at once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

STEPS = np.array([1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001])


@dataclass(frozen=True)
class OptimResult:
    x: np.ndarray
    value: float
    iterations: int
    evaluations: int
    converged: bool          # gradient below tolerance, and no parameter on the box
    message: str
    at_bound: bool = False   # some log-parameter stands on the box


def _gradient_points(x: np.ndarray, h: float) -> np.ndarray:
    d = x.size
    pts = [x]
    for i in range(d):
        e = np.zeros(d)
        e[i] = h
        pts.append(x + e)
        pts.append(x - e)
    return np.array(pts)


def maximize(f: Callable[[np.ndarray], np.ndarray], x0, bound: float = 12.0,
             h: float = 1e-5, max_iter: int = 200, gtol: float = 1e-6,
             ftol: float = 1e-12) -> OptimResult:
    """Maximise ``f`` over a box ``|x_i| <= bound`` (log-parameters)."""
    x = np.clip(np.asarray(x0, float), -bound, bound)
    d = x.size
    hess_inv = np.eye(d)
    evals = 0
    prev_grad = None
    prev_x = None
    value = None

    def result(x, value, it, converged, message):
        on_box = bool((np.abs(x) >= bound).any())
        return OptimResult(x, float(value), it, evals, bool(converged and not on_box), message, on_box)

    for it in range(1, max_iter + 1):
        vals = f(_gradient_points(x, h))
        evals += 1
        value = float(vals[0])
        if not np.isfinite(value):
            return result(x, value, it, False, "non-finite objective")
        grad = np.array([(vals[1 + 2 * i] - vals[2 + 2 * i]) / (2 * h) for i in range(d)])
        # ignore gradient pushing outward on an active bound
        at_bound = ((x >= bound) & (grad > 0)) | ((x <= -bound) & (grad < 0))
        free_grad = np.where(at_bound, 0.0, grad)
        if np.max(np.abs(free_grad)) <= gtol * max(1.0, abs(value)):
            return result(x, value, it, True, "gradient below tolerance")
        if prev_grad is not None:
            s = x - prev_x
            y = -(grad - prev_grad)          # minimise -f
            sy = float(s @ y)
            if sy > 1e-12:
                rho = 1.0 / sy
                eye = np.eye(d)
                hess_inv = ((eye - rho * np.outer(s, y)) @ hess_inv @ (eye - rho * np.outer(y, s))
                            + rho * np.outer(s, s))
            else:
                hess_inv = np.eye(d)
        direction = hess_inv @ free_grad      # ascent direction of f
        if float(direction @ free_grad) <= 0:
            hess_inv = np.eye(d)
            direction = free_grad
        scale = np.max(np.abs(direction))
        if scale > 5.0:                      # at most 5 units of log-parameter per step
            direction = direction * (5.0 / scale)
        cands = np.clip(x[None, :] + STEPS[:, None] * direction[None, :], -bound, bound)
        cvals = f(cands)
        evals += 1
        ok = np.where(np.isfinite(cvals) & (cvals > value + 1e-4 * STEPS * (direction @ free_grad)))[0]
        if ok.size == 0:
            better = np.where(np.isfinite(cvals) & (cvals > value))[0]
            if better.size == 0:
                return result(x, value, it, False, "no ascent along the search direction")
            ok = better
        best = ok[np.argmax(cvals[ok])]
        prev_x, prev_grad = x, grad
        new_value = float(cvals[best])
        x = cands[best]
        if abs(new_value - value) <= ftol * max(1.0, abs(value)):
            small = np.max(np.abs(free_grad)) <= gtol * max(1.0, abs(value))
            return result(x, new_value, it, small, "relative change below tolerance")
    return result(x, value, max_iter, False, "iteration limit")


def hessian_points(x: np.ndarray, h: float) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """Points for a central finite-difference Hessian, and the function that
    turns their values into the (d, d) matrix. One batched evaluation."""
    d = x.size
    pts = [x.copy()]
    for i in range(d):
        for sgn in (1, -1):
            p = x.copy()
            p[i] += sgn * h
            pts.append(p)
    pairs = [(i, j) for i in range(d) for j in range(i + 1, d)]
    for i, j in pairs:
        for si, sj in ((1, 1), (1, -1), (-1, 1), (-1, -1)):
            p = x.copy()
            p[i] += si * h
            p[j] += sj * h
            pts.append(p)

    def assemble(v: np.ndarray) -> np.ndarray:
        f0 = v[0]
        hm = np.zeros((d, d))
        for i in range(d):
            hm[i, i] = (v[1 + 2 * i] - 2 * f0 + v[2 + 2 * i]) / h ** 2
        base = 1 + 2 * d
        for k, (i, j) in enumerate(pairs):
            fpp, fpm, fmp, fmm = v[base + 4 * k: base + 4 * k + 4]
            hm[i, j] = hm[j, i] = (fpp - fpm - fmp + fmm) / (4 * h ** 2)
        return hm

    return np.array(pts), assemble


def unpacked(sums: np.ndarray, size: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Value, gradient and Hessian from (value, gradient, upper triangle)."""
    hessian = np.zeros((size, size))
    hessian[np.triu_indices(size)] = sums[1 + size:]
    return float(sums[0]), sums[1:1 + size], hessian + np.triu(hessian, 1).T


def maximize_newton(derivatives, x0: np.ndarray, radius: float = 1.0, bound: float = 12.0, tol: float = 1e-9,
                    max_iter: int = 100) -> OptimResult:
    """Maximum of f by Newton steps within a trust region; ``derivatives(x)`` is (f, gradient, Hessian).

    A step maximises the quadratic model within ``radius``; the radius grows
    after good predictions and shrinks after bad ones, and a step that does
    not raise f is not taken. x stays in the box ``|x| <= bound``; on its
    faces a gradient that points outwards does not count. Converged: the
    largest free gradient entry is at most ``tol * (1 + |f|)``, away from the box.
    """
    x = np.clip(np.asarray(x0, float), -bound, bound)
    value, gradient, hessian = derivatives(x)
    evaluations, message, idle = 1, "iteration limit", 0

    def free_of(x, gradient):
        return ~(((x >= bound) & (gradient > 0)) | ((x <= -bound) & (gradient < 0)))

    iterations = 0
    for iterations in range(1, max_iter + 1):
        free = free_of(x, gradient)
        if not free.any() or np.abs(gradient[free]).max() <= tol * (1 + abs(value)):
            message = "gradient is small"
            break
        step = np.zeros_like(x)
        step[free] = _within(hessian[np.ix_(free, free)], gradient[free], radius)
        new = np.clip(x + step, -bound, bound)
        step = new - x
        predicted = gradient @ step + step @ hessian @ step / 2
        found = derivatives(new)
        evaluations += 1
        gained = found[0] - value
        if np.isfinite(found[0]) and gained > 0:
            x, (value, gradient, hessian) = new, found
        good = gained / predicted if predicted > 0 and np.isfinite(gained) else -1.0
        if good < 0.25:
            radius = 0.25 * float(np.linalg.norm(step)) if np.linalg.norm(step) > 0 else radius / 4
        elif good > 0.75:
            radius = min(4.0, max(radius, 2 * float(np.linalg.norm(step))))
        idle = idle + 1 if abs(gained) <= 1e-10 * (1 + abs(value)) else 0
        if radius < 1e-10 or idle >= 4:   # a flat ridge: converged only if the gradient says so
            message = "no further gain"
            break
    free = free_of(x, gradient)
    at_bound = bool((np.abs(x) >= bound - 1e-9).any())
    small = bool(not free.any() or np.abs(gradient[free]).max() <= max(tol, 1e-8) * (1 + abs(value)))
    return OptimResult(x=x, value=value, converged=small and not at_bound, iterations=iterations, evaluations=evaluations,
                       message=message, at_bound=at_bound)


def _within(hessian: np.ndarray, gradient: np.ndarray, radius: float) -> np.ndarray:
    """The step of length ``radius`` at most that maximises the quadratic model: (-H + shift) step = gradient."""
    values, vectors = np.linalg.eigh(-hessian)
    turned = vectors.T @ gradient

    def step(shift: float) -> np.ndarray:
        return vectors @ (turned / (values + shift))

    if values[0] > 0 and np.linalg.norm(step(0.0)) <= radius:
        return step(0.0)
    low, high = max(0.0, -values[0]), max(0.0, -values[0]) + np.linalg.norm(gradient) / radius + 1e-12
    for _ in range(100):
        middle = (low + high) / 2
        if np.linalg.norm(step(middle + 1e-300)) > radius:
            low = middle
        else:
            high = middle
    return step(high)
