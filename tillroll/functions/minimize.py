"""Minimising a function that is cheap to evaluate at many points at once, with or without its derivatives."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def newton_batched(
    values_at: Callable[[np.ndarray], np.ndarray],
    start: np.ndarray,
    steps: int = 60,
    tolerance: float = 1e-8,
    h: float = 1e-4,
) -> np.ndarray:
    """Damped Newton search; ``values_at`` maps an (n, d) array of points to n values.

    Every step costs two calls: one for all points of the finite-difference
    gradient and Hessian, one for all step lengths tried along the direction.
    With ``values_at`` a Spark aggregation, that is two jobs per step.  Raises
    where no step length gains though the gradient isn't flat, and when
    ``steps`` don't suffice.
    """
    x = np.asarray(start, dtype=float)
    d = len(x)
    eye = np.eye(d) * h
    upper = [(i, j) for i in range(d) for j in range(i + 1, d)]
    lengths = np.array([4.0, 2.0, 1.0, 0.5, 0.25, 0.1, 0.03, 0.01])
    for _ in range(steps):
        stencil = [x, *(x + eye), *(x - eye)]
        for i, j in upper:
            stencil += [x + eye[i] + eye[j], x - eye[i] - eye[j]]
        f = values_at(np.array(stencil))
        f0, fp, fm = f[0], f[1 : d + 1], f[d + 1 : 2 * d + 1]
        gradient = (fp - fm) / (2 * h)
        hessian = np.diag((fp - 2 * f0 + fm) / h**2)
        for n, (i, j) in enumerate(upper):
            pp, mm = f[2 * d + 1 + 2 * n], f[2 * d + 2 + 2 * n]
            hessian[i, j] = hessian[j, i] = (pp + mm - fp[i] - fm[i] - fp[j] - fm[j] + 2 * f0) / (2 * h**2)
        w, v = np.linalg.eigh(hessian)
        w = np.maximum(np.abs(w), 1e-5)
        direction = -v @ ((v.T @ gradient) / w)
        reach = np.linalg.norm(direction)
        if reach > 2.0:
            direction *= 2.0 / reach
        tried = values_at(x + lengths[:, None] * direction)
        best = int(np.nanargmin(tried))
        gain = f0 - tried[best]
        if not gain > 0:
            if np.abs(gradient).max() > 1e-4 * max(1.0, abs(f0)):
                raise ArithmeticError(f"no step gains at {x}, where the gradient is {gradient}")
            return x
        x = x + lengths[best] * direction
        if gain < tolerance * max(1.0, abs(f0)):
            return x
    raise ArithmeticError(f"the search has not converged after {steps} steps, at {x}")


#: Step lengths tried along a direction, all in one call.
LENGTHS = np.array([1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 2.0, 4.0])


def newton(
    derivatives_at: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    start: np.ndarray,
    steps: int = 60,
    tolerance: float = 1e-8,
) -> np.ndarray:
    """Damped Newton search.

    ``derivatives_at`` maps an (n, d) array of points to n values, (n, d) gradients and (n, d, d) Hessians.  Every step
    costs one call, for all step lengths tried: where the best of them lies, the next direction is already known.  With
    a Spark aggregation behind it, that is one job per step.  Raises where no step length gains though the gradient
    isn't flat, and when ``steps`` don't suffice.
    """
    x = np.asarray(start, dtype=float)
    value, gradient, hessian = (part[0] for part in derivatives_at(x[None, :]))
    for _ in range(steps):
        w, v = np.linalg.eigh(hessian)
        w = np.maximum(np.abs(w), 1e-5)
        direction = -v @ ((v.T @ gradient) / w)
        reach = np.linalg.norm(direction)
        if reach > 2.0:
            direction *= 2.0 / reach
        points = x + LENGTHS[:, None] * direction
        values, gradients, hessians = derivatives_at(points)
        best = int(np.nanargmin(values))
        gain = value - values[best]
        if not gain > 0:
            if np.abs(gradient).max() > 1e-4 * max(1.0, abs(value)):
                raise ArithmeticError(f"no step gains at {x}, where the gradient is {gradient}")
            return x
        x, value, gradient, hessian = points[best], values[best], gradients[best], hessians[best]
        if gain < tolerance * max(1.0, abs(value)):
            return x
    raise ArithmeticError(f"the search has not converged after {steps} steps, at {x}")
