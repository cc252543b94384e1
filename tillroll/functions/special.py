"""Vectorised special functions for the lifetime-value models."""

from __future__ import annotations

import numpy as np


def log_gamma(z: np.ndarray) -> np.ndarray:
    """ln Gamma(z) for z > 0: Stirling's series after a shift by eight."""
    z = np.asarray(z, dtype=float)
    shift = np.zeros_like(z)
    for k in range(8):
        shift += np.log(z + k)
    y = z + 8.0
    inv = 1.0 / y
    inv2 = inv * inv
    series = inv * (1 / 12 - inv2 * (1 / 360 - inv2 * (1 / 1260 - inv2 * (1 / 1680 - inv2 / 1188))))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def digamma(z: np.ndarray) -> np.ndarray:
    """The derivative of log_gamma for z > 0, by its asymptotic series after a shift by eight."""
    z = np.asarray(z, dtype=float)
    shift = sum(1.0 / (z + k) for k in range(8))
    y = z + 8.0
    inv2 = 1.0 / (y * y)
    series = inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
    return np.log(y) - 0.5 / y - series - shift


def trigamma(z: np.ndarray) -> np.ndarray:
    """The second derivative of log_gamma for z > 0, likewise."""
    z = np.asarray(z, dtype=float)
    shift = sum(1.0 / (z + k) ** 2 for k in range(8))
    y = z + 8.0
    inv = 1.0 / y
    inv2 = inv * inv
    series = inv2 * (1 / 6 - inv2 * (1 / 30 - inv2 * (1 / 42 - inv2 * (1 / 30 - inv2 * 5 / 66))))
    return inv * (1 + 0.5 * inv + series) + shift


def scaled_hypergeometric(
    a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray, terms: int = 5_000_000, tolerance: float = 1e-15
) -> np.ndarray:
    """c * 2F1(a, b; c; z) for c > -1 and 0 <= z < 1, by its series with the factor c folded in.

    Unlike 2F1 it is finite at c = 0.  Raises where the series hasn't settled after ``terms`` terms.
    """
    a, b, c, z = (v.ravel() for v in np.broadcast_arrays(*[np.asarray(v, dtype=float) for v in (a, b, c, z)]))
    total, term = c.copy(), a * b * z
    total += term
    live = np.arange(a.size)
    for k in range(1, terms):
        ratio = (a[live] + k) * (b[live] + k) / ((c[live] + k) * (k + 1.0)) * z[live]
        term[live] *= ratio
        total[live] += term[live]
        live = live[(np.abs(term[live]) > tolerance * np.abs(total[live])) | (np.abs(ratio) >= 1.0)]
        if not len(live):
            return total
    raise ArithmeticError(f"2F1 has not converged after {terms} terms for {len(live)} arguments")
