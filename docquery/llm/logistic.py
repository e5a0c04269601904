"""A small logistic regression for a handful of features."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Coefficients, the constant last, by Newton's method; the constant is not penalized."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge * weight.sum() / max(len(x), 1))
    penalty[-1] = 1e-9
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-6)
        step = np.linalg.solve(curvature, gradient)
        size = np.abs(step).max()
        w -= step if size < 5 else step * (5 / size)
        if size < 1e-8:
            break
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def class_weights(y: np.ndarray, shares: dict[int, int]) -> np.ndarray:
    """Weights that give the classes of a sample the shares they have among all labelled rows, mean 1."""
    total = sum(shares.values()) or 1
    out = np.ones(len(y))
    for value, count in shares.items():
        own = y == value
        if own.any():
            out[own] = (count / total) * len(y) / own.sum()
    return out
