"""A linear support vector machine (squared hinge loss, accelerated gradient) and a logistic calibration, for bounded training samples."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, rounds: int = 80) -> tuple[np.ndarray, float]:
    """w, b with least ridge/2 |w|^2 + mean of weighted max(0, 1 - y (x w + b))^2; y: 1 or -1. weight: balances the classes by default."""
    if weight is None:
        weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    weight, y = (weight / weight.sum()).astype(x.dtype), y.astype(x.dtype)
    # The bias is a column of ones that is never written down: x may be most of the driver's memory.
    v, c, norm = np.ones(x.shape[1], x.dtype), 1.0, 1.0
    for _ in range(20):
        m = weight * (x @ v + x.dtype.type(c))
        v, c = x.T @ m, float(m.sum())
        norm = float(np.sqrt(v @ v + c * c)) or 1.0
        v, c = v / x.dtype.type(norm), c / norm
    step = 1 / (2 * norm * 1.1 + ridge)
    w = last = np.zeros(x.shape[1], x.dtype)
    b = old = 0.0
    for k in range(rounds):
        go = k / (k + 3)
        at, at_b = w + x.dtype.type(go) * (w - last), b + go * (b - old)
        pull = weight * y * np.maximum(0, 1 - y * (x @ at + x.dtype.type(at_b)))
        last, old = w, b
        w = at - x.dtype.type(step) * (x.dtype.type(ridge) * at - 2 * (x.T @ pull))
        b = at_b - step * (ridge * 1e-2 * at_b - 2 * float(pull.sum()))
    return w, b


def calibrate(f: np.ndarray, y: np.ndarray) -> np.ndarray:
    """w so that 1 / (1 + exp(-(f, 1) w)) is the chance of y = 1 for rows f; targets are drawn in a little, so separable data have a finite answer."""
    hi, lo = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (hi + 1) / (hi + 2), 1 / (lo + 2))
    x = np.column_stack((f, np.ones(len(f))))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - t) + 1e-3 * w)
        w = w - step * min(1.0, 3 / (np.abs(step).max() + 1e-12))
    return w
