"""A small logistic regression for bounded samples on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 30) -> np.ndarray:
    """Newton's method; weights with the intercept last, which is not penalised."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    w[-1] = logit(np.array([(y.sum() + 0.5) / (len(y) + 1)]))[0]
    penalty = np.full(len(w), l2)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        curve = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]
