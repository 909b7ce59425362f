"""Logistic regression on a bounded sample: Newton steps with a small ridge penalty."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEPS = 40


@dataclass
class Logistic:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def margin(self, rows: np.ndarray) -> np.ndarray:
        inside = np.clip((rows - self.center) / self.scale, -20, 20)
        return inside @ self.weights[1:] + self.weights[0]

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def fit_logistic(
    rows: np.ndarray, y: np.ndarray, ridge: float = 1.0, weight: np.ndarray | None = None
) -> Logistic:
    """``y`` holds 0, 1 or probabilities; ``weight`` is per row."""
    center, scale = rows.mean(axis=0), rows.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = np.hstack([np.ones((len(rows), 1)), np.clip((rows - center) / scale, -20, 20)])
    weight = np.ones(len(rows)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(x.shape[1])

    def loss(v):
        z = x @ v
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penalty * v * v).sum()

    now = loss(w)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(penalty)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-9 * (1 + abs(now)):
            break
    return Logistic(center, scale, w)
