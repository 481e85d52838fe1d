"""Logistic calibration of a few features, fitted on the driver from a bounded sample."""

from __future__ import annotations

import numpy as np


class Logistic:
    def __init__(self, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.weights, self.mean, self.scale = weights, mean, scale

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> Logistic:
        """Newton's method with a small penalty, which keeps separable classes finite."""
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale == 0] = 1
        a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
        w = np.zeros(a.shape[1])
        ridge = np.full(len(w), penalty)
        ridge[0] = 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(ridge), a.T @ (y - p) - ridge * w)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        return cls(w, mean, scale)

    def score(self, x: np.ndarray) -> np.ndarray:
        a = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        return 1 / (1 + np.exp(-np.clip(a @ self.weights, -30, 30)))
