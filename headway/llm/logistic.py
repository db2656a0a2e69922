"""A small logistic regression for models fitted on a bounded sample."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Logistic:
    """Ridge logistic regression by Newton steps; features are standardised within."""

    def __init__(self, ridge: float = 1.0, steps: int = 30):
        self.ridge, self.steps = ridge, steps

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Logistic:
        """Without rows of both classes every score is the mean of ``y``, or 0.5 without rows."""
        n, k = x.shape
        self.mean = x.mean(0) if n else np.zeros(k)
        self.scale = np.maximum(x.std(0) if n else np.ones(k), 1e-6)
        self.beta = np.zeros(k + 1)
        weight = np.ones(n) if weight is None else weight
        rate = np.clip(np.average(y, weights=weight) if n else 0.5, 1e-4, 1 - 1e-4)
        self.beta[0] = np.log(rate / (1 - rate))
        if n and 0 < y.sum() < n:
            z = self._design(x)
            penalty = np.diag([1e-6] + [self.ridge] * k)
            for _ in range(self.steps):
                p = sigmoid(z @ self.beta)
                gradient = z.T @ (weight * (y - p)) - penalty @ self.beta
                hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + penalty
                step = np.linalg.solve(hessian, gradient)
                self.beta += step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
                if np.abs(step).max() < 1e-6:
                    break
        return self

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(x), 1)), np.clip((x - self.mean) / self.scale, -8, 8)])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._design(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x))
