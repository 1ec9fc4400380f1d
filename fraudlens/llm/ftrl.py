"""Follow the regularised leader, for sparse linear models."""

from __future__ import annotations

import numpy as np


class Leader:
    """Weights of ``features`` rows and ``outputs`` columns under elastic-net penalties."""

    def __init__(self, features: int, outputs: int, rate: float, l1: float, l2: float):
        self.rate, self.l1, self.l2 = rate, l1, l2
        self.pull = np.zeros((features, outputs))
        self.squares = np.zeros((features, outputs))

    def weights(self, at=slice(None)) -> np.ndarray:
        pull = self.pull[at]
        beyond = np.sign(pull) * np.maximum(np.abs(pull) - self.l1, 0)
        return -beyond / ((1 + np.sqrt(self.squares[at])) / self.rate + self.l2)

    def learn(self, at: np.ndarray, slope: np.ndarray, weights: np.ndarray) -> None:
        """``slope`` is the loss's gradient at the ``weights`` of the features ``at``."""
        before = self.squares[at]
        after = before + slope**2
        self.pull[at] += slope - (np.sqrt(after) - np.sqrt(before)) / self.rate * weights
        self.squares[at] = after
