"""What the small numpy networks share: Adam, and stable softmax."""

from __future__ import annotations

import numpy as np


class Adam:
    """Adam over a dictionary of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        clip = min(1.0, 1.0 / (size + 1e-9))  # no step follows a gradient longer than 1
        fix = np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in grads.items():
            g = g * clip
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.weights[k] -= (self.rate * fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(self.weights[k].dtype)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))
