"""Small numpy pieces that the learned operators share."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Adam:
    """Adam steps over a dictionary of arrays, changed in place."""

    def __init__(self, values: dict[str, np.ndarray], rate: float):
        self.values, self.rate, self.steps = values, rate, 0
        self.mean = {name: np.zeros_like(value) for name, value in values.items()}
        self.square = {name: np.zeros_like(value) for name, value in values.items()}

    def step(self, slopes: dict[str, np.ndarray]) -> None:
        self.steps += 1
        size = np.sqrt(sum(float((slope * slope).sum()) for slope in slopes.values()))
        scale = min(1.0, 5.0 / (size + 1e-12))
        for name, slope in slopes.items():
            slope = slope * scale
            self.mean[name] += 0.1 * (slope - self.mean[name])
            self.square[name] += 0.001 * (slope * slope - self.square[name])
            mean = self.mean[name] / (1 - 0.9**self.steps)
            square = self.square[name] / (1 - 0.999**self.steps)
            self.values[name] -= (self.rate * mean / (np.sqrt(square) + 1e-8)).astype(self.values[name].dtype)


class CharClasses:
    """Characters as small class numbers; 0 is padding, 1 everything not listed."""

    def __init__(self, groups: tuple[str, ...]):
        self.count = len(groups) + 3
        self.table = np.ones(256, np.uint8)
        for number, group in enumerate(groups, 2):
            for letter in group:
                self.table[ord(letter)] = number
        self.beyond = len(groups) + 2  # code points beyond the table: letters of other scripts

    def of(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.where(points < 256, self.table[np.minimum(points, 255)], self.beyond).astype(np.uint8)
