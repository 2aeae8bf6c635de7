"""Logistic regression on sparse vectors, trained by following the regularised leader."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Example = tuple[np.ndarray, np.ndarray]  # distinct places, their values


def train(
    examples: Sequence[Example],
    targets: np.ndarray,
    size: int,
    alpha: float = 0.1,
    beta: float = 1.0,
    l1: float = 1.0,
    l2: float = 1.0,
    rounds: int = 4,
    seed: int = 7,
) -> np.ndarray:
    """The weights, the intercept last. Targets lie between 0 and 1.

    Each coordinate has a step of its own, ``alpha / (beta + sqrt(sum of squared
    gradients))``; a coordinate whose sum of gradients stays within ``l1`` has weight 0.
    The intercept is not penalised.
    """
    pull = np.zeros(size + 1)
    squares = np.zeros(size + 1)
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for at in order.permutation(len(examples)).tolist():
            places, values = examples[at]
            places, values = np.append(places, size), np.append(values, 1.0)
            weights = _weights(pull[places], squares[places], alpha, beta, l1, l2)
            weights[-1] = _weights(pull[size:], squares[size:], alpha, beta, 0.0, 0.0)[0]
            gradient = (sigmoid(weights @ values) - targets[at]) * values
            grown = squares[places] + gradient**2
            step = (np.sqrt(grown) - np.sqrt(squares[places])) / alpha
            pull[places] += gradient - step * weights
            squares[places] = grown
    weights = _weights(pull, squares, alpha, beta, l1, l2)
    weights[size] = _weights(pull[size:], squares[size:], alpha, beta, 0.0, 0.0)[0]
    return weights


def _weights(pull, squares, alpha, beta, l1, l2) -> np.ndarray:
    kept = np.sign(pull) * np.maximum(np.abs(pull) - l1, 0.0)
    return -kept / ((beta + np.sqrt(squares)) / alpha + l2)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))
