"""A generative model of what voters say about an unknown label.

Every voter says 1, -1 or nothing (0) about a document. How often it says each
when the label is 1 or 0 (its accuracy) is estimated by expectation and
maximisation. A voter may be a label that people gave: it starts the estimate, sets the
prior, and is right far more often than not; the others are weighed against it.

Voters that echo each other would count twice. Correlations are taken within each
label, from what a voter says beyond its mean for that label, so that voters which only agree
because they are right are no echoes. Correlated voters form a group, whose
evidence is discounted by one factor, but never below that of its best voter alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# A correlation counts from here on, and so many standard deviations above chance. Before any
# row is seen it is taken for ASSUMED, with the weight of so many rows: few rows do not tell
# whether voters are independent.
LEAST_CORRELATION, DEVIATIONS = 0.2, 3.0
ASSUMED, ASSUMED_ROWS = 0.5, 10.0
# Rows of either label of which a given label is right before any is seen, and its least
# accuracy where the label is 1 and where it is 0.
TRUST, LEAST_TRUST = 10.0, (0.95, 0.995)


@dataclass(frozen=True)
class LabelModel:
    prior: float
    said: np.ndarray  # voter, label, vote + 1: probability
    weight: np.ndarray  # voter: the factor of its group
    correlation: np.ndarray  # voter, voter
    groups: list[list[int]]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability that the label is 1, per row of votes."""
        evidence = np.log(self.said[:, 1]) - np.log(self.said[:, 0])
        found = np.take_along_axis(evidence.T[None], votes[:, None, :] + 1, 1)[:, 0, :]
        odds = np.full(len(votes), np.log(self.prior) - np.log1p(-self.prior))
        for group in self.groups:
            mine = found[:, group]
            whole = mine.sum(axis=1)
            best = np.abs(mine).max(axis=1)
            least = np.minimum(best, np.abs(whole))
            odds += np.sign(whole) * np.maximum(self.weight[group[0]] * np.abs(whole), least)
        return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


def fit_label_model(
    votes: np.ndarray, given: int | None = None, rounds: int = 30, smooth: float = 1.0
) -> LabelModel:
    """Start from the voter ``given``, which says 1 or -1 of every row, or from the majority
    of votes, then alternate posteriors and estimates.

    Without rows every voter is uninformative.
    """
    if given is not None:
        given %= votes.shape[1]
        belief = (votes[:, given] > 0).astype(float)
        sides = belief
    else:
        told = votes.sum(axis=1)
        belief = np.where(told > 0, 0.9, np.where(told < 0, 0.02, 0.1))
        sides = None
    for _ in range(rounds):
        model = _estimate(votes, belief, sides, given, smooth)
        belief = model.posterior(votes)
    return model


def _estimate(votes, belief, sides, given, smooth) -> LabelModel:
    n, voters = votes.shape
    labels = belief if sides is None else sides
    prior = float((labels.sum() + smooth) / (n + 2 * smooth))
    said = np.empty((voters, 2, 3))
    for vote in (-1, 0, 1):
        hit = votes == vote
        said[:, 1, vote + 1] = belief @ hit + smooth
        said[:, 0, vote + 1] = (1 - belief) @ hit + smooth
    if given is not None:
        said[given, 1, 2] += TRUST
        said[given, 0, 0] += TRUST
    said /= said.sum(axis=2, keepdims=True)
    if given is not None:
        for label, right, least in ((1, 2, LEAST_TRUST[0]), (0, 0, LEAST_TRUST[1])):
            sure = max(least, said[given, label, right])
            said[given, label] *= (1 - sure) / max(1e-12, 1 - said[given, label, right])
            said[given, label, right] = sure
    correlation = _correlations(votes, labels)
    if given is not None:
        correlation[given] = correlation[:, given] = 0.0
    groups = _groups(correlation > 0)
    weight = np.ones(voters)
    for group in groups:
        if len(group) > 1:
            inside = correlation[np.ix_(group, group)].sum() / (len(group) * (len(group) - 1))
            weight[group] = 1 / (1 + inside * (len(group) - 1))
    return LabelModel(prior, said, weight, correlation, groups)


def _correlations(votes: np.ndarray, belief: np.ndarray) -> np.ndarray:
    """The higher one of both labels, 0 where it is not beyond chance."""
    out = np.zeros((votes.shape[1],) * 2)
    for share in (belief, 1 - belief):
        rows = max(1.0, share.sum())
        off = votes - (share @ votes) / rows
        both = (off * share[:, None]).T @ off
        scale = np.sqrt(np.diag(both))
        scale[scale < 1e-9 * max(1.0, rows)] = np.inf  # says the same of all
        found = both / np.outer(scale, scale)
        # a few rows that two voters share by chance correlate them
        found[found < max(LEAST_CORRELATION, DEVIATIONS / np.sqrt(rows))] = 0.0
        out = np.maximum(out, (rows * found + ASSUMED_ROWS * ASSUMED) / (rows + ASSUMED_ROWS))
    out[out < LEAST_CORRELATION] = 0.0
    np.fill_diagonal(out, 0.0)
    return np.minimum(out, 1.0)


def _groups(linked: np.ndarray) -> list[list[int]]:
    left, groups = set(range(len(linked))), []
    while left:
        group, new = set(), {min(left)}
        while new:
            group |= new
            new = {int(k) for v in new for k in np.flatnonzero(linked[v])} - group
        left -= group
        groups.append(sorted(group))
    return groups
