"""Weak supervision on counted vote patterns: expectation-maximisation without labels."""

from __future__ import annotations

import math

Patterns = list[tuple[tuple[int, ...], int]]


def fit(patterns: Patterns, yes: tuple[float, float, float], no: tuple[float, float, float], prior: float, rounds: int = 200) -> tuple[float, list[dict[int, float]]]:
    """(prior log odds, per voter the log odds that each of its votes -1, 0, 1 adds).

    yes, no: starting rates of the votes -1, 0, 1 in either class. They also count as a few observations,
    which keeps rates off 0 and 1 and the classes from changing places. A vote for never lowers the
    odds, a vote against never raises them, and an abstention says nothing.
    """
    if not patterns:
        return math.log(prior / (1 - prior)), []
    voters = range(len(patterns[0][0]))
    pseudo = {c: [20 * r for r in rates] for c, rates in ((1, yes), (0, no))}
    rate = {c: [list(rates) for _ in voters] for c, rates in ((1, yes), (0, no))}
    share = prior
    total = sum(n for _, n in patterns)
    for _ in range(rounds):
        tally = {c: [list(pseudo[c]) for _ in voters] for c in (0, 1)}
        held = 0.0
        for votes, n in patterns:
            good = posterior(votes, share, rate) * n
            held += good
            for v in voters:
                tally[1][v][votes[v] + 1] += good
                tally[0][v][votes[v] + 1] += n - good
        change = 0.0
        for c in (0, 1):
            for v in voters:
                size = sum(tally[c][v])
                new = [x / size for x in tally[c][v]]
                change = max(change, *[abs(x - y) for x, y in zip(new, rate[c][v])])
                rate[c][v] = new
        share = (held + 10 * prior) / (total + 10)
        if change < 1e-7:
            break
    weights = []
    for v in voters:
        against, _, vote_for = [math.log(rate[1][v][k] / rate[0][v][k]) for k in range(3)]
        weights.append({-1: min(against, 0.0), 0: 0.0, 1: max(vote_for, 0.0)})
    return math.log(share / (1 - share)), weights


def posterior(votes: tuple[int, ...], share: float, rate: dict[int, list[list[float]]]) -> float:
    odds = math.log(share / (1 - share)) + sum(math.log(rate[1][v][x + 1] / rate[0][v][x + 1]) for v, x in enumerate(votes))
    return sigmoid(odds)


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def logistic(rows: list[tuple[tuple[int, ...], float, int]], rounds: int = 400, rate: float = 1.0, ridge: float = 1e-3) -> tuple[float, list[float]]:
    """(bias, weight per feature) of a logistic regression on counted 0/1 features with soft labels."""
    if not rows:
        return 0.0, []
    size = len(rows[0][0])
    bias, weights = 0.0, [0.0] * size
    total = sum(n for _, _, n in rows)
    square = [0.0] * (size + 1)  # per-coordinate step sizes
    for _ in range(rounds):
        slope = [0.0] * (size + 1)
        for features, label, n in rows:
            miss = (sigmoid(bias + sum(w for w, f in zip(weights, features) if f)) - label) * n / total
            slope[size] += miss
            for i, f in enumerate(features):
                if f:
                    slope[i] += miss
        for i in range(size + 1):
            own = slope[i] + (ridge * weights[i] if i < size else 0.0)
            square[i] += own * own
            step = rate * own / (math.sqrt(square[i]) + 1e-9)
            if i < size:
                weights[i] -= step
            else:
                bias -= step
    return bias, weights
