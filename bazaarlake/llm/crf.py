"""A linear-chain conditional random field in numpy, over many sequences at once.

Sequences lie one after the other in flat arrays. They are worked on together, position by position: with the longest
first, those that still have a position t are always the first ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chains:
    """Where each sequence of a flat array starts, longest first, and how many reach each position."""

    starts: np.ndarray
    active: np.ndarray

    @classmethod
    def of(cls, lengths: np.ndarray) -> Chains:
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max()) if len(lengths) else 0
        ends = np.bincount(lengths, minlength=longest + 1)
        return cls(starts[order], (len(lengths) - np.cumsum(ends))[:longest] if longest else np.empty(0, np.int64))


def viterbi(emissions: np.ndarray, lengths: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best label of every position. Scores of best paths are kept and the way back is read from them."""
    chains, labels = Chains.of(lengths), np.zeros(len(emissions), np.int8)
    scores: list[np.ndarray] = []  # labels x active sequences, by position
    for t, n in enumerate(chains.active):
        own = emissions[chains.starts[:n] + t].T
        if t == 0:
            scores.append(first[:, None] + own)
            continue
        before = scores[-1][:, :n]
        scores.append(np.stack([(before + step[:, None]).max(axis=0) for step in moves.T]) + own)
    label = np.empty(0, np.int64)
    for t in range(len(scores) - 1, -1, -1):
        n, known = chains.active[t], len(label)
        ended = scores[t][:, known:].argmax(axis=0)
        if known:
            label = (scores[t][:, :known] + moves[:, label]).argmax(axis=0)
        label = np.concatenate([label, ended])
        labels[chains.starts[:n] + t] = label
    return labels


def marginals(emissions: np.ndarray, lengths: np.ndarray, first: np.ndarray, moves: np.ndarray):
    """Forward-backward: the probability of each label at each position, the summed probability of each move, and the
    log of the normalisers' sum. Forward values are scaled at every position."""
    chains = Chains.of(lengths)
    n_labels = len(first)
    forward, backward = np.zeros(emissions.shape), np.ones(emissions.shape)
    step, total = np.exp(moves), 0.0
    peak = emissions.max(axis=1, keepdims=True)
    local = np.exp(emissions - peak)
    scale = np.ones(len(emissions))
    for t, n in enumerate(chains.active):
        at = chains.starts[:n] + t
        row = (np.exp(first) if t == 0 else forward[at - 1] @ step) * local[at]
        scale[at] = row.sum(axis=1)
        forward[at] = row / scale[at][:, None]
    moved = np.zeros((n_labels, n_labels))
    for t in range(len(chains.active) - 2, -1, -1):
        at = chains.starts[: chains.active[t + 1]] + t
        ahead = local[at + 1] * backward[at + 1] / scale[at + 1][:, None]
        moved += (forward[at].T @ ahead) * step
        backward[at] = ahead @ step.T
    total = float(np.log(scale).sum() + peak.sum())
    return forward * backward, moved, total


class CRF:
    """Emissions are a sum of rows of ``weights`` (features x labels); features come as rows of indices or as a dense matrix."""

    def __init__(self, n_features: int, n_labels: int):
        self.weights = np.zeros((n_features, n_labels))
        self.first, self.moves = np.zeros(n_labels), np.zeros((n_labels, n_labels))

    def emissions(self, features: np.ndarray) -> np.ndarray:
        if features.dtype.kind == "f":
            return features @ self.weights
        out = self.weights[features[:, 0]]
        for j in range(1, features.shape[1]):
            out += self.weights[features[:, j]]
        return out

    def fit(self, features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> CRF:
        """Maximum likelihood with a Gaussian prior, by Adam over all sequences."""
        n_labels = len(self.first)
        hot = np.eye(n_labels)[labels]
        starts = np.cumsum(lengths) - lengths
        starts = starts[lengths > 0]
        inner = np.ones(len(labels), bool)
        inner[starts] = False
        seen = np.zeros((n_labels, n_labels))
        at = np.flatnonzero(inner)
        np.add.at(seen, (labels[at - 1], labels[at]), 1)
        params = [self.weights, self.first, self.moves]
        means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for k in range(1, rounds + 1):
            probs, moved, _ = marginals(self.emissions(features), lengths, self.first, self.moves)
            miss = hot - probs
            if features.dtype.kind == "f":
                own = features.T @ miss
            else:
                own = np.zeros_like(self.weights)
                for j in range(features.shape[1]):
                    np.add.at(own, features[:, j], miss)
            for i, (p, g) in enumerate(zip(params, (own, miss[starts].sum(axis=0), seen - moved))):
                g = g / max(1, len(labels)) - decay * p
                means[i] = 0.9 * means[i] + 0.1 * g
                squares[i] = 0.99 * squares[i] + 0.01 * g * g
                p += rate * (means[i] / (1 - 0.9**k)) / (np.sqrt(squares[i] / (1 - 0.99**k)) + 1e-9)
        return self

    def decode(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return viterbi(self.emissions(features), lengths, self.first, self.moves)

    def probabilities(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return marginals(self.emissions(features), lengths, self.first, self.moves)[0]
