"""Linear-chain conditional random fields in numpy, many sequences at a time.

Sequences lie end to end in one array of emission scores (tokens x labels).  They
are sorted by length and walked position by position, all sequences at once, so
the Python work is the length of the longest sequence, not the number of tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chains:
    """Sequences of lengths ``np.diff(offsets)``; every one has a token at least."""

    offsets: np.ndarray

    def __post_init__(self) -> None:
        lengths = np.diff(self.offsets)
        order = np.argsort(-lengths, kind="stable")
        self.order = order
        self.starts = self.offsets[:-1][order]
        self.lengths = lengths[order]
        # Sequences that have a token at each position; they are the first so many.
        self.alive = np.searchsorted(-self.lengths, -np.arange(1, (int(self.lengths[0]) if len(lengths) else 0) + 1), side="right")

    def positions(self):
        """(position, rows of the tokens there)."""
        for t, n in enumerate(self.alive):
            yield t, self.starts[:n] + t


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def forward_backward(emissions: np.ndarray, transitions: np.ndarray, chains: Chains, share: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Label marginals of every token, summed marginals of label pairs, and the sum of log partitions.

    ``share`` counts a sequence's pairs more or less than once in their sum.
    """
    each = None if share is None else share[chains.order]
    forward, backward = np.zeros_like(emissions), np.zeros_like(emissions)
    for t, rows in chains.positions():
        forward[rows] = emissions[rows] + (_log_sum(forward[rows - 1][:, :, None] + transitions, 1) if t else 0)
    pairs = np.zeros_like(transitions)
    for t in range(len(chains.alive) - 2, -1, -1):
        rows = chains.starts[: chains.alive[t + 1]] + t
        after = emissions[rows + 1] + backward[rows + 1]
        backward[rows] = _log_sum(transitions + after[:, None, :], 2)
    total = _log_sum(forward[chains.starts + chains.lengths - 1], 1)
    total_of = np.empty(len(emissions))
    for t, rows in chains.positions():
        total_of[rows] = total[: len(rows)]
        if t:
            joint = forward[rows - 1][:, :, None] + transitions + (emissions[rows] + backward[rows])[:, None, :]
            chance = np.exp(joint - total[: len(rows), None, None])
            pairs += chance.sum(axis=0) if each is None else np.einsum("s,sjk->jk", each[: len(rows)], chance)
    return np.exp(forward + backward - total_of[:, None]), pairs, float(total.sum())


def viterbi(emissions: np.ndarray, transitions: np.ndarray, chains: Chains) -> np.ndarray:
    """The best label of every token; ties go to the smaller label."""
    best, back = np.zeros_like(emissions), np.zeros(emissions.shape, dtype=np.int32)
    for t, rows in chains.positions():
        if t:
            scores = best[rows - 1][:, :, None] + transitions
            back[rows] = scores.argmax(axis=1)
            best[rows] = emissions[rows] + scores.max(axis=1)
        else:
            best[rows] = emissions[rows]
    labels = np.zeros(len(emissions), dtype=np.int64)
    last = chains.starts + chains.lengths - 1
    labels[last] = best[last].argmax(axis=1)
    for t in range(len(chains.alive) - 1, 0, -1):
        rows = chains.starts[: chains.alive[t]] + t
        labels[rows - 1] = back[rows, labels[rows]]
    return labels


def train(features: np.ndarray, labels: np.ndarray, offsets: np.ndarray, n_labels: int, *, weights: np.ndarray | None = None, rounds: int = 80, rate: float = 0.15, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights (features x labels) and transitions of highest regularised likelihood.

    Full-batch Adam from zero: the same rows give the same model.  ``features`` is
    dense; ``weights`` counts a sequence more or less than once.
    """
    chains = Chains(offsets)
    share = np.ones(len(offsets) - 1) if weights is None else weights
    token_share = np.repeat(share, np.diff(offsets))[:, None]
    truth = np.eye(n_labels)[labels]
    first = np.zeros(len(labels), dtype=bool)
    first[offsets[:-1]] = True
    truth_pairs = np.zeros((n_labels, n_labels))
    np.add.at(truth_pairs, (labels[:-1][~first[1:]], labels[1:][~first[1:]]), token_share[1:, 0][~first[1:]])
    w, a = np.zeros((features.shape[1], n_labels)), np.zeros((n_labels, n_labels))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(a), np.zeros_like(a)]
    scale = 1.0 / max(1.0, float(token_share.sum()))
    for step in range(1, rounds + 1):
        marginals, pairs, _ = forward_backward(features @ w, a, chains, share)
        slopes = (features.T @ ((truth - marginals) * token_share) * scale - decay * w, (truth_pairs - pairs) * scale - decay * a)
        for k, (x, g) in enumerate(zip((w, a), slopes, strict=True)):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w, a
