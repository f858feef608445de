"""A linear-chain conditional random field with two labels over binary features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Weights per feature (of label 1 against label 0), transition scores and a start score."""

    weights: dict[str, float]
    start: float
    moves: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, blocks: list[list[str]]) -> list[int]:
        """The most probable labels of a sequence (Viterbi); label 0 wins a tie."""
        if not blocks:
            return []
        get = self.weights.get
        (m00, m01), (m10, m11) = self.moves
        back, zero, one = [], 0.0, 0.0
        for at, names in enumerate(blocks):
            own = sum(get(n, 0.0) for n in names)
            if at == 0:
                zero, one = 0.0, self.start + own
                continue
            z0, z1, o0, o1 = zero + m00, one + m10, zero + m01, one + m11
            back.append((int(z1 > z0), int(o1 > o0)))
            zero, one = max(z0, z1), max(o0, o1) + own
        label = int(one > zero)
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        return labels[::-1]


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def fit(pages: list[list[list[str]]], labels: list[list[int]], steps: int = 150, penalty: float = 1.0) -> Chain:
    """Maximum likelihood with an L2 penalty by gradient steps (Adam) over all pages at once.

    `pages` holds, per page, the feature names of each block. The gradient is that of the
    forward-backward marginals.
    """
    kept = [(p, y) for p, y in zip(pages, labels) if p]
    names = {n: i for i, n in enumerate(sorted({n for p, _ in kept for b in p for n in b}))}
    long = max((len(p) for p, _ in kept), default=0)
    if not long:
        return Chain({}, 0.0, ((0.0, 0.0), (0.0, 0.0)))
    x = np.zeros((len(kept), long, len(names)), np.float32)
    y, mask = np.zeros((len(kept), long), int), np.zeros((len(kept), long), bool)
    for k, (page, own) in enumerate(kept):
        for t, block in enumerate(page):
            x[k, t, [names[n] for n in block]] = 1
        y[k, : len(page)], mask[k, : len(page)] = own, True
    flat = x.reshape(-1, len(names))
    w = np.zeros(len(names) + 5)
    m, v = np.zeros_like(w), np.zeros_like(w)
    rows = np.arange(len(kept))
    last = mask.sum(axis=1) - 1
    pair = mask[:, 1:]
    seen = np.array([[(pair & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    for step in range(1, steps + 1):
        theta, start, moves = w[:-5], w[-5], w[-4:].reshape(2, 2)
        own = np.stack([np.zeros(y.shape), (flat @ theta.astype(np.float32)).reshape(y.shape)], axis=2)
        own[:, 0, 1] += start
        ahead, behind = np.zeros(own.shape), np.zeros(own.shape)
        ahead[:, 0] = own[:, 0]
        for t in range(1, long):
            ahead[:, t] = own[:, t] + _log_add(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1])
        for t in range(long - 2, -1, -1):
            nxt = own[:, t + 1] + behind[:, t + 1]
            value = _log_add(moves[:, 0] + nxt[:, :1], moves[:, 1] + nxt[:, 1:])
            behind[:, t] = np.where((t < last)[:, None], value, 0.0)
        total = _log_add(ahead[rows, last, 0], ahead[rows, last, 1])
        p1 = np.where(mask, np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]), 0.0)
        both = (
            ahead[:, :-1, :, None] + moves[None, None] + (own[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        both = np.where(pair[:, :, None, None], np.exp(np.minimum(both, 0.0)), 0.0).sum(axis=(0, 1))
        error = np.where(mask, p1 - y, 0.0)
        grad = np.concatenate([error.ravel().astype(np.float32) @ flat, [error[:, 0].sum()], (both - seen).ravel()]) + penalty * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    moves = tuple(tuple(float(a) for a in row) for row in w[-4:].reshape(2, 2))
    return Chain({n: float(w[i]) for n, i in names.items()}, float(w[-5]), moves)
