"""A two-state linear-chain conditional random field in numpy."""

from __future__ import annotations

import numpy as np


class ChainCRF:
    """Sparse binary features; states 0 (drop) and 1 (keep); decoded by Viterbi.

    A sequence is a list of positions, each a list of feature numbers.
    """

    def __init__(self, n_features: int):
        self.emit = np.zeros((n_features, 2))
        self.move = np.zeros((2, 2))
        self.first = np.zeros(2)

    def fit(self, sequences: list[list[list[int]]], labels: list[list[int]], epochs: int = 120, rate: float = 0.15, l2: float = 1e-3) -> ChainCRF:
        """Adam on the exact conditional log-likelihood of all sequences at once."""
        n, longest = len(sequences), max(map(len, sequences))
        at = np.array([(i, t, f) for i, s in enumerate(sequences) for t, fs in enumerate(s) for f in fs])
        mask = np.zeros((n, longest), dtype=bool)
        gold = np.zeros((n, longest), dtype=np.int64)
        for i, y in enumerate(labels):
            mask[i, : len(y)] = True
            gold[i, : len(y)] = y
        one = np.eye(2)[gold] * mask[..., None]
        gold_move = np.einsum("nta,ntb->ab", one[:, :-1], one[:, 1:])
        total = mask.sum()
        state = [np.zeros_like(p) for p in (self.emit, self.move, self.first)] * 2
        for step in range(1, epochs + 1):
            e = np.zeros((n, longest, 2))
            np.add.at(e, (at[:, 0], at[:, 1]), self.emit[at[:, 2]])
            a = np.zeros((n, longest, 2))
            a[:, 0] = e[:, 0] + self.first
            for t in range(1, longest):
                a[:, t] = np.where(mask[:, t, None], np.logaddexp(a[:, t - 1, :1] + self.move[0], a[:, t - 1, 1:] + self.move[1]) + e[:, t], a[:, t - 1])
            z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
            b = np.zeros((n, longest, 2))
            for t in range(longest - 2, -1, -1):
                x = e[:, t + 1] + b[:, t + 1]
                b[:, t] = np.where(mask[:, t + 1, None], np.logaddexp(self.move[:, 0] + x[:, :1], self.move[:, 1] + x[:, 1:]), b[:, t + 1])
            p = np.exp(a + b - z[:, None, None]) * mask[..., None]
            pair = np.exp(a[:, :-1, :, None] + self.move + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * mask[:, 1:, None, None]
            g_emit = np.zeros_like(self.emit)
            np.add.at(g_emit, at[:, 2], (one - p)[at[:, 0], at[:, 1]])
            grads = [g_emit / total, (gold_move - pair.sum(axis=(0, 1))) / total, (one[:, 0] - p[:, 0]).sum(axis=0) / total]
            for k, w in enumerate((self.emit, self.move, self.first)):
                g = grads[k] - l2 * w
                state[k] = 0.9 * state[k] + 0.1 * g
                state[k + 3] = 0.99 * state[k + 3] + 0.01 * g * g
                w += rate * (state[k] / (1 - 0.9**step)) / (np.sqrt(state[k + 3] / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, sequence: list[list[int]]) -> list[int]:
        """The most probable states; ties go to 1."""
        if not sequence:
            return []
        w0, w1 = self._weights()
        (m00, m01), (m10, m11) = self.move.tolist()
        s0, s1 = self.first.tolist()
        back = []
        for t, fs in enumerate(sequence):
            e0 = e1 = 0.0
            for f in fs:
                e0 += w0[f]
                e1 += w1[f]
            if t:
                a, b, c, d = s0 + m00, s1 + m10, s0 + m01, s1 + m11
                back.append((1 if b >= a else 0, 1 if d >= c else 0))
                s0, s1 = (b if b >= a else a) + e0, (d if d >= c else c) + e1
            else:
                s0, s1 = s0 + e0, s1 + e1
        y = [1 if s1 >= s0 else 0]
        for step in reversed(back):
            y.append(step[y[-1]])
        return y[::-1]

    def _weights(self) -> tuple[list[float], list[float]]:
        if not hasattr(self, "_lists"):
            self._lists = self.emit[:, 0].tolist(), self.emit[:, 1].tolist()
        return self._lists
