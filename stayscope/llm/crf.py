"""A linear-chain conditional random field over sparse features, in numpy."""

from __future__ import annotations

import numpy as np

from stayscope.llm.common import ship


class Chain:
    """Weights of features per tag, of tag pairs, and of first tags."""

    def __init__(self, tags: list[str], features: dict[str, int]):
        self.tags, self.features = tags, features
        self.unary = np.zeros((len(features) + 1, len(tags)))  # the last row is of unknown features
        self.pairs = np.zeros((len(tags), len(tags)))
        self.first = np.zeros(len(tags))

    def indexes(self, sequence: list[list[str]]) -> np.ndarray:
        """Feature numbers, one row per token; every token has equally many features."""
        unknown = len(self.features)
        return np.array([[self.features.get(f, unknown) for f in token] for token in sequence], dtype=np.int64)

    def emissions(self, indexes: np.ndarray) -> np.ndarray:
        return self.unary[indexes].sum(axis=1)

    def fit(self, sequences: list[np.ndarray], labels: list[np.ndarray], rounds: int, ridge: float) -> None:
        """Full-batch maximum likelihood with a ridge penalty, by Adam from zero weights."""
        longest = max(map(len, sequences))
        b, n_tags = len(sequences), len(self.tags)
        lengths = np.array([len(s) for s in sequences])
        width = sequences[0].shape[1]
        x = np.full((b, longest, width), len(self.features), dtype=np.int64)
        y = np.zeros((b, longest), dtype=np.int64)
        for i, (s, t) in enumerate(zip(sequences, labels, strict=True)):
            x[i, : len(s)], y[i, : len(s)] = s, t
        real = np.arange(longest) < lengths[:, None]
        both = real[:, 1:]
        seen_pairs = np.zeros((n_tags, n_tags))
        np.add.at(seen_pairs, (y[:, :-1][both], y[:, 1:][both]), 1.0)
        seen_first = np.bincount(y[:, 0], minlength=n_tags).astype(float)
        weights = [self.unary, self.pairs, self.first]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        one_hot = np.eye(n_tags)[y]
        # Occurrences of each feature side by side, so that a gradient is a sum over runs.
        flat = x[real].ravel()
        by_feature = np.argsort(flat, kind="stable")
        runs = np.flatnonzero(np.diff(flat[by_feature], prepend=-1))
        numbers, owners = flat[by_feature][runs], by_feature // width
        for step in range(1, rounds + 1):
            scores = self.unary[x].sum(axis=2)
            own = np.exp(scores - scores.max(axis=2, keepdims=True))
            step_to = np.exp(self.pairs)
            # Scaled forward and backward passes: each position's forward row adds up to one.
            forward, backward = np.zeros_like(own), np.ones_like(own)
            scale = np.ones((b, longest))
            row = np.exp(self.first) * own[:, 0]
            for t in range(longest):
                if t:
                    row = np.where(real[:, t, None], (forward[:, t - 1] @ step_to) * own[:, t], forward[:, t - 1])
                scale[:, t] = row.sum(axis=1)
                forward[:, t] = row / scale[:, t, None]
            ahead = np.zeros((b, longest, n_tags))
            for t in range(longest - 2, -1, -1):
                ahead[:, t] = own[:, t + 1] * backward[:, t + 1] / scale[:, t + 1, None]
                backward[:, t] = np.where(real[:, t + 1, None], ahead[:, t] @ step_to.T, 1.0)
            marginals = forward * backward
            wrong = (one_hot - marginals)[real]
            gradient = np.zeros_like(self.unary)
            gradient[numbers] = np.add.reduceat(wrong[owners], runs, axis=0)
            expected = step_to * (forward[:, :-1][both].T @ ahead[:, :-1][both])
            slopes = [gradient, seen_pairs - expected, seen_first - marginals[:, 0].sum(axis=0)]
            for w, slope, (m, v) in zip(weights, slopes, moments, strict=True):
                slope = slope / b - ridge * w
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                w += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            self.unary[-1] = 0.0

    def decode(self, sequences: list[np.ndarray], batch: int = 256) -> list[np.ndarray]:
        """The best tags of each sequence by Viterbi, in batches of similar length."""
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(sequences)
        order = sorted((i for i, s in enumerate(sequences) if len(s)), key=lambda i: len(sequences[i]))
        at = 0
        while at < len(order):
            longest = len(sequences[order[min(at + batch, len(order)) - 1]])
            # Long sequences go in smaller batches: the memory of a batch is bounded by tokens.
            take = max(1, min(batch, 65_536 // longest))
            part = order[at : at + take]
            at += take
            longest = len(sequences[part[-1]])
            lengths = np.array([len(sequences[i]) for i in part])
            scores = np.zeros((len(part), longest, len(self.tags)))
            for row, i in enumerate(part):
                scores[row, : lengths[row]] = self.emissions(sequences[i])
            best = self.first + scores[:, 0]
            came = np.zeros((len(part), longest, len(self.tags)), dtype=np.int8)
            finals = best.copy()
            for t in range(1, longest):
                paths = best[:, :, None] + self.pairs
                came[:, t] = paths.argmax(axis=1)
                best = paths.max(axis=1) + scores[:, t]
                finals = np.where((lengths > t)[:, None], best, finals)
            for row, i in enumerate(part):
                tags = np.zeros(lengths[row], dtype=np.int64)
                tags[-1] = finals[row].argmax()
                for t in range(lengths[row] - 1, 0, -1):
                    tags[t - 1] = came[row, t, tags[t]]
                out[i] = tags
        return out


ship(__name__)
