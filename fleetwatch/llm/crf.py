"""A linear-chain conditional random field over many sequences at once.

Sequences lie one after another in the rows of a feature matrix. All steps run side by side over the sequences that are
long enough, so the cost in numpy calls is the longest sequence of a batch, not the number of items.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Model:
    weights: np.ndarray  # features x labels
    steps: np.ndarray  # label before x label
    first: np.ndarray  # labels
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights


def _rows(lengths: np.ndarray) -> list[np.ndarray]:
    """For each step the rows of the sequences that reach it, longest sequences first."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    alive = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")
    return [starts[:n] + t for t, n in enumerate(alive)]


def marginals(model: Model, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Label probabilities of every row, expected counts of label pairs, and the log of the partition functions' product."""
    rows, move = _rows(lengths), np.exp(model.steps)
    top = scores.max(axis=1, initial=-np.inf, keepdims=True)
    local = np.exp(np.maximum(scores - top, -50))
    ahead, back, norm = np.empty_like(local), np.ones_like(local), np.ones(len(local))
    for t, at in enumerate(rows):
        value = local[at] * (np.exp(model.first) if t == 0 else ahead[at - 1] @ move)
        norm[at] = total = value.sum(axis=1)
        ahead[at] = value / total[:, None]
    pairs = np.zeros_like(move)
    for t in range(len(rows) - 1, 0, -1):
        at = rows[t]
        later = local[at] * back[at] / norm[at][:, None]
        back[at - 1] = later @ move.T
        pairs += ahead[at - 1].T @ later * move
    return ahead * back, pairs, float(np.log(norm).sum() + top.sum())


def viterbi(model: Model, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The most probable labels of every sequence; ties go to the smaller label."""
    rows = _rows(lengths)
    best, came = np.array(scores), np.zeros(scores.shape, np.int64)
    for t, at in enumerate(rows):
        if t == 0:
            best[at] += model.first
        else:
            ways = best[at - 1][:, :, None] + model.steps
            came[at] = ways.argmax(axis=1)
            best[at] += ways.max(axis=1)
    out = np.zeros(len(scores), np.int64)
    ends = np.cumsum(lengths)[lengths > 0] - 1
    out[ends] = best[ends].argmax(axis=1)
    for t in range(len(rows) - 1, 0, -1):
        at = rows[t]
        out[at - 1] = came[at, out[at]]
    return out


def train(x: np.ndarray, labels: np.ndarray, lengths: np.ndarray, n_labels: int = 2, rounds: int = 200, ridge: float = 1e-3, rate: float = 0.1) -> Model:
    """Weights that maximise the conditional likelihood of the labels less a ridge penalty, by Adam on all sequences.

    Without sequences, or with one label only, the model is that of the data: all zeros, or one label everywhere.
    """
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    scale = np.where(scale < 1e-5, 1.0, scale)
    model = Model(np.zeros((x.shape[1], n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels), mean, scale)
    if not len(x):
        return model
    z = (x - mean) / scale
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    inner = np.ones(len(z), bool)
    inner[starts] = False
    seen_pairs = np.zeros((n_labels, n_labels))
    np.add.at(seen_pairs, (labels[np.flatnonzero(inner) - 1], labels[inner]), 1)
    truth = np.eye(n_labels)[labels]
    parts = [model.weights, model.steps, model.first]
    fast, slow = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for k in range(1, rounds + 1):
        likely, pairs, _ = marginals(model, z @ model.weights, lengths)
        off = truth - likely
        slopes = (z.T @ off / len(z), (seen_pairs - pairs) / len(z), off[starts].sum(axis=0) / len(starts))
        step = rate * (1 - k / (rounds + 1))
        for p, slope, m, v in zip(parts, slopes, fast, slow, strict=True):
            slope = slope - ridge * p
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            p += step * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return model
