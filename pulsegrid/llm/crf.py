"""A linear-chain conditional random field with two labels: fitting and Viterbi decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEPS, MEMORY = 150, 8


@dataclass
class ChainField:
    """Label 1 scores ``weights`` on the features, label 0 nothing; ``turns[a, b]`` is for a before b."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    turns: np.ndarray

    def lean(self, rows: np.ndarray) -> np.ndarray:
        """How much each row alone speaks for label 1."""
        inside = np.clip((rows - self.center) / self.scale, -8, 8)
        return inside @ self.weights[1:] + self.weights[0]

    def decode(self, lean: np.ndarray) -> np.ndarray:
        """The most likely labels of one sequence (Viterbi); ties go to label 1."""
        if not len(lean):
            return np.zeros(0, np.int8)
        (t00, t01), (t10, t11) = self.turns.tolist()
        zero, one = 0.0, float(lean[0])
        from_one: list[tuple[bool, bool]] = []
        for own in lean[1:].tolist():
            stay, back = zero + t00, one + t10
            rise, keep = zero + t01, one + t11
            from_one.append((back >= stay, keep >= rise))
            zero, one = max(stay, back), max(rise, keep) + own
        labels = np.zeros(len(lean), np.int8)
        now = one >= zero
        labels[-1] = now
        for at in range(len(from_one) - 1, -1, -1):
            now = from_one[at][now]
            labels[at] = now
        return labels


def _padded(rows: np.ndarray, y: np.ndarray, bounds: np.ndarray):
    """Sequences side by side, place by place: rows (place, sequence, feature), labels, real places."""
    sizes = np.diff(bounds)
    longest = int(sizes.max())
    place = np.arange(len(rows)) - np.repeat(bounds[:-1], sizes)
    which = np.repeat(np.arange(len(sizes)), sizes)
    x = np.zeros((longest, len(sizes), rows.shape[1]))
    x[place, which] = rows
    labels = np.zeros((longest, len(sizes)), int)
    labels[place, which] = y
    return x, labels, np.arange(longest)[:, None] < sizes


def _loss(v: np.ndarray, x, y, real, ridge: float) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of the labels, and its gradient, by forward and backward sums."""
    weights, turns = v[:-4], v[-4:].reshape(2, 2)
    lean = np.where(real, x @ weights, 0.0)
    places, count = lean.shape
    node = np.stack([np.zeros_like(lean), lean], axis=2)
    ahead = np.zeros((places, count, 2))
    ahead[0] = node[0]
    for p in range(1, places):
        step = np.logaddexp(ahead[p - 1, :, 0, None] + turns[0], ahead[p - 1, :, 1, None] + turns[1])
        ahead[p] = np.where(real[p, :, None], step + node[p], ahead[p - 1])
    total = np.logaddexp(ahead[-1, :, 0], ahead[-1, :, 1])
    behind = np.zeros((places, count, 2))
    pairs = np.zeros((2, 2))
    for p in range(places - 2, -1, -1):
        onward = node[p + 1] + behind[p + 1]
        step = np.logaddexp(turns[:, 0] + onward[:, 0, None], turns[:, 1] + onward[:, 1, None])
        behind[p] = np.where(real[p + 1, :, None], step, behind[p + 1])
        joint = ahead[p, :, :, None] + turns + onward[:, None, :] - total[:, None, None]
        pairs += (np.exp(joint) * real[p + 1, :, None, None]).sum(axis=0)
    one = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total) * real
    seen = np.zeros((2, 2))
    both = real[1:]
    np.add.at(seen, (y[:-1][both], y[1:][both]), 1)
    gold = (y * lean)[real].sum() + (turns * seen).sum()
    loss = total.sum() - gold + 0.5 * ridge * (v[1:] @ v[1:])
    slope = np.append(np.einsum("pcf,pc->f", x, one - y * real), (pairs - seen).ravel())
    slope[1:] += ridge * v[1:]
    return float(loss), slope


def fit_chain(
    rows: np.ndarray, y: np.ndarray, bounds: np.ndarray, ridge: float = 1.0, start: ChainField | None = None
) -> ChainField:
    """Maximum likelihood with a ridge penalty by limited-memory quasi-Newton steps."""
    center, scale = (rows.mean(axis=0), rows.std(axis=0)) if start is None else (start.center, start.scale)
    scale = np.where(scale > 1e-9, scale, 1.0)
    inside = np.hstack([np.ones((len(rows), 1)), np.clip((rows - center) / scale, -8, 8)])
    x, labels, real = _padded(inside, y, bounds)
    v = np.zeros(inside.shape[1] + 4)
    if start is not None:
        v = np.append(start.weights, start.turns.ravel())
    now, slope = _loss(v, x, labels, real, ridge)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        way, shares = slope.copy(), []
        for s, g in reversed(steps):
            shares.append(s @ way / (s @ g))
            way -= shares[-1] * g
        if steps:
            way *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1])
        else:
            way /= max(1.0, np.linalg.norm(way))
        for (s, g), share in zip(steps, reversed(shares)):
            way += s * (share - g @ way / (s @ g))
        size = 1.0
        while True:
            there = v - size * way
            next_loss, next_slope = _loss(there, x, labels, real, ridge)
            if next_loss <= now - 1e-4 * size * (slope @ way) or size < 1e-6:
                break
            size /= 2
        s, g = there - v, next_slope - slope
        if s @ g > 1e-12:
            steps = [*steps, (s, g)][-MEMORY:]
        gain = now - next_loss
        v, now, slope = there, next_loss, next_slope
        if gain < 1e-7 * (1 + abs(now)):
            break
    return ChainField(center, scale, v[:-4], v[-4:].reshape(2, 2))
