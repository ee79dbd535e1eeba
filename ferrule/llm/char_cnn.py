"""A character convolutional network in numpy over a candidate and its context.

A candidate is seen as ``LEFT`` characters before it, its body, and ``RIGHT`` after it.  Characters are embedded by class and
zone, convolved, and max-pooled by zone; a hidden layer and the candidate's length give one logit a kind.  A body longer than
``BODY`` is cut into overlapping pieces whose pools are combined by their maximum, which is the pool of the convolution over the whole body.
"""

from __future__ import annotations

import numpy as np

from ferrule.llm.char_tagger import CLASSES, PAD, classes

LEFT, BODY, RIGHT, WIDTH = 24, 40, 8, 5
SPAN = LEFT + BODY + RIGHT
ZONES = np.repeat([0, 1, 2], [LEFT, BODY, RIGHT])
#: The zone of each place of the convolution, by the character in its middle.
POOLS = [np.flatnonzero(ZONES[WIDTH // 2:SPAN - WIDTH // 2] == z) for z in range(3)]
DEPTH, FILTERS, HIDDEN = 10, 28, 24
#: A candidate's length counts by the steps it reaches.
STEPS = np.array([10, 12, 16, 20, 24, 32, 40, 64])
STRIDE = BODY - WIDTH + 1


def pieces(left: str, body: str, right: str) -> np.ndarray:
    """The rows of classes (by zone) that stand for a candidate."""
    before = np.full(LEFT, PAD)
    near = classes(left)[-LEFT:]
    before[LEFT - len(near):] = near
    after = np.full(RIGHT, PAD)
    near = classes(right)[:RIGHT]
    after[:len(near)] = near
    own = classes(body)
    starts = range(0, max(1, len(own) - BODY + STRIDE), STRIDE)
    out = np.full((len(starts), SPAN), PAD)
    out[:, :LEFT], out[:, LEFT + BODY:] = before, after
    for row, s in zip(out, starts, strict=True):
        part = own[s:s + BODY]
        row[LEFT:LEFT + len(part)] = part
    return out + ZONES * CLASSES


class Net:
    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @staticmethod
    def new(kinds: int, seed: int = 5) -> Net:
        rng = np.random.default_rng(seed)
        features = 3 * FILTERS + len(STEPS)
        return Net({
            "embed": rng.normal(0, 0.5, (3 * CLASSES, DEPTH)),
            "conv": rng.normal(0, np.sqrt(2 / (WIDTH * DEPTH)), (WIDTH * DEPTH, FILTERS)), "conv_b": np.zeros(FILTERS),
            "in": rng.normal(0, np.sqrt(2 / features), (features, HIDDEN)), "in_b": np.zeros(HIDDEN),
            "out": rng.normal(0, 0.3, (HIDDEN, kinds)), "out_b": np.zeros(kinds)})

    def _pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima by zone and filter (rows, 3 * FILTERS), not below 0, and the places they come from."""
        seen = self.p["embed"][rows]  # rows, SPAN, DEPTH
        patches = np.lib.stride_tricks.sliding_window_view(seen, WIDTH, 1).transpose(0, 1, 3, 2).reshape(len(rows), -1, WIDTH * DEPTH)
        found = patches @ self.p["conv"] + self.p["conv_b"]
        places = np.stack([zone[found[:, zone].argmax(1)] for zone in POOLS], 1)  # rows, 3, FILTERS
        top = np.take_along_axis(found, places.reshape(len(rows), -1, FILTERS), 1)
        return np.maximum(top, 0).reshape(len(rows), -1), places

    def logits(self, candidates: list[tuple[str, str, str]]) -> np.ndarray:
        """One row a candidate (left, body, right), one column a kind."""
        if not candidates:
            return np.zeros((0, len(self.p["out_b"])))
        cut = [pieces(*c) for c in candidates]
        first = np.cumsum([0, *map(len, cut)])[:-1]
        rows = np.concatenate(cut)
        pooled = np.concatenate([self._pooled(rows[k:k + 256])[0] for k in range(0, len(rows), 256)])
        return self._head(np.maximum.reduceat(pooled, first, 0), lengths([c[1] for c in candidates]))[0]

    def _head(self, pooled: np.ndarray, length: np.ndarray):
        x = np.concatenate([pooled, length.astype(pooled.dtype)], 1)
        z = x @ self.p["in"] + self.p["in_b"]
        h = np.maximum(z, 0)
        return h @ self.p["out"] + self.p["out_b"], x, z, h

    def gradient(self, rows: np.ndarray, length: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss over candidates of one piece, and its gradient."""
        pooled, places = self._pooled(rows)
        logit, x, z, h = self._head(pooled, length)
        n = len(rows)
        loss = float((np.logaddexp(0, logit) - gold * logit).sum() / n)
        d = (0.5 * np.tanh(0.5 * logit) + 0.5 - gold) / n
        grad = {"out": h.T @ d, "out_b": d.sum(0)}
        dz = (d @ self.p["out"].T) * (z > 0)
        grad["in"], grad["in_b"] = x.T @ dz, dz.sum(0)
        dp = ((dz @ self.p["in"].T)[:, :pooled.shape[1]] * (pooled > 0)).reshape(n, 3, FILTERS)
        at = places[..., None] + np.arange(WIDTH)  # n, 3, FILTERS, WIDTH
        chars = rows[np.arange(n)[:, None, None, None], at]
        patch = self.p["embed"][chars].reshape(n * 3, FILTERS, WIDTH * DEPTH)
        flat = dp.reshape(n * 3, FILTERS)
        grad["conv"] = np.einsum("nfk,nf->kf", patch, flat)
        grad["conv_b"] = flat.sum(0)
        back = (dp[..., None] * self.p["conv"].T).reshape(-1, DEPTH)
        grad["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grad["embed"], chars.reshape(-1), back)
        return loss, grad

    def train(self, candidates: list[tuple[str, str, str]], gold: np.ndarray, steps: int, batch: int, rate: float, seed: int = 7) -> list[float]:
        """Adam with a falling rate on random batches; a long candidate trains by one of its pieces at a time."""
        rng = np.random.default_rng(seed)
        cut, length = [pieces(*c) for c in candidates], lengths([c[1] for c in candidates])
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            own = rng.choice(len(cut), min(batch, len(cut)), replace=False)
            rows = np.stack([cut[i][rng.integers(len(cut[i]))] for i in own])
            loss, grad = self.gradient(rows, length[own], gold[own])
            size = rate * (1.05 - step / steps)
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] -= size * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
            losses.append(loss)
        return losses

    def light(self) -> dict[str, np.ndarray]:
        """The parameters as 32-bit floats, for tasks."""
        return {k: v.astype(np.float32) for k, v in self.p.items()}


def lengths(bodies: list[str]) -> np.ndarray:
    return (np.array([len(b) for b in bodies])[:, None] >= STEPS).astype(np.float64)


def calibrate(logit: np.ndarray, gold: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve from logits to probabilities (Platt's targets, damped Newton steps)."""
    n1 = int(gold.sum())
    n0 = len(gold) - n1
    target = np.where(gold > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([logit, np.ones(len(logit))], 1)
    w = np.array([1.0, 0.0])
    loss = lambda v: (np.logaddexp(0, x @ v) - target * (x @ v)).sum()
    for _ in range(steps):
        p = 0.5 * np.tanh(0.5 * (x @ w)) + 0.5
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def threshold(p: np.ndarray, gold: np.ndarray, recall: float) -> float:
    """Of the thresholds that keep ``recall`` of the gold findings the one of the highest precision, the middle one of several."""
    order = np.argsort(-p, kind="stable")
    score, hits = p[order], np.cumsum(gold[order] > 0)
    if not len(p) or not hits[-1]:
        return 1.0
    ends = np.flatnonzero(np.append(score[:-1] != score[1:], True))  # a threshold lies between unequal scores
    ends = ends[hits[ends] >= recall * hits[-1]]
    precision = hits[ends] / (ends + 1)
    best = ends[precision >= precision.max() - 1e-12]
    k = best[len(best) // 2]
    return float((score[k] + (score[k + 1] if k + 1 < len(score) else 0.0)) / 2)
