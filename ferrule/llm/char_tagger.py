"""A character tagger in numpy: bidirectional LSTM scores, CRF transitions, Viterbi decoding."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tags: 0 outside, 1 + 2k begins kind k, 2 + 2k goes on with it.
TAGS = 1 + 2 * len(KINDS)
PAD, OTHER_LETTER, CLASSES = 0, 1, 130
WINDOW, STRIDE, HIDDEN = 96, 48, 16
BARRED = -1e4


def classes(text: str) -> np.ndarray:
    """A class per character: ASCII its own, every other character one."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(code < 128, code + 2, OTHER_LETTER).astype(np.int16)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _barred() -> np.ndarray:
    """Transition scores that rule out going on with a kind that has not begun."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = BARRED
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return out


class Tagger:
    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @staticmethod
    def new(seed: int = 3) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {}
        for side in "fb":
            p["x" + side] = rng.normal(0, 0.3, (CLASSES, 4 * HIDDEN))
            p["x" + side][:, HIDDEN:2 * HIDDEN] += 1.0  # remember by default
            p["h" + side] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        p["out"], p["bias"] = rng.normal(0, 0.3, (2 * HIDDEN, TAGS)), np.zeros(TAGS)
        p["bias"][0] = 2.0
        p["move"], p["start"], p["end"] = np.zeros((TAGS, TAGS)), np.zeros(TAGS), np.zeros(TAGS)
        return Tagger(p)

    def _states(self, x: np.ndarray, side: str, keep: bool):
        """Hidden states (T, B, HIDDEN) of one direction, and what the backward pass needs."""
        table, wh = self.p["x" + side], self.p["h" + side]
        b, n = x.shape
        h, c = np.zeros((b, HIDDEN), table.dtype), np.zeros((b, HIDDEN), table.dtype)
        states, kept = np.zeros((n, b, HIDDEN), table.dtype), []
        for t in range(n) if side == "f" else range(n - 1, -1, -1):
            z = table[x[:, t]] + h @ wh
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = (gates[:, k * HIDDEN:(k + 1) * HIDDEN] for k in (0, 1, 2))
            g = np.tanh(z[:, 3 * HIDDEN:])
            before_h, before_c = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[t] = h
            if keep:
                kept.append((t, i, f, o, g, tc, before_h, before_c))
        return states, kept

    def scores(self, x: np.ndarray, keep: bool = False):
        forward, kf = self._states(x, "f", keep)
        backward, kb = self._states(x, "b", keep)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["out"] + self.p["bias"], both, (kf, kb)

    def _moves(self) -> np.ndarray:
        return self.p["move"] + _barred().astype(self.p["move"].dtype)

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window (B, T)."""
        s, _, _ = self.scores(x)
        move = self._moves()
        n, b, _ = s.shape
        best, back = s[0] + self.p["start"], np.zeros((n, b, TAGS), np.int8)
        for t in range(1, n):
            paths = best[:, :, None] + move[None]
            back[t] = paths.argmax(1)
            best = np.take_along_axis(paths, back[t][:, None, :].astype(np.int64), 1)[:, 0] + s[t]
        tags = np.zeros((n, b), np.int8)
        tags[-1] = (best + self.p["end"]).argmax(1)
        rows = np.arange(b)
        for t in range(n - 1, 0, -1):
            tags[t - 1] = back[t][rows, tags[t]]
        return tags.T

    def gradient(self, x: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the gold tags and its gradient."""
        s, both, kept = self.scores(x, True)
        move, (n, b, _) = self._moves(), s.shape
        rows = np.arange(b)
        # forward and backward sums, each step scaled to one; exp of a barred move is zero
        step, shift = np.exp(move), s.max(2)
        e = np.exp(s - shift[:, :, None])
        alpha, beta, scale = np.zeros_like(s), np.zeros_like(s), np.zeros((n, b))
        for t in range(n):
            alpha[t] = e[t] * (alpha[t - 1] @ step if t else np.exp(self.p["start"]))
            scale[t] = alpha[t].sum(1)
            alpha[t] /= scale[t][:, None]
        last = alpha[-1] @ np.exp(self.p["end"])
        beta[-1] = np.exp(self.p["end"]) / last[:, None]
        for t in range(n - 2, -1, -1):
            beta[t] = (e[t + 1] * beta[t + 1]) @ step.T / scale[t + 1][:, None]
        total = np.log(last) + np.log(scale).sum(0) + shift.sum(0)
        ds = alpha * beta
        to_move = step * (alpha[:-1].reshape(-1, TAGS).T @ (e[1:] * beta[1:] / scale[1:, :, None]).reshape(-1, TAGS))
        g = gold.T
        told = s[np.arange(n)[:, None], rows[None], g].sum(0) + self.p["start"][g[0]] + self.p["end"][g[-1]]
        told += move[g[:-1], g[1:]].sum(0)
        grad = {"start": ds[0].sum(0), "end": ds[-1].sum(0), "move": to_move}
        np.add.at(grad["start"], g[0], -1)
        np.add.at(grad["end"], g[-1], -1)
        np.add.at(grad["move"], (g[:-1], g[1:]), -1)
        np.add.at(ds, (np.arange(n)[:, None], rows[None], g), -1)
        grad["out"] = both.reshape(n * b, -1).T @ ds.reshape(n * b, -1)
        grad["bias"] = ds.sum((0, 1))
        dh = ds @ self.p["out"].T
        for side, own, steps in (("f", dh[:, :, :HIDDEN], kept[0]), ("b", dh[:, :, HIDDEN:], kept[1])):
            self._back(x, side, own, steps, grad)
        return float((total - told).mean()), {k: v / b for k, v in grad.items()}

    def _back(self, x: np.ndarray, side: str, own: np.ndarray, steps: list, grad: dict) -> None:
        wh = self.p["h" + side]
        to_wh, at_gates = np.zeros_like(wh), np.zeros((*own.shape[:2], 4 * HIDDEN))
        carry_h, carry_c = np.zeros(own.shape[1:]), np.zeros(own.shape[1:])
        for t, i, f, o, g, tc, before_h, before_c in reversed(steps):
            h = own[t] + carry_h
            c = carry_c + h * o * (1 - tc * tc)
            dz = np.concatenate([c * g * i * (1 - i), c * before_c * f * (1 - f), h * tc * o * (1 - o), c * i * (1 - g * g)], 1)
            carry_c = c * f
            carry_h = dz @ wh.T
            to_wh += before_h.T @ dz
            at_gates[t] = dz
        flat = x.T.ravel()
        order = flat.argsort(kind="stable")
        own, first = np.unique(flat[order], return_index=True)
        grad["x" + side], grad["h" + side] = np.zeros_like(self.p["x" + side]), to_wh
        grad["x" + side][own] = np.add.reduceat(at_gates.reshape(-1, 4 * HIDDEN)[order], first)

    def train(self, x: np.ndarray, gold: np.ndarray, steps: int, batch: int, rate: float, seed: int = 4) -> list[float]:
        """Adam with a falling rate on random batches; the loss of each step."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            own = rng.choice(len(x), min(batch, len(x)), replace=False)
            loss, grad = self.gradient(x[own], gold[own])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            size = rate * (1.05 - step / steps)
            if norm > 5:
                grad = {k: g * (5 / norm) for k, g in grad.items()}
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] -= size * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
            losses.append(loss)
        return losses

    def light(self) -> dict[str, np.ndarray]:
        """The parameters as 32-bit floats, for decoding in tasks."""
        return {k: v.astype(np.float32) for k, v in self.p.items()}
