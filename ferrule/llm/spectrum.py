"""The spectrum of centred scatter, kept up to date by rank-one updates of its eigendecomposition.

``update`` adds ``rho * v v'`` to ``U diag(w) U'``: with ``z = U' v`` the new eigenvalues are the roots of the secular equation
``1 + rho * sum(z_j^2 / (w_j - x)) = 0``, one between each two old ones.  Entries of ``z`` too small to matter and equal eigenvalues
(a reflection leaves one entry of ``z`` for each) are deflated first.  All roots are found together, as distances from their nearest old
eigenvalue, by rational interpolation kept inside brackets; ``z`` is then recomputed from the roots, which keeps the eigenvectors orthogonal.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ascending distinct ``d`` and positive ``z2``: the roots of ``1 + sum(z2 / (d - x))`` and the matrix of
    ``d_j - x_i`` (row i), each exact to rounding."""
    k = len(d)
    total = z2.sum()
    gap = np.append(d[1:] - d[:-1], total)
    # the sign at the middle of each interval tells which end is nearer
    middle = d + gap / 2
    at_middle = 1 + (z2 / (d[None, :] - middle[:, None])).sum(1)
    right = at_middle < 0
    right[-1] = False
    origin = np.arange(k) + right
    delta = d[None, :] - d[origin][:, None]  # poles as seen from each root's origin
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap / 2)
    if at_middle[-1] < 0:
        low[-1], high[-1] = gap[-1] / 2, gap[-1]
    else:
        high[-1] = gap[-1] / 2
    t = (low + high) / 2
    below = np.arange(k)[None, :] <= np.arange(k)[:, None]
    z_low, z_high = np.where(below, z2, 0.0), np.where(below, 0.0, z2)
    own = np.arange(k)
    after = np.minimum(own + 1, k - 1)
    live = np.ones(k, bool)
    for _ in range(80):
        inverse = 1 / (delta - t[:, None])
        low_terms, high_terms = z_low * inverse, z_high * inverse
        psi, phi = low_terms.sum(1), high_terms.sum(1)
        f = 1 + psi + phi
        low = np.where(f < 0, t, low)
        high = np.where(f >= 0, t, high)
        live &= (np.abs(f) > 4 * EPS * (1 + np.abs(psi) + np.abs(phi))) & (high - low > 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if not live.any():
            break
        # each side as a constant and its nearest pole, matching value and slope
        near, far = delta[own, own] - t, delta[own, after] - t
        dpsi, dphi = (low_terms * inverse).sum(1), (high_terms * inverse).sum(1)
        c = 1 + (psi - dpsi * near) + np.where(own < k - 1, phi - dphi * far, 0.0)
        p, q = dpsi * near * near, dphi * far * far
        with np.errstate(all="ignore"):
            a = c * (near + far) + p + q
            b = near * far * c + p * far + q * near
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = near[-1] + p[-1] / c[-1]
            new = t + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        t = np.where(live, np.where(inside, new, (low + high) / 2), t)
    return d[origin] + t, delta - t[:, None]


def update(w: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues (ascending) and eigenvectors (columns) of ``u diag(w) u' + rho v v'``, rho > 0."""
    z = u.T @ v * np.sqrt(rho)
    size = max(np.abs(w).max(initial=0.0), float(z @ z))
    if size == 0:
        return w, u
    tol = 8 * EPS * size
    keep = np.abs(z) * np.sqrt(size) > tol
    chosen = np.flatnonzero(keep)
    if len(chosen) == 0:
        return w, u
    u = u.copy()
    groups = np.split(chosen, np.flatnonzero(np.diff(w[chosen]) > tol) + 1)
    active = []
    for g in groups:  # equal eigenvalues: reflect so that the last alone sees the update
        if len(g) > 1:
            own = z[g]
            length = np.sqrt(own @ own)
            h = own.copy()
            h[-1] += np.copysign(length, own[-1])
            u[:, g] -= np.outer(u[:, g] @ h, h) * (2 / (h @ h))
            z[g] = 0
            z[g[-1]] = -np.copysign(length, own[-1])
        active.append(g[-1])
    active = np.array(active)
    d, own = w[active], z[active]
    roots, differences = secular_roots(d, own * own)
    # z anew from the roots (products of ratios of neighbouring differences), then the vectors
    apart = d[:, None] - d[None, :]
    np.fill_diagonal(apart, 1.0)
    ratio = -differences / np.where(np.eye(len(d), dtype=bool), 1.0, -apart)
    z2 = np.abs(np.prod(ratio, axis=0))
    vectors = np.copysign(np.sqrt(z2), own)[:, None] / differences.T
    vectors /= np.sqrt((vectors * vectors).sum(0))
    w = w.copy()
    w[active] = roots
    u[:, active] = u[:, active] @ vectors
    order = np.argsort(w, kind="stable")
    return w[order], u[:, order]


class Spectrum:
    """Number, mean and eigendecomposition of the centred scatter of the vectors added so far."""

    def __init__(self, n: int, mean: np.ndarray, w: np.ndarray, u: np.ndarray):
        self.n, self.mean, self.w, self.u = n, mean, w, u

    @staticmethod
    def empty(length: int) -> Spectrum:
        return Spectrum(0, np.zeros(length), np.zeros(length), np.eye(length))

    def add(self, x: np.ndarray) -> None:
        apart = x - self.mean
        self.n += 1
        self.mean = self.mean + apart / self.n
        if self.n > 1:
            self.w, self.u = update(self.w, self.u, apart, (self.n - 1) / self.n)

    def merge(self, other: Spectrum) -> None:
        """Takes in another spectrum: a rank-one update for each of its eigenpairs and one for the means' difference."""
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.w, self.u = other.n, other.mean, other.w, other.u
            return
        apart, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.w, other.u.T, strict=True):
            if value > 0:
                self.w, self.u = update(self.w, self.u, vector, value)
        self.w, self.u = update(self.w, self.u, apart, self.n * other.n / n)
        self.mean, self.n = self.mean + apart * (other.n / n), n
