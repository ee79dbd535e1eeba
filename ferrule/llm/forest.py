"""Spanning links of the pairs found inside one task.

A dense group of n near copies has about n*n/2 links; what must leave the task
is a forest that connects the same rows: at most one link a row.
"""

from __future__ import annotations

import numpy as np


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Fold the links ``a[i]``-``b[i]`` (row numbers) into ``labels`` in place.  Afterwards linked rows
    have one label, the smallest row number among them."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        low = np.minimum(la, lb)
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped
