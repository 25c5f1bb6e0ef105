"""First-fit decreasing with a tournament tree over the bins' free space."""

from __future__ import annotations

import numpy as np


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each item.

    The tree holds each bin's free space at a leaf and the larger of two children
    above, so the first bin that fits is found by going left whenever the left
    side has room. Items of equal length keep their order.
    """
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < need:
                at += 1
        bins[item], offsets[item] = at - leaves, capacity - tree[at]
        tree[at] -= need
        while at > 1:
            at //= 2
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
    return bins, offsets
