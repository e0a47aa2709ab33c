"""Places of points along a Hilbert curve, many points at a time."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place along the curve of each row of cells (points x dimensions, integers from 0 to 2**bits - 1).

    Skilling's transform, applied to all points at once. dimensions * bits may be 63 at most.
    Points that follow each other along the curve touch; one dimension keeps its own order.
    """
    axes = [column.astype(np.int64) for column in cells.T]
    if not axes:
        return np.zeros(len(cells), np.int64)
    first = axes[0]
    for level in range(bits - 1, 0, -1):
        bit, low = np.int64(1 << level), np.int64((1 << level) - 1)
        for axis in axes:
            high = (axis & bit) != 0
            swap = np.where(high, 0, (first ^ axis) & low)
            if axis is first:
                first ^= np.where(high, low, 0)
            else:
                first ^= np.where(high, low, swap)
                axis ^= swap
    for before, axis in zip(axes, axes[1:]):
        axis ^= before
    turn = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    keys = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << 1) | (((axis ^ turn) >> level) & 1)
    return keys
