"""ROC AUC over sliding windows of rows, in NumPy, for use inside tasks."""

from __future__ import annotations

import numpy as np


def rolling_auc(y, p, n: int, segment=None):
    """AUC of the last ``n`` rows at each row, and how many rows that window held.

    ``y`` is 0/1, ``p`` the score; ties count half. ``segment`` (constant on
    consecutive rows) bounds the windows. The AUC is NaN where the window has one
    class only or holds a missing label or score.

    Twice the number of rightly ordered pairs is an integer, so it can be kept up to
    date exactly: pairs enter with their newer row and leave with their older one. All rows
    advance together, one vector step per distance in 1..n-1.
    """
    y = np.asarray(y, dtype=np.float64)
    p = np.asarray(p, dtype=np.float64)
    m = len(y)
    if m == 0:
        return np.empty(0), np.empty(0, dtype=np.int64)
    bad = np.isnan(y) | np.isnan(p)
    p = np.where(bad, 0.0, p)
    pos = np.where(bad, 0, y > 0).astype(np.int64)
    sign = (2 * pos - 1).astype(np.int8)
    seg = np.zeros(m, dtype=np.int64) if segment is None else np.asarray(segment)

    enter = np.zeros(m, dtype=np.int64)
    leave = np.zeros(m, dtype=np.int64)
    for d in range(1, min(n, m)):
        new, old = slice(d, m), slice(0, m - d)
        order = (p[new] > p[old]).astype(np.int8) - (p[new] < p[old]).astype(np.int8)
        pair = np.where(
            (sign[new] != sign[old]) & (seg[new] == seg[old]), 1 + sign[new] * order, 0
        )
        enter[new] += pair
        leave[old] += pair

    row = np.arange(m)
    starts = np.r_[True, seg[1:] != seg[:-1]]
    seg_start = np.maximum.accumulate(np.where(starts, row, 0))
    first = np.maximum(seg_start, row - n + 1)

    def before(x):
        return np.r_[0, np.cumsum(x)]

    entered, left = before(enter), before(leave)
    twice = (entered[row + 1] - entered[seg_start]) - (left[first] - left[seg_start])
    size = row - first + 1
    pos_sum, bad_sum = before(pos), before(bad.astype(np.int64))
    n_pos = pos_sum[row + 1] - pos_sum[first]
    n_bad = bad_sum[row + 1] - bad_sum[first]
    pairs = n_pos * (size - n_pos)
    valid = (pairs > 0) & (n_bad == 0)
    auc = np.full(m, np.nan)
    auc[valid] = twice[valid] / 2.0 / pairs[valid]
    return auc, size
