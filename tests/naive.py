"""Plain Python versions of operators, for comparison on small input."""

from __future__ import annotations

import math


def auc(labels, scores):
    """Rightly ordered share of (positive, negative) pairs; None with one class."""
    pos = [s for y, s in zip(labels, scores) if y > 0]
    neg = [s for y, s in zip(labels, scores) if y <= 0]
    if not pos or not neg:
        return None
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def monitor(rows, n, threshold, frac, accepts=None, cooldown=0, reset=True):
    """Row by row: ``(auc, in_window, alert, accepted)`` with a buffer of the last n rows."""
    buffer, last, since, out = [], 1.0, cooldown, []
    for i, (y, p) in enumerate(rows):
        buffer = (buffer + [(y, p)])[-n:]
        if not any(math.isnan(v) for r in buffer for v in r):
            now = auc([b[0] for b in buffer], [b[1] for b in buffer])
            last = last if now is None else now
        since += 1
        alert = last < threshold and len(buffer) > frac * n
        ok = alert and (accepts is None or accepts[i]) and since > cooldown
        out.append((last, len(buffer), alert, ok))
        if ok and reset:
            buffer, last, since = [], 1.0, 0
    return out


def counter(samples, frame):
    """``(t, step, increase, delta)`` per sample of one series ``[(t, value)]``."""
    out, previous, stepped = [], None, []
    for t, v in samples:
        step = 0 if previous is None else (v if v < previous else v - previous)
        previous = v
        stepped.append((t, v, step))
        inside = [s for s in stepped if t - frame <= s[0] <= t]
        delta = v - inside[0][1] if len(inside) >= 2 else None
        out.append((t, step, sum(s[2] for s in inside), delta))
    return out


def js(p, q):
    """Divergence of two lists of counts."""
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return total / 2


def quantile(values, prob):
    values = sorted(values)
    at = prob * (len(values) - 1)
    low = math.floor(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)
