"""AUC of the last rows, kept up to date row by row."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections import deque
from collections.abc import Iterable


class WindowAuc:
    """ROC AUC of the last ``n`` pushed rows, ties counting half.

    The scores of each class are held in order, so the pairs that a row brings or takes away follow from its
    ranks among the other class. ``twice`` is twice the number of rightly ordered pairs, a whole
    number. There is no AUC with one class only, or with a missing label or score among the rows.
    """

    def __init__(self, n: int, rows: Iterable[tuple[float, float]] = (), twice: int | None = None):
        """With ``twice`` the rows of an earlier window are taken up without counting their pairs anew."""
        self.n, self.twice, self.missing = n, 0, 0
        self.rows: deque[tuple[float, float]] = deque()
        self._scores: dict[bool, list[float]] = {True: [], False: []}
        if twice is None:
            for y, p in rows:
                self.push(y, p)
            return
        self.rows.extend(rows)
        for y, p in self.rows:
            if math.isnan(y) or math.isnan(p):
                self.missing += 1
            else:
                self._scores[y > 0].append(p)
        for scores in self._scores.values():
            scores.sort()
        self.twice = twice

    def __len__(self) -> int:
        return len(self.rows)

    def _pairs(self, positive: bool, p: float) -> int:
        others = self._scores[not positive]
        below = bisect_left(others, p) + bisect_right(others, p)
        return below if positive else 2 * len(others) - below

    def push(self, y: float, p: float) -> None:
        if len(self.rows) == self.n:
            self._leave(*self.rows.popleft())
        self.rows.append((y, p))
        if math.isnan(y) or math.isnan(p):
            self.missing += 1
            return
        self.twice += self._pairs(y > 0, p)
        insort(self._scores[y > 0], p)

    def _leave(self, y: float, p: float) -> None:
        if math.isnan(y) or math.isnan(p):
            self.missing -= 1
            return
        scores = self._scores[y > 0]
        del scores[bisect_left(scores, p)]
        self.twice -= self._pairs(y > 0, p)

    def clear(self) -> None:
        self.rows.clear()
        self._scores = {True: [], False: []}
        self.twice = self.missing = 0

    @property
    def value(self) -> float | None:
        pairs = len(self._scores[True]) * len(self._scores[False])
        return self.twice / 2.0 / pairs if pairs and not self.missing else None
