"""A learned index from rank to offset: error-bounded straight pieces and small corrections.

Offsets that grow nearly evenly, like the ends of a text's words, lie close to a few straight lines. A
piece is extended as long as one slope keeps all its offsets within the error bound; what a prediction
misses is stored in one byte, so a lookup is a search among the pieces, a product and a sum, and exact.
"""

from __future__ import annotations

import numpy as np

#: A prediction before rounding misses by no more, so that the rest fits a signed byte.
ERROR = 126
FIRST_LOOK = 64


class RankIndex:
    """``offsets`` by rank; they never fall. ``starts``, ``origins`` and ``slopes`` of the pieces, and
    the ``rest`` of each rank."""

    def __init__(self, offsets: np.ndarray):
        starts, slopes, begin = [], [], 0
        while begin < len(offsets):
            end, slope = self._piece(offsets, begin)
            starts.append(begin)
            slopes.append(slope)
            begin = end
        self.starts = np.array(starts, np.int64)
        self.slopes = np.array(slopes, np.float64)
        self.origins = offsets[self.starts] if len(starts) else np.zeros(0, np.int64)
        self.rest = (offsets - self.predict(np.arange(len(offsets)))).astype(np.int8)

    @staticmethod
    def _piece(offsets: np.ndarray, begin: int) -> tuple[int, float]:
        """End and slope of the longest piece from ``begin``: slopes that suit all offsets so far form
        an interval, which only narrows."""
        low, high, end, look = 0.0, np.inf, begin + 1, FIRST_LOOK
        while end < len(offsets):
            stop = min(len(offsets), end + look)
            steps, rise = np.arange(end - begin, stop - begin), offsets[end:stop] - offsets[begin]
            lows = np.maximum.accumulate(np.maximum((rise - ERROR) / steps, low))
            highs = np.minimum.accumulate(np.minimum((rise + ERROR) / steps, high))
            unfit = np.flatnonzero(lows > highs)
            fit = int(unfit[0]) if len(unfit) else stop - end
            if fit:
                low, high = float(lows[fit - 1]), float(highs[fit - 1])
            end += fit
            if len(unfit):
                break
            look *= 2
        return end, (low + high) / 2 if end > begin + 1 else 0.0

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """What the pieces alone say."""
        piece = np.searchsorted(self.starts, ranks, "right") - 1
        return self.origins[piece] + np.floor(self.slopes[piece] * (ranks - self.starts[piece]) + 0.5).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of these ranks."""
        return self.predict(ranks) + self.rest[ranks]
