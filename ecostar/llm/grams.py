"""Distinct hashed character n-grams of whole texts, for the two classifiers."""

from __future__ import annotations

import numpy as np

#: Characters hashed at a time, so that memory doesn't grow with the length of a text.
WINDOW = 1 << 19
_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Sorted distinct buckets of the n-grams of ``orders`` in a text, case folded by ``str.lower``."""

    def __init__(self, orders: tuple[int, ...], bits: int):
        self.orders, self.shift = orders, np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        longest = max(self.orders)
        for at in range(0, len(text), WINDOW):
            piece = text[at : at + WINDOW + longest - 1].lower()
            codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            h = codes + np.uint64(1)
            for n in range(1, min(longest, len(codes)) + 1):
                if n > 1:
                    h = h[:-1] * _STEP + codes[n - 1 :] + np.uint64(1)
                if n in self.orders:
                    self.seen[((h * np.uint64(2 * n + 1) * _MIX) >> self.shift).astype(np.intp)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found.astype(np.int32)
