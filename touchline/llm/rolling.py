"""Hashes of any part of a sequence, from one pass of numpy over it.

The hash of symbols s..e is ``sum(symbol[i] * B**(i - s))`` modulo 2**64, mixed with the length. It comes from the
difference of two prefix sums, so that all windows, words or contexts of a batch are hashed at once.
"""

from __future__ import annotations

import numpy as np

_B = 0x9E3779B97F4A7C15
_BELOW = (1 << 24) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Roller:
    """Keeps the powers of the base; make one for each task."""

    def __init__(self) -> None:
        self.bytes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_B)) | np.uint64(1)
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.up, self.down = (np.full(n, b % 2**64, np.uint64) for b in (_B, pow(_B, -1, 2**64)))
        for powers in (self.up, self.down):
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        n = len(symbols)
        if n + 1 > len(self.up):
            self._grow(n + n // 4 + 2)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * self.up[:n], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of each part start..end of the sequence that ``sums`` is the prefix of."""
        return mix((sums[end] - sums[start]) * self.down[start] ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))

    def words(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of the words ``[^\\x20\\x09-\\x0D]+`` of a buffer of UTF-8."""
        inside = np.zeros(len(buffer) + 2, bool)
        inside[1:-1] = ~((buffer == 32) | ((buffer >= 9) & (buffer <= 13)))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        return self.spans(self.prefix(self.bytes[buffer]), start, end), start, end

    def anchors(self, symbols: np.ndarray, ends: np.ndarray, window: int, gram: int):
        """Cut all windows of ``window`` symbols into runs that share an anchor.

        The anchor of a window is the least hash of a ``gram`` of symbols in it, the first of equal ones, so that
        it depends on the window's symbols alone. ``ends`` holds, for each symbol, where its document ends; no
        window crosses that. At most 2**24 symbols at once. Gives, for each run: the anchor's hash and place, the
        first and last start of a window, and the hash of all that its windows cover."""
        n = len(symbols)
        none = np.zeros(0, np.int64)
        if n < window:
            return none.view(np.uint64), none, none, none, none.view(np.uint64)
        sums = self.prefix(symbols)
        places = np.arange(n - gram + 1)
        grams = self.spans(sums, places, places + gram)
        # the place in the low bits makes the first of equal hashes the least
        least = (grams & ~np.uint64(_BELOW)) | places.astype(np.uint64)
        width, wanted = 1, window - gram + 1
        while width * 2 <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wanted:
            least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
        start = np.flatnonzero(ends[: n - window + 1] - np.arange(n - window + 1) >= window)
        if not len(start):
            return none.view(np.uint64), none, none, none, none.view(np.uint64)
        at = (least[start] & np.uint64(_BELOW)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
        last = np.concatenate((new[1:], [len(at)])) - 1
        place, first, final = at[new], start[new], start[last]
        return grams[place], place, first, final, self.spans(sums, first, final + window)
