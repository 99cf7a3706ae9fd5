"""Content-defined chunks: normalised gear-hash boundaries over UTF-8 bytes.

The gear hash of a place is a sum of table values of the last ``window`` bytes, each shifted once
more per byte of distance. With a window no longer than the least chunk, a cut depends on its own
chunk only, so equal texts, and equal passages after their first cut, are cut alike. Before the normal size a cut needs ``hard`` zero bits, after it only
``easy``, which narrows the spread of sizes. Cuts fall between code points.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np

from marginalia.llm.text import mix

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


@dataclass(frozen=True)
class Sizes:
    """Least, normal and greatest chunk bytes, zero bits before and after the normal size, and the
    window, a power of two up to 32."""

    least: int
    normal: int
    most: int
    hard: int
    easy: int
    window: int = 32


def gear(raw: np.ndarray, window: int = 32) -> np.ndarray:
    """The 32-bit gear hash after each byte, by doubling the window."""
    total, shift = _GEAR[raw], 1
    while shift < window:
        total[shift:] += total[:-shift].copy() << np.uint32(shift)
        shift *= 2
    return total


class Cuts:
    """Places where the bytes of one or more texts may be cut."""

    def __init__(self, raw: np.ndarray, sizes: Sizes):
        codes = gear(raw, sizes.window)
        inner = np.ones(len(raw), bool)
        # Byte i + 1 must not continue a code point.
        inner[:-1] = (raw[1:] & 0xC0) != 0x80
        easy = np.flatnonzero(inner & (codes >> np.uint32(32 - sizes.easy) == 0))
        hard = easy[codes[easy] >> np.uint32(32 - sizes.hard) == 0]
        self.raw, self.sizes = raw, sizes
        self.easy, self.hard = (easy + 1).tolist(), (hard + 1).tolist()

    def ends(self, start: int, stop: int) -> list[int]:
        """Ends of the chunks of the bytes from ``start`` to ``stop``."""
        sizes, raw, easy, hard = self.sizes, self.raw, self.easy, self.hard
        out = []
        while stop - start > sizes.least:
            limit = min(start + sizes.most, stop)
            middle = min(start + sizes.normal, limit)
            place = bisect_left(hard, start + sizes.least)
            if place < len(hard) and hard[place] < middle:
                end = hard[place]
            else:
                place = bisect_left(easy, middle)
                end = easy[place] if place < len(easy) and easy[place] <= limit else limit
                while end < stop and raw[end] & 0xC0 == 0x80:
                    end -= 1
            if end >= stop:
                break
            out.append(end)
            start = end
        if stop > start:
            out.append(stop)
        return out
