"""Parts of sequences around anchors, by which equal windows of all sequences meet.

Of the grams of a window the one with the smallest hash, the leftmost of several, is its anchor.
Neighbouring windows with one anchor form a part, so every window of a sequence is in exactly one
part, and equal windows, wherever they are, have the same anchor at the same place.
"""

from __future__ import annotations

import numpy as np

_draw = np.random.default_rng(35)
#: Of the polynomial hash; odd, so that it has an inverse modulo 2 to the 64th.
FACTOR = int(_draw.integers(0, 2**63, dtype=np.uint64)) * 2 + 1
INVERSE = pow(FACTOR, -1, 2**64)
#: Windows looked at together; their places must fit the low bits of a hash.
PLACE_BITS = 20
PLACES = np.uint64(2**PLACE_BITS - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of the hash's factor and of its inverse, as many as have been asked for."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < size:
            last = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(FACTOR, last, 2**64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(INVERSE, last, 2**64))])
        return self.up, self.down


_powers = Powers()


class RangeHashes:
    """Hashes of any range of a sequence of codes, from running sums."""

    def __init__(self, codes: np.ndarray):
        up, self.down = _powers.of(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def running_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every window of so many values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def parts(codes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The parts of a sequence of well-mixed 64-bit codes: ``first`` window, number of windows
    (``count``), items ``before`` the anchor, hash of the ``anchor``, ``digest`` of all items."""
    windows, width = len(codes) - window + 1, window - gram + 1
    if windows < 1:
        none, code = np.zeros(0, np.int32), np.zeros(0, np.int64)
        return none, none, none, code, code
    hashes = RangeHashes(codes)
    at = np.arange(len(codes) - gram + 1)
    grams = hashes.of(at, at + gram)
    firsts, anchors = [], []
    step = 2**PLACE_BITS - width
    for start in range(0, windows, step):
        some = grams[start : start + min(step, windows - start) + width - 1]
        packed = (some & ~PLACES) | np.arange(len(some), dtype=np.uint64)
        where = (running_least(packed, width) & PLACES).astype(np.int64) + start
        change = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        firsts.append(change + start)
        anchors.append(where[change])
    first, anchor = np.concatenate(firsts), np.concatenate(anchors)
    count = np.diff(np.append(first, windows))
    digest = hashes.of(first, first + count - 1 + window) + mixed(count.astype(np.uint64))
    return (
        first.astype(np.int32), count.astype(np.int32), (anchor - first).astype(np.int32),
        grams[anchor].view(np.int64), digest.view(np.int64),
    )
