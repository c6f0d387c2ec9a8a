"""Runs of repeating words, found by block convolution at doubling scales.

A run of period q repeats at least max(q, 12 - q) words at distance q, so at the scale B with
2 B - 1 <= q <= 4 B - 2 (at the first for all smaller q) that stretch holds a whole block of B words that
starts at a multiple of B. For each block an exact number-theoretic transform gives the sum of squared
differences to its words at every such distance; where it is zero, the distance seeds an extension to both
sides. Blocks with a word that does not come again within the distance cannot match and are left out, as
are those inside a run already found whose period they cover, where all matches are multiples of it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A run has so many words at least, and twice its period.
LEAST_RUN = 12
FIRST_BLOCK = 2
#: The longest part of a block that is transformed; longer distances are covered in several windows.
LONGEST_BLOCK = 2**17
#: The prime of the transform, 119 * 2**23 + 1, and a generator of its units.
PRIME, GENERATOR = 998244353, 3
#: Words worked on together, and numbers of a transform.
CHUNK_WORDS = 200_000
CHUNK_NUMBERS = 2**20
#: Words by which all seeds are extended together before the rest go one by one.
TOGETHER = 64

_P = np.uint64(PRIME)


class Transform:
    """The number-theoretic transform of a power-of-two length, along the last axis.

    Forward decimates in frequency and backward in time, so the order between them is of no account.
    """

    _kept: dict[int, Transform] = {}

    def __init__(self, size: int):
        self.roots, self.back = [], []
        half = size // 2
        while half:
            for kept, sign in ((self.roots, 1), (self.back, -1)):
                root = pow(GENERATOR, sign * ((PRIME - 1) // (2 * half)), PRIME)
                kept.append(powers(root, half))
            half //= 2
        self.scale = np.uint64(pow(size, -1, PRIME))

    @classmethod
    def of(cls, size: int) -> Transform:
        if size not in cls._kept:
            cls._kept[size] = cls(size)
        return cls._kept[size]

    def forward(self, values: np.ndarray) -> np.ndarray:
        out = values.astype(np.uint64)
        for roots in self.roots:
            pairs = out.reshape(len(out), -1, 2, len(roots))
            a, b = pairs[:, :, 0], pairs[:, :, 1]
            out = np.stack([reduced(a + b), (a + _P - b) * roots % _P], axis=2)
        return out.reshape(values.shape)

    def backward(self, values: np.ndarray) -> np.ndarray:
        out = values
        for roots in reversed(self.back):
            pairs = out.reshape(len(out), -1, 2, len(roots))
            a, b = pairs[:, :, 0], pairs[:, :, 1] * roots % _P
            out = np.stack([reduced(a + b), reduced(a + _P - b)], axis=2)
        return out.reshape(values.shape) * self.scale % _P


def reduced(values: np.ndarray) -> np.ndarray:
    """Numbers below twice the prime, modulo it."""
    return np.minimum(values, values - _P)  # below zero they wrap around and are the larger


def powers(root: int, count: int) -> np.ndarray:
    """1, root, root squared and so on, modulo the prime."""
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), PRIME)) % _P])
    return out[:count]


def mismatches(blocks: np.ndarray, windows: np.ndarray, largest: int) -> np.ndarray:
    """Zero where a block equals its window at an offset, else not: rows of sums of squared differences.

    ``blocks`` has rows of B words' numbers up to ``largest``, ``windows`` of at least 3 B - 1; offsets go
    from 0 to 2 B - 1. Numbers are cut into digits so small that no sum reaches the prime, so it is
    exact.
    """
    size = blocks.shape[1]
    digits = 1
    while (base := int(((PRIME - 1) // (digits * size)) ** 0.5)) ** digits <= largest:
        digits += 1
    transform = Transform.of(4 * size)
    wide = np.zeros((len(blocks), 4 * size), np.uint64)
    total = np.zeros((len(blocks), 2 * size), np.int64)
    for _ in range(digits):
        x, y = blocks % base, windows % base
        blocks, windows = blocks // base, windows // base
        wide[:, 1:] = 0
        wide[:, :size] = x[:, ::-1]
        held = np.zeros((len(y), 4 * size), np.uint64)
        held[:, : y.shape[1]] = y
        product = transform.backward(transform.forward(wide) * transform.forward(held) % _P)
        cross = product[:, size - 1 : 3 * size - 1].astype(np.int64)
        sums = np.concatenate([np.zeros((len(y), 1), np.int64), np.cumsum(held.astype(np.int64) ** 2, axis=1)], axis=1)
        squares = sums[:, size : 3 * size] - sums[:, : 2 * size]
        total += np.square(x).sum(axis=1, dtype=np.int64)[:, None] + squares - 2 * cross
    return total


def extended(words: np.ndarray, at: np.ndarray, far: np.ndarray, size: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The whole stretches in which words at distance ``far`` are equal, around blocks of ``size`` at ``at``.

    ``low`` and ``high`` are where the texts of the blocks begin and end."""
    end, start = at + size, at.copy()
    going = np.arange(len(at))
    for _ in range(TOGETHER):
        e = end[going]
        going = going[e + far[going] < high[going]]
        going = going[words[end[going]] == words[end[going] + far[going]]]
        if not len(going):
            break
        end[going] += 1
    for n in going.tolist():
        end[n] += run_length(words[end[n] : high[n] - far[n]], words[end[n] + far[n] : high[n]])
    going = np.arange(len(at))
    for _ in range(TOGETHER):
        going = going[start[going] > low[going]]
        going = going[words[start[going] - 1] == words[start[going] - 1 + far[going]]]
        if not len(going):
            break
        start[going] -= 1
    for n in going.tolist():
        start[n] -= run_length(words[low[n] : start[n]][::-1], words[low[n] + far[n] : start[n] + far[n]][::-1])
    return start, end


def run_length(one: np.ndarray, two: np.ndarray) -> int:
    """How many first items are equal, looked at in growing steps."""
    done, step = 0, 256
    while done < len(one):
        other = np.flatnonzero(one[done : done + step] != two[done : done + step])
        if len(other):
            return done + int(other[0])
        done, step = done + step, step * 2
    return len(one)


def next_places(words: np.ndarray) -> np.ndarray:
    """How far on each word comes again; very far if it does not."""
    order = np.argsort(words, kind="stable")
    ahead = np.full(len(words), 2**62, np.int64)
    same = words[order[1:]] == words[order[:-1]]
    ahead[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return ahead


@dataclass
class Texts:
    """Several texts' words as numbers, one after another. No number is in two texts, and a text's first is its smallest."""

    words: np.ndarray
    starts: np.ndarray

    def runs(self) -> np.ndarray:
        """Rows of text, start in it, length and smallest period of every run."""
        words, starts = self.words, self.starts
        lengths = np.diff(starts)
        ahead = next_places(words)
        longest = int(lengths.max(initial=0))
        found = np.zeros((0, 3), np.int64)
        # by word, of the run found last that covers it: its end and period
        run_end, run_period = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        size = FIRST_BLOCK
        while (least := 1 if size == FIRST_BLOCK else 2 * size - 1) * 2 <= longest:
            far = 4 * size - 2
            gone = np.concatenate([[0], np.cumsum(ahead > far)])
            text = np.repeat(np.arange(len(lengths)), lengths // size)
            count = np.cumsum(lengths // size) - lengths // size
            at = starts[text] + (np.arange(len(text)) - count[text]) * size
            keep = (gone[at + size] == gone[at]) & (at + size + least <= starts[text + 1])
            # within a known run that the window does not leave, or that the text ends with
            end = run_end[at]
            inside = (run_period[at] > 0) & (run_period[at] <= size)
            keep &= ~(inside & ((end >= at + far + size) | (end == starts[text + 1])))
            new = self._at_scale(at[keep], text[keep], size, least, far, run_end, run_period)
            found = np.concatenate([found, new])
            for start, stop, period in new.tolist():
                if run_end[start] < stop or period % run_period[start]:
                    run_end[start:stop], run_period[start:stop] = stop, period
            size *= 2
        if not len(found):
            return np.zeros((0, 4), np.int64)
        # a stretch has many periods; the smallest is the run's
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        first = np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(axis=1)])
        start, stop, period = found[first].T
        text = np.searchsorted(starts, start, side="right") - 1
        return np.stack([text, start - starts[text], stop - start, period], axis=1)

    def _at_scale(
        self, at: np.ndarray, text: np.ndarray, size: int, least: int, far: int, run_end: np.ndarray, run_period: np.ndarray
    ) -> np.ndarray:
        """Start, end and period of stretches around the blocks ``at`` that match at a distance of the scale."""
        words, starts = self.words, self.starts
        part = min(size, LONGEST_BLOCK)
        seeds = [np.zeros((0, 3), np.int64)]
        step = max(1, CHUNK_NUMBERS // (4 * part))
        for low in range(0, len(at), step):
            block, owner = at[low : low + step], text[low : low + step]
            base = words[starts[owner]]  # the text's smallest number
            x = words[block[:, None] + np.arange(part)] - base[:, None]
            high = starts[owner + 1]
            for distance in range(least, far + 1, 2 * part):
                where = block[:, None] + distance + np.arange(3 * part - 1)
                y = words[np.minimum(where, len(words) - 1)] - base[:, None]
                y[where >= high[:, None]] = 0
                largest = int(max(x.max(initial=0), y.max(initial=0)))
                zero = mismatches(x, y, largest) == 0
                distances = distance + np.arange(2 * part)
                zero &= (distances <= far) & (block[:, None] + distances + part <= high[:, None])
                n, d = np.nonzero(zero)
                seeds.append(np.stack([block[n], distances[d], owner[n]], axis=1))
        found = np.concatenate(seeds)
        block, distance, owner = found[np.lexsort((found[:, 0], found[:, 1]))].T
        # multiples of the period within a known run, and neighbours in one stretch, say nothing new
        known = (run_period[block] > 0) & (run_end[block] >= block + distance + part)
        known[known] = distance[known] % run_period[block[known]] == 0
        if size == part:
            known[1:] |= (np.diff(distance) == 0) & (np.diff(block) == size) & (np.diff(owner) == 0) & ~known[:-1]
        block, distance, owner = block[~known], distance[~known], owner[~known]
        start, end = extended(words, block, distance, part, starts[owner], starts[owner + 1])
        end = end + distance
        run = end - start >= np.maximum(LEAST_RUN, 2 * distance)
        return np.unique(np.stack([start[run], end[run], distance[run]], axis=1), axis=0)


def numbered(texts: list[list[bytes]]) -> Texts:
    """Words as numbers, in each text in order of first use, from where the text before ended."""
    numbers, base = [], 0
    for words in texts:
        own: dict[bytes, int] = {}
        numbers.append(np.fromiter((own.setdefault(w, len(own)) for w in words), np.int64, len(words)) + base)
        base += len(own)
    starts = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
    return Texts(np.concatenate(numbers) if numbers else np.zeros(0, np.int64), starts)


def periodic(words: list[bytes], key: int | None) -> list[bytes]:
    """The words of a document, of some keys with a periodic tail in place of their own.

    With h the CRC-32 of the decimal key, those with h divisible by 10. A null key changes nothing."""
    if key is None or not words or (h := zlib.crc32(str(key).encode())) % 10:
        return words
    n, g = len(words), h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    tail = words[start : start + period]
    return words[:start] + (tail * (-(-(n - start) // period)))[: n - start]


def summary(words: list[bytes], runs: np.ndarray) -> tuple:
    """What a document's row says of its runs (rows of start, length, period)."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    best: tuple = (None, None, None, None)
    kept = words
    if len(runs):
        start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
        best = (start, length, period, 1000 * length // period)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
    return (len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def periodic_runs(documents: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = True) -> DataFrame:
    """A row per document: key, ``n_runs``, of its longest run ``start``, ``length``, ``period``,
    ``exponent_milli``, and ``runs_sha256``, ``collapsed_sha256``.

    A run is a stretch of consecutive words (between ASCII white space) with smallest period q, of at
    least 12 and 2 q words, that no neighbouring word extends. The collapsed text lacks the words that
    follow a run's first q. With ``plant`` texts are first changed by ``periodic``, for keys that are
    whole numbers.

    Null, empty and blank texts have no words and no runs; a document's row depends on nothing but its
    key and text, so repeated rows give equal ones. Texts of any length are taken whole, one at a time
    if they are long. Other columns are not read; no rows give none. No shuffle.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for n in range(batch.num_rows):
                value, found = batch.column(1)[n], batch.column(0)[n].as_py()
                words = value.as_buffer().to_pybytes().split() if value.is_valid else []
                held.append((n, periodic(words, found) if plant else words))
                size += len(words)
                if size >= CHUNK_WORDS or n == batch.num_rows - 1:
                    yield rows(batch, held)
                    held, size = [], 0

    def rows(batch: pa.RecordBatch, held: list[tuple[int, list[bytes]]]) -> pa.RecordBatch:
        runs = numbered([words for _, words in held]).runs()
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        cuts = np.searchsorted(runs[:, 0], np.arange(len(held) + 1))
        found = [summary(words, runs[cuts[k] : cuts[k + 1], 1:]) for k, (_, words) in enumerate(held)]
        columns = list(zip(*found, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).slice(held[0][0], len(held)),
                *(pa.array(c, pa.int64()) for c in columns[:5]),
                *(pa.array(c, pa.string()) for c in columns[5:]),
            ],
            names=[key, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
        )

    kind = documents.schema[key].dataType.simpleString()
    longs = "n_runs long, start long, length long, period long, exponent_milli long"
    return documents.select(key, text).mapInArrow(find, f"`{key}` {kind}, {longs}, runs_sha256 string, collapsed_sha256 string")
