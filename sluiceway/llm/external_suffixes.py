"""Suffix arrays by induced sorting with queues that go to disk.

Suffixes are told apart by whether they are larger (L) or smaller (S) than the one behind them. The
leftmost S suffixes of runs, sorted, induce the order of all L suffixes, and these that of all S
suffixes. The leftmost ones are sorted by inducing the order of the substrings between them, which
get names, and sorting the string of names in the same way. A queue entry is a suffix with the
length of its common prefix with the entry before it, so common prefixes are induced as well.
"""

from __future__ import annotations

import heapq
import tempfile
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np

from sluiceway.llm.anchored import RangeHashes, mixed

#: Queue entries in memory; beyond, they are appended to a file that is gone with the process.
HELD_ENTRIES = 1_000_000
#: Entries taken from a queue at once.
SLICE = 1_000_000
#: A string of names up to this length is sorted in memory.
BASE_NAMES = 4_000_000
LOW = 255  # of an entry: the common prefix; the rest is the place


class DiskQueues:
    """First-in-first-out queues by key, their entries in memory or in one file."""

    def __init__(self, held: int):
        self.limit, self.held = held, 0
        self.queues: dict[int, deque] = defaultdict(deque)
        self.file = None

    def push(self, key: int, entries: np.ndarray) -> None:
        self.queues[key].append(entries)
        self.held += len(entries)
        if self.held > self.limit:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for queue in self.queues.values():
            # what is in memory lies behind what went to the file before, but for a part put back in front
            parts = [*queue]
            queue.clear()
            waiting: list[np.ndarray] = []
            for part in [*parts, None]:
                if isinstance(part, np.ndarray):
                    waiting.append(part)
                    continue
                if waiting:
                    queue.append((self.file.tell() // 8, sum(map(len, waiting))))
                    np.concatenate(waiting).tofile(self.file)
                    waiting = []
                if part is not None:
                    queue.append(part)
        self.file.flush()
        self.held = 0

    def read(self, part) -> np.ndarray:
        if isinstance(part, np.ndarray):
            return part
        self.file.seek(part[0] * 8)
        return np.fromfile(self.file, np.int64, part[1])

    def pop(self, key: int) -> np.ndarray | None:
        """The next entries of a queue, at most a slice; small parts come together."""
        queue = self.queues.get(key)
        if not queue:
            return None
        if isinstance(queue[0], tuple):
            start, size = queue.popleft()
            if size > SLICE:
                queue.appendleft((start + SLICE, size - SLICE))
            return self.read((start, min(size, SLICE)))
        parts, size = [], 0
        while queue and size < SLICE and isinstance(queue[0], np.ndarray):
            parts.append(queue.popleft())
            size += len(parts[-1])
        some = parts[0] if len(parts) == 1 else np.concatenate(parts)
        if size > SLICE:
            queue.appendleft(some[SLICE:])
        self.held -= min(size, SLICE)
        return some[:SLICE]

    def slices(self, key: int, backwards: bool = False) -> Iterator[np.ndarray]:
        """All entries of a queue, which keeps them, from either end, in slices."""
        parts = [*self.queues.get(key, ())]
        waiting: list[np.ndarray] = []

        def together() -> Iterator[np.ndarray]:
            some = np.concatenate(waiting[::-1] if backwards else waiting)
            waiting.clear()
            for start in range(0, len(some), SLICE):
                end = len(some) - start
                yield some[max(0, end - SLICE) : end][::-1] if backwards else some[start : start + SLICE]

        size = 0
        for part in reversed(parts) if backwards else parts:
            if isinstance(part, np.ndarray):
                waiting.append(part)
                size += len(part)
                if size >= SLICE:
                    yield from together()
                    size = 0
                continue
            if waiting:
                yield from together()
                size = 0
            starts = range(0, part[1], SLICE)
            for start in reversed(starts) if backwards else starts:
                some = self.read((part[0] + start, min(SLICE, part[1] - start)))
                yield some[::-1] if backwards else some
        if waiting:
            yield from together()

    def keys(self) -> list[int]:
        return [k for k, q in self.queues.items() if q]


class RangeLeast:
    """The smallest of any range of values, by tables of doubling spans."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (span := 2 ** (len(self.levels) - 1)) * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-span], last[span:]))
        self.logs = np.frexp(np.arange(len(values) + 1, dtype=np.float64))[1] - 1

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the values from start to before end; ranges are not empty."""
        log = self.logs[end - start]
        out = np.empty(len(start), self.levels[0].dtype)
        for k in np.unique(log):
            mine = log == k
            table = self.levels[int(k)]
            out[mine] = np.minimum(table[start[mine]], table[end[mine] - 2 ** int(k)])
        return out


def leftmost(text: np.ndarray) -> np.ndarray:
    """Places of the leftmost S suffixes, from blocks of the text, the last first."""
    found, step = [], 4_000_000
    smaller_next = True  # of the place behind the block: the last suffix counts as S
    for start in range((len(text) - 1) // step * step, -1, -step):
        block = np.asarray(text[start : start + step + 1], np.int64)
        size = min(step, len(text) - start)
        sign = np.sign(np.diff(block))
        if len(sign) < size:
            sign = np.append(sign, 1)
        # equal neighbours are as what follows them
        last = np.where(sign != 0, np.arange(size), size)
        last = np.minimum.accumulate(last[::-1])[::-1]
        small = np.append(sign, 1 if smaller_next else -1)[last] > 0
        if start + size < len(text) and smaller_next and not small[size - 1]:
            found.append(np.array([start + size]))  # the place behind the block
        found.append(np.flatnonzero(small[1:] & ~small[:-1]) + 1 + start)
        smaller_next = bool(small[0])
    return np.sort(np.concatenate(found))


def common_prefix(text: np.ndarray, one: int, two: int, depth: int) -> int:
    a, b = text[one : one + depth], text[two : two + depth]
    size = min(len(a), len(b))
    differ = np.flatnonzero(a[:size] != b[:size])
    return int(differ[0]) if len(differ) else size


class Induction:
    """The order of all suffixes of a text from that of its leftmost S suffixes. The text's last item
    is its only smallest one. ``depth``: common prefixes count up to it; 0: they are not kept."""

    def __init__(self, text: np.ndarray, depth: int, held: int):
        self.text, self.depth = text, depth
        self.larger, self.smaller = DiskQueues(held), DiskQueues(held)
        self.sorted_larger, self.sorted_smaller = DiskQueues(held), DiskQueues(held)
        self.symbols = int(text.max()) + 1 if depth else 0

    def deal(self, queues: DiskQueues, entries: np.ndarray, wanted, least: np.ndarray | None) -> None:
        """Push the suffixes before some, if of the wanted kind, each into the queue of its first item."""
        at = entries >> 8
        inside = at > 0
        before = np.where(inside, at - 1, 0)
        first = np.asarray(self.text[before])
        mine = np.flatnonzero(inside & wanted(first, np.asarray(self.text[at])))
        keys = first[mine]
        order = np.argsort(keys, kind="stable")
        keys, mine = keys[order], mine[order]
        if not len(mine):
            if self.depth:
                np.minimum(least, int((entries & LOW).min()), out=least)
            return
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        common = np.zeros(len(mine), np.int64)
        if self.depth:
            prefix = (entries & LOW).astype(np.uint8)
            table = RangeLeast(prefix)
            heads = keys[cuts].astype(np.int64)
            since = np.concatenate([[0], mine[:-1] + 1])  # of the entry pushed before to the same queue
            since[cuts] = 0
            common = table.of(since, mine + 1).astype(np.int64)
            common[cuts] = np.minimum(common[cuts], least[heads])
            np.minimum(least, int(prefix.min()), out=least)
            ends = mine[np.append(cuts[1:], len(mine)) - 1] + 1
            tail = np.full(len(heads), LOW, np.int64)
            left = ends < len(prefix)
            tail[left] = table.of(ends[left], np.full(int(left.sum()), len(prefix)))
            least[heads] = tail
            common = np.minimum(common + 1, self.depth)
        out = (before[mine] << 8) | common
        for start, end in zip(cuts, np.append(cuts[1:], len(mine)), strict=True):
            queues.push(int(keys[start]), out[start:end])

    def met(self, entries: np.ndarray, last: int | None) -> np.ndarray:
        """Entries whose first has its common prefix with the entry met before, compared item by item."""
        if not self.depth:
            return entries
        entries = entries.copy()
        known = 0
        if last is not None:
            known = common_prefix(self.text, last >> 8, int(entries[0]) >> 8, self.depth)
        entries[0] = (entries[0] & ~LOW) | known
        return entries

    def run(self, seeds: DiskQueues) -> None:
        is_larger = lambda first, second: first >= second
        least = np.full(self.symbols, 0, np.int64)
        for key in Keys(self.larger, seeds):
            last = None
            fresh = True
            while (some := self.larger.pop(key)) is not None:
                if fresh:
                    some, fresh = self.met(some, None), False
                self.sorted_larger.push(key, some)
                self.deal(self.larger, some, is_larger, least)
                last = int(some[-1])
            fresh = True
            for some in seeds.slices(key):
                if fresh:
                    some, fresh = self.met(some, last), False
                self.deal(self.larger, some, is_larger, least)
        least = np.full(self.symbols, 0, np.int64)
        self.smaller.push(int(self.text[-1]), np.array([(len(self.text) - 1) << 8]))  # nothing induces it
        for key in Keys(self.smaller, self.sorted_larger, down=True):
            last = None
            fresh = True
            while (some := self.smaller.pop(key)) is not None:
                if fresh:
                    some, fresh = self.met(some, None), False
                self.sorted_smaller.push(key, some)
                self.deal(self.smaller, some, lambda first, second: first <= second, least)
                last = int(some[-1])
            # L entries hold their common prefix with the smaller one; from above, it is with the larger
            carry = None
            for some in self.sorted_larger.slices(key, backwards=True):
                prefix = some & LOW
                turned = some.copy()
                if carry is None:
                    turned = self.met((some & ~LOW) | np.concatenate([[0], prefix[:-1]]), last)
                else:
                    turned = (some & ~LOW) | np.concatenate([[carry], prefix[:-1]])
                carry = int(prefix[-1])
                self.deal(self.smaller, turned, lambda first, second: first < second, least)

    def order(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in the order of their suffixes, and common prefixes with the suffix before, in slices."""
        for key in sorted({*self.sorted_larger.keys(), *self.sorted_smaller.keys()}):
            last = None
            for some in self.sorted_larger.slices(key):
                yield some >> 8, some & LOW
                last = int(some[-1])
            carry = None
            for some in self.sorted_smaller.slices(key, backwards=True):
                prefix = some & LOW  # with the larger one
                if carry is None:
                    carry = common_prefix(self.text, last >> 8, int(some[0]) >> 8, self.depth) if last is not None else 0
                yield some >> 8, np.concatenate([[carry], prefix[:-1]])
                carry = int(prefix[-1])


class Keys:
    """The keys of queues in order, also those that come up on the way."""

    def __init__(self, growing: DiskQueues, given: DiskQueues, down: bool = False):
        self.growing, self.down = growing, down
        self.rest = sorted(given.keys(), reverse=not down)  # the next is last

    def __iter__(self) -> Iterator[int]:
        sign = -1 if self.down else 1
        heap: list[int] = [sign * k for k in self.rest]
        heapq.heapify(heap)
        known = set(self.rest)
        while True:
            if len(self.growing.queues) > len(known & self.growing.queues.keys()):
                for key in self.growing.queues.keys() - known:
                    known.add(key)
                    heapq.heappush(heap, sign * key)
            if not heap:
                return
            yield sign * heapq.heappop(heap)


def seeds_of(text: np.ndarray, places: np.ndarray, prefixes: np.ndarray | None, held: int) -> DiskQueues:
    """Leftmost S suffixes in a given order, by their first item."""
    queues = DiskQueues(held)
    keys = np.asarray(text[places])
    order = np.argsort(keys, kind="stable")
    entries = ((places << 8) | (prefixes if prefixes is not None else 0))[order]
    keys = keys[order]
    if not len(keys):
        return queues
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    for start, end in zip(cuts, np.append(cuts[1:], len(keys)), strict=True):
        queues.push(int(keys[start]), entries[start:end])
    return queues


def by_doubling(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string in memory, by ranks of doubling prefixes."""
    size = len(names)
    rank, span = names.astype(np.int64), 1
    while True:
        behind = np.zeros(size, np.int64)
        behind[: max(0, size - span)] = rank[span:] + 1
        key = rank * (int(rank.max()) + 2) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank[order] = new
        if new[-1] == size - 1:
            return order
        span *= 2


def prefixes_of(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The common prefix of each suffix with the one before it, up to a depth, in blocks."""
    out = np.zeros(len(places), np.int64)
    last = len(text) - depth  # the last place with so many items
    items = np.lib.stride_tricks.sliding_window_view(text, depth) if last >= 0 else None
    for start in range(1, len(places), 100_000):
        one = places[start - 1 : min(start + 99_999, len(places) - 1)]
        two = places[start : start + len(one)]
        inside = np.flatnonzero(np.maximum(one, two) <= last)
        if len(inside):
            same = items[one[inside]] == items[two[inside]]
            out[start + inside] = np.where(same.all(axis=1), depth, same.argmin(axis=1))
        for n in np.flatnonzero(np.maximum(one, two) > last).tolist():
            out[start + n] = common_prefix(text, int(one[n]), int(two[n]), depth)
    return out


def sorted_leftmost(text: np.ndarray, held: int, base: int) -> np.ndarray:
    """The leftmost S suffixes in order."""
    places = leftmost(text)
    if len(places) < 2:
        return places
    first = Induction(text, 0, held)
    first.run(seeds_of(text, places, None, held))
    is_leftmost = np.zeros(len(text), bool)
    is_leftmost[places] = True
    by_substring = np.concatenate([some[is_leftmost[some]] for some, _ in first.order()])
    # substrings are equal if their lengths and hashes are; each reaches to the next leftmost place, and with it
    number = np.searchsorted(places, by_substring)
    ends = np.append(places[1:], len(text) - 1) + 1
    hashes = RangeHashes(mixed(np.asarray(text).astype(np.uint64) + np.uint64(1))).of(by_substring, ends[number])
    sizes = ends[number] - by_substring
    new = np.concatenate([[0], np.cumsum((hashes[1:] != hashes[:-1]) | (sizes[1:] != sizes[:-1]))])
    names = np.empty(len(places), np.int64)
    names[number] = new
    if new[-1] == len(places) - 1:
        return by_substring
    if len(names) <= base:
        return places[by_doubling(names)]
    # the last place is that of the text's smallest item, so the string of names ends in its only smallest one
    return places[suffix_order(names, held, base)]


def suffix_order(text: np.ndarray, held: int, base: int) -> np.ndarray:
    """All suffixes of a string whose last item is its only smallest one."""
    induced = Induction(text, 0, held)
    induced.run(seeds_of(text, sorted_leftmost(text, held, base), None, held))
    return np.concatenate([some for some, _ in induced.order()])


def suffixes(
    text: np.ndarray, depth: int, held: int = HELD_ENTRIES, base: int = BASE_NAMES
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes in order with their common prefixes up to ``depth``, under 256, in slices.

    The text, an array or a mapped file, ends in its only smallest item.
    """
    order = sorted_leftmost(text, held, base)
    induced = Induction(text, depth, held)
    induced.run(seeds_of(text, order, prefixes_of(text, order, depth), held))
    yield from induced.order()
