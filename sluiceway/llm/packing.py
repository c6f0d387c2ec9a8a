"""Best-fit packing of token sequences, improved by swaps between underfull bins."""

from __future__ import annotations

import bisect
import heapq
import itertools
import json
import os
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluiceway.llm.shared import Staged, part_count, portions
from sluiceway.llm.token_counts import byte_symbols

#: Pieces that are packed together, in one task.
GROUP_ROWS = 100_000
#: Parts of words whose identifiers a worker keeps in each of two generations.
KEPT_WORDS = 500_000
# Fixed value: the pattern of vocabularies with letters, single digits and other signs as words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = {kind: "".join(f"\\x{n:02x}" for n in range(256) if unicodedata.category(chr(n))[0] == kind) for kind in "LN"}
#: The same for signs of Latin-1.
PARTS = re.compile(f"[{LATIN['L']}]+|[{LATIN['N']}]|'(?:[stmd]|re|ve|ll)|[^ \\t-\\r\\x85\\xa0{LATIN['L']}{LATIN['N']}]+")
# Fixed value: what such vocabularies do to a text before.
SIMPLE = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}


def written(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class WordIds:
    """Identifiers by part of a word as bytes of little-endian 32-bit numbers, from the vocabulary's own library.

    Parts are kept in two generations: when the new one is full it becomes the old one, from which
    parts that come again are taken over.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        spec = json.loads(self.tokenizer.to_str())
        splits = spec["pre_tokenizer"] == {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        }
        self.simple = spec["normalizer"] == SIMPLE and splits
        self.simple &= all(x["content"].startswith("<|") for x in spec["added_tokens"])
        self.merges = self.tokenizer.model  # the library's, for parts whose bytes have been spelled
        self.symbols = dict(enumerate(byte_symbols()))

    def plain(self, text: str) -> bool:
        """Whether the parts of a text are known without the library.

        Signs of Latin-1 are never composed and have one small letter each, so their words are parted as the
        library would, unless they may spell a special string.
        """
        if not self.simple or "<|" in text:
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def parts(self, text: str) -> list[str]:
        """What a text's identifiers follow from one by one: parts of words in lower case, or whole words.

        No token reaches across ASCII white space.
        """
        if self.plain(text):
            return PARTS.findall(text.lower())
        words = [x.decode() for x in text.encode().split()]
        return [part for word in words for part in (PARTS.findall(word.lower()) if self.plain(word) else (word,))]

    def learn(self, parts: set[str]) -> None:
        plain, whole = [], []
        for part in parts:
            if (ids := self.old.get(part)) is not None:
                self.known[part] = ids
            else:
                (plain if self.plain(part) else whole).append(part)
        for part in plain:
            spelled = part
            if not (part.isascii() and part.isprintable()):
                spelled = part.encode().decode("latin-1").translate(self.symbols)
            self.known[part] = written([token.id for token in self.merges.tokenize(spelled)])
        if whole:
            found = self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)
            self.known.update((part, written(encoding.ids)) for part, encoding in zip(whole, found, strict=True))

    def of(self, texts: list[bytes]) -> Iterator[bytes]:
        """The identifiers of each text."""
        if len(self.known) >= KEPT_WORDS:
            self.known, self.old = {}, self.known
        parted = [self.parts(text.decode()) for text in texts]
        found = [[*map(self.known.get, parts)] for parts in parted]
        self.learn({p for parts, own in zip(parted, found, strict=True) for p, ids in zip(parts, own, strict=True) if ids is None})
        for parts, own in zip(parted, found, strict=True):
            if None in own:
                own = [self.known[p] if ids is None else ids for p, ids in zip(parts, own, strict=True)]
            yield b"".join(own)


_ids: dict[str, WordIds] = {}


def ids_for(path: str) -> WordIds:
    """The worker's identifiers for a vocabulary file, kept from task to task."""
    if path not in _ids:
        _ids[path] = WordIds(path)
    return _ids[path]


def cut(documents: DataFrame, key: str, text: str, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """A row per piece of at most ``size`` tokens: key, piece, start, length, ids_crc32."""
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = ids_for(vocabulary)
        for batch in (some for whole in batches for some in portions(whole)):
            rows: list[tuple[int, int, int, int, int]] = []
            for i, ids in enumerate(words.of([(x or "").encode() for x in batch.column(1).to_pylist()])):
                ids += end
                for n, start in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[start : start + 4 * size]
                    rows.append((i, n, start // 4, len(part) // 4, zlib.crc32(part)))
            where, *rest = np.array(rows, np.int64).reshape(-1, 5).T.copy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(where)), *map(pa.array, rest)],
                names=[key, "piece", "start", "length", "ids_crc32"],
            )

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(
        pieces, f"`{key}` {kind}, piece long, start long, length long, ids_crc32 long"
    )


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of indexes: longest first, each into the fullest bin it fits."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms: list[int] = []  # that some bin has, sorted
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        at = bisect.bisect_left(rooms, need)
        if at == len(rooms):
            room, which = size, len(bins)
            bins.append([])
        else:
            room = rooms[at]
            which = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        bins[which].append(int(i))
        if left := room - need:
            if not by_room[left]:
                bisect.insort(rooms, left)
            by_room[left].append(which)
    return bins


class SwapSearch:
    """Empties underfull bins by moves and swaps, each of which raises the sum of squared fills.

    Bins are gone over from the emptiest on, and give to bins that are at least as full, again and
    again until none of them could give anything. A bin's pieces have few lengths, as these sum to
    less than its size, so all sums of one or two are looked at; of the pieces to take in return, the
    one of each length whose bin has the most room decides, and a heap for each length knows it.
    """

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], size: int):
        fills = [int(lengths[b].sum()) for b in bins]
        self.size = size
        self.full = [b for b, fill in zip(bins, fills, strict=True) if fill >= size]
        under = [b for b, fill in zip(bins, fills, strict=True) if fill < size]
        self.fill = np.array([fill for fill in fills if fill < size], np.int64)
        self.members: list[dict[int, list[int]]] = []  # of each bin, pieces by length
        for held in under:
            own: dict[int, list[int]] = {}
            for item, length in zip(held, lengths[held].tolist(), strict=True):
                own.setdefault(length, []).append(item)
            self.members.append(own)

    def run(self) -> list[list[int]]:
        changed = True
        while changed and not self.done():
            changed = self.sweep()
        return self.full + [[item for held in own.values() for item in held] for own in self.members if own]

    def done(self) -> bool:
        """Whether no bin can go, as the others have no room for what one holds."""
        return self.size * int((self.fill > 0).sum()) - int(self.fill.sum()) < self.size

    def sweep(self) -> bool:
        """Go over all bins once, those that took something meanwhile left out; whether anything moved."""
        live = np.flatnonzero(self.fill > 0)
        order = live[np.argsort(self.fill[live], kind="stable")].tolist()
        self.age = np.zeros(len(self.fill), np.int64)  # one more each time that a bin's room is noted
        self.closed = np.zeros(len(self.fill), bool)  # emptier than the bin that gives, or that bin
        self.rising = [(int(self.fill[n]), n) for n in order]  # bins by fill, to be closed in turn
        self.heaps: list[list[tuple[int, int, int]]] = [[] for _ in range(self.size + 1)]
        for n in order:
            for length in self.members[n]:
                self.heaps[length].append((int(self.fill[n]) - self.size, n, 0))
        self.room = np.full(self.size + 1, -1, np.int64)  # the most room of an open bin with a piece of each length
        self.where = np.zeros(self.size + 1, np.int64)
        for length, heap in enumerate(self.heaps):
            if heap:
                heapq.heapify(heap)
                self.look(length)
        changed, took = False, np.array(self.fill)
        for turn, source in enumerate(order):
            fill = int(self.fill[source])
            if fill != took[source]:
                continue
            while self.rising and self.rising[0][0] < fill:
                low, n = heapq.heappop(self.rising)
                if low == self.fill[n]:
                    self.close(n)
            self.close(source)
            gave = self.move(source)
            while self.members[source] and self.swap(source):
                gave = True
            changed |= gave
            if gave and self.done():
                break
            if not gave and turn + 1 < len(order) and self.fill[order[turn + 1]] == fill:
                self.closed[source] = False  # open for the others that are as full
                self.noted(source)
        return changed

    def close(self, n: int) -> None:
        self.closed[n] = True
        for length in self.members[n]:
            if self.where[length] == n:
                self.look(length)

    def look(self, length: int) -> None:
        """Find the open bin with the most room that holds a piece of this length."""
        heap = self.heaps[length]
        while heap and (self.closed[n := heap[0][1]] or heap[0][2] != self.age[n] or length not in self.members[n]):
            heapq.heappop(heap)
        self.room[length], self.where[length] = (-heap[0][0], heap[0][1]) if heap else (-1, 0)

    def noted(self, n: int, gone: int = -1) -> None:
        """Note the room of an open bin for all its lengths, and for one that it may have lost."""
        self.age[n] += 1
        heapq.heappush(self.rising, (int(self.fill[n]), n))
        for length in self.members[n]:
            heapq.heappush(self.heaps[length], (int(self.fill[n]) - self.size, n, int(self.age[n])))
            self.look(length)
        if gone >= 0:
            self.look(gone)

    def put(self, length: int, source: int, target: int) -> None:
        held = self.members[source][length]
        self.members[target].setdefault(length, []).append(held.pop())
        if not held:
            del self.members[source][length]
        self.fill[source] -= length
        self.fill[target] += length

    def move(self, source: int) -> bool:
        """Each piece, the longest first, into the bin that it fills best of those at least as full."""
        if min(self.members[source]) > self.size - int(self.fill[source]):
            return False  # nor has a fuller bin room for it
        changed = False
        for length in sorted(self.members[source], reverse=True):
            while length in self.members[source]:
                room = np.where((self.fill >= self.fill[source]) & ~self.closed, self.size - self.fill, -1)
                fits = np.flatnonzero(room >= length)
                if not len(fits):
                    break
                target = int(fits[room[fits].argmin()])
                self.put(length, source, target)
                self.noted(target)
                changed = True
        return changed

    def swap(self, source: int) -> bool:
        """The exchange of one or two pieces for a smaller one that fills the other bin most."""
        own = self.members[source]
        offers = {length: (length,) for length in own}
        for one, two in itertools.combinations_with_replacement(sorted(own), 2):
            if one != two or len(own[one]) > 1:
                offers.setdefault(one + two, (one, two))
        sums = np.zeros(self.size + 1, np.int64)
        sums[[*offers]] = [*offers]
        largest = np.maximum.accumulate(sums)  # sum up to each number
        lengths = np.flatnonzero(self.room > 0)
        gains = largest[np.minimum(lengths + self.room[lengths], self.size)] - lengths
        if not len(lengths) or gains.max() <= 0:
            return False
        best = int(gains.argmax())
        back = int(lengths[best])
        target = int(self.where[back])
        self.put(back, target, source)
        for length in offers[back + int(gains[best])]:
            self.put(length, source, target)
        self.noted(target, back)
        return True


def pack_lengths(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of indexes, as few as best fit and the swaps reach."""
    return SwapSearch(lengths, best_fit(lengths, size), size).run()


def pack(
    documents: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    size: int = 2048,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """A row per piece: key, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is its identifiers and ``end_id``; only those over ``size`` are cut. Null and empty
    texts are ``end_id`` alone; equal rows are packed each; a null key stays null; other columns
    are not read; no documents give no rows.

    Only the pieces' numbers are shuffled, evenly over groups of at most about ``group_rows``
    pieces; each group packs its own, which leaves about one bin a group not full.
    """
    staged = Staged(cut(documents, key, text, vocabulary, end_id, size), "pieces").read()
    groups = part_count(documents.sparkSession, staged.count(), group_rows)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        group = TaskContext.get().partitionId()
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        lengths = rows.column("length").to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n, members in enumerate(pack_lengths(lengths, size)):
            sequence[members] = (group << 32) + n
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        yield from rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).to_batches(
            max_chunksize=10_000
        )

    kind = documents.schema[key].dataType.simpleString()
    return staged.repartition(groups).mapInArrow(
        packed,
        f"`{key}` {kind}, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
