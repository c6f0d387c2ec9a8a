"""Token counts by byte-pair merging with a heap over a linked list; no identifiers are made."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Words whose counts a worker keeps; when full, it starts anew.
KEPT_WORDS = 400_000


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    extra = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(extra)) for b in range(256)]


class PairMerger:
    """Counts of one vocabulary file whose pre-tokens end with a suffix, such as ``</w>``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        normal = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
        kinds = [x["type"] for x in normal.get("normalizers", [normal])]
        unknown = set(kinds) - {"NFC", "Replace", "Lowercase"}
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if unknown or split["type"] != "Split" or level["type"] != "ByteLevel" or model["type"] != "BPE":
            raise ValueError(f"{path}: only byte-level pair merging after a split is known")
        self.nfc, self.lower = "NFC" in kinds, "Lowercase" in kinds
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.known = model["vocab"].keys()
        self.symbols = byte_symbols()
        special = [x["content"] for x in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def merged(self, token: str) -> int:
        """Symbols of a pre-token less the merges made: lowest rank first, then leftmost."""
        parts = [self.symbols[b] for b in token.encode()]
        parts[-1] += self.suffix
        parts = [x for x in parts if x in self.known]
        size = len(parts)
        if size < 2:
            return size
        ranks, after, before = self.ranks, [*range(1, size), -1], [*range(-1, size - 1)]
        heap = [
            (rank, i, parts[i], parts[i + 1])
            for i in range(size - 1)
            if (rank := ranks.get((parts[i], parts[i + 1]))) is not None
        ]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue  # one of the pair has been merged meanwhile
            merges += 1
            parts[i], parts[j] = left + right, None
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (rank := ranks.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (rank, i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (rank := ranks.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (rank, h, parts[h], parts[i]))
        return size - merges

    def plain(self, text: str) -> int:
        if not text.isascii() and self.nfc:
            text = unicodedata.normalize("NFC", text)
        if self.lower:  # letter by letter: no final sigma
            text = text.replace("Σ", "σ").lower()
        return sum(map(self.merged, self.pattern.findall(text)))

    def word(self, text: str) -> int:
        """Tokens of a text without white space; special strings count one each."""
        if self.special is None or "<" not in text:
            return self.plain(text)
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(map(self.plain, pieces))


class WordCounts(dict):
    """Counts by word, made when missing; bounded."""

    def __init__(self, merger: PairMerger):
        super().__init__()
        self.merger = merger

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = count = self.merger.word(word.decode())
        return count

    def of(self, text: bytes) -> int:
        return sum(map(self.__getitem__, text.split()))


_counts: dict[str, WordCounts] = {}


def counts_for(path: str) -> WordCounts:
    """The worker's counts for a vocabulary file, kept from task to task."""
    if path not in _counts:
        _counts[path] = WordCounts(PairMerger(path))
    return _counts[path]


def token_counts(documents: DataFrame, vocabulary: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: key, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``vocabulary`` is a file that every executor has. Texts are cut at ASCII white space, across
    which no token reaches, and each word's count is kept. Null and empty texts have no tokens;
    equal rows are counted each; other columns are not read; no rows give none. No shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counts_for(vocabulary)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                data = b"" if (found := value.as_py()) is None else found.encode()
                n_bytes.append(len(data))
                n_tokens.append(counts.of(data))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                ],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(
        count, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
