"""Repeated passages by relative Lempel-Ziv parsing against reference blocks.

Equal windows of words have the same anchor, so a document's parts need comparing only with the
parts of their own anchors. The parts of one anchor are the reference block that each of them is
factored against, by an index of the block. Matches count where they lie at the same place from the
anchor: elsewhere they may be the same words of one document. A part that is equal to another is one
factor as a whole and needs no index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.anchored import parts
from sluiceway.llm.minhash import word_hashes
from sluiceway.llm.shared import Staged, let_go

WINDOW = 35
#: Words of an anchor.
GRAM = 8
#: Variants in a reference block; larger blocks are dealt again by more of the words around the anchor.
BLOCK = 4096
#: Rows of whole blocks that are indexed together.
TOGETHER = 4096


def new_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches without the rows whose ``id`` has come before."""
    seen: set[bytes] = set()
    for batch in batches:
        fresh = []
        for key in batch.column("id").to_pylist():
            fresh.append(key not in seen)
            seen.add(key)
        yield batch if all(fresh) else batch.filter(pa.array(fresh, pa.bool_()))


def part_rows(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Of texts (``id``, ``text``): ``id`` and the parts' ``first``, ``count``, ``before``, ``anchor``, ``digest``.

    A text that a task meets again gives none, so a common one gives few rows to shuffle.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in new_texts(batches):
            found = []
            for value in batch.column("text"):
                words = (value.as_py() or "").encode().split()
                codes = np.fromiter(map(word_hashes.__getitem__, words), np.uint64, len(words))
                found.append(parts(codes, window, gram))
            owner = np.repeat(np.arange(batch.num_rows), [len(x[0]) for x in found])
            if len(owner):
                columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(owner)), *columns],
                    names=["id", "first", "count", "before", "anchor", "digest"],
                )

    return texts.mapInArrow(find, "id binary, first int, count int, before int, anchor long, digest long")


def contents(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Of texts (``id``, ``text``, ``wanted`` parts): ``anchor``, ``digest``, ``before``, ``words`` of each.

    A text that a task meets again gives none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in new_texts(batches):
            rows: list[list] = [[], [], [], []]
            for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
                words = text.as_py().encode().split()
                for x in wanted.as_py():
                    part = b" ".join(words[x["first"] : x["first"] + x["count"] - 1 + window])
                    for column, value in zip(rows, (x["anchor"], x["digest"], x["before"], part), strict=True):
                        column.append(value)
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["anchor", "digest", "before", "words"]
            )

    return texts.mapInArrow(cut, "anchor long, digest long, before int, words binary")


def match_lengths(codes: np.ndarray, block: np.ndarray) -> np.ndarray:
    """For each row and place, how many words from there on another row of its block has too, at the same places.

    The index of a block is the order of its rows by their words from each place on, with the common
    length of neighbours in it. It is made from the last place to the first, of all blocks at once: the
    order at a place is that of the place after it, sorted by the words here. A row's longest match is
    with a neighbour. The work is in proportion to the rows, however many a block has.
    """
    rows, width = codes.shape
    lengths = np.zeros((rows, width), np.int32)
    order = np.argsort(block, kind="stable")
    common = np.where(np.diff(block[order], prepend=-1) == 0, 0, -1)  # of each in the order with the one before it
    rank = np.empty(rows, np.int64)
    for place in range(width - 1, -1, -1):
        rank[order] = np.arange(rows)
        after, common_after = order, common
        order = after[np.lexsort((codes[after, place], block[after]))]
        one, two = rank[order[:-1]], rank[order[1:]]  # places in the order after this one, where ``one`` is before
        same = (codes[order[:-1], place] == codes[order[1:], place]) & (block[order[:-1]] == block[order[1:]])
        common = np.full(rows, -1)
        if same.any():
            # two rows have in common what all between them have with the one before
            between = np.stack([one[same] + 1, two[same] + 1], axis=1).ravel()
            least = np.minimum.reduceat(np.append(common_after, 0), between)[::2]
            common[1:][same] = 1 + np.maximum(least, 0)
        longest = np.maximum(common, np.append(common[1:], -1))
        lengths[order, place] = np.maximum(longest, 0)
    return lengths


def factored(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Row, start and end of the duplicate spans by greedy factors, and how many factors there were.

    A factor is the longest match from where the last one ended; a word without any is a literal. A
    factor of a window's length is a duplicate. A repeated window that is not within one factor crosses
    the end of the one it starts in, so the windows that cross an end are checked by their own matches.
    """
    rows, width = lengths.shape
    places = np.arange(width)
    long = lengths >= window
    taken = np.zeros((rows, width), bool)
    at, factors = np.zeros(rows, np.int64), 0
    live = np.arange(rows)
    while len(live):
        here = at[live]
        size = lengths[live, here]
        factors += int((size > 0).sum())
        end = here + np.maximum(size, 1)
        crossing = (places >= np.maximum(here, end - window + 1)[:, None]) & (places < end[:, None])
        taken[live] |= crossing & long[live]
        taken[live, here] |= long[live, here]
        at[live] = end
        live = live[end < width]
    change = np.zeros((rows, width + 1), np.int32)
    row, place = np.nonzero(taken)
    np.add.at(change, (row, place), 1)
    np.add.at(change, (row, place + lengths[row, place]), -1)
    inside = np.zeros((rows, width + 2), np.int8)
    inside[:, 1:-1] = np.cumsum(change[:, :-1], axis=1) > 0
    edge = np.diff(inside, axis=1)
    row, start = np.nonzero(edge == 1)
    return row, start, np.nonzero(edge == -1)[1], factors


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def parse_blocks(blocks: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``anchor``, ``digest``, ``start``, ``end`` of the duplicate spans of variants (``block``, ``anchor``,
    ``digest``, ``before``, ``words``), each factored against the others of its block.

    The rows of a block come together. Whole blocks are indexed together up to some thousand rows."""
    reach = window - gram
    width = 2 * reach + gram

    def parse(held: dict[tuple[int, int, int], tuple[int, bytes]]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        codes = np.repeat(-1 - np.arange(len(held)), width).reshape(-1, width)  # past a part's ends nothing is the same
        first = np.zeros(len(held), np.int64)
        for n, (before, words) in enumerate(held.values()):
            mine = [numbers.setdefault(w, len(numbers)) for w in words.split()]
            first[n] = reach - before
            codes[n, first[n] : first[n] + len(mine)] = mine
        keys = np.array([*held], np.int64).reshape(-1, 3)
        block = np.unique(keys[:, 0], return_inverse=True)[1].reshape(-1)
        row, start, end, _ = factored(match_lengths(codes, block), window)
        columns = keys[row, 1], keys[row, 2], (start - first[row]).astype(np.int32), (end - first[row]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "digest", "start", "end"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            for block, anchor, digest, before, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != key and len(held) >= TOGETHER:
                    yield parse(held)
                    held = {}
                key = block
                held[block, anchor, digest] = (before, words)
        if held:
            yield parse(held)

    together = blocks.select("block", "anchor", "digest", "before", "words").repartition("block").sortWithinPartitions("block")
    return together.mapInArrow(stream, "anchor long, digest long, start int, end int")


def dealt_again(blocks: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Rows of too large blocks, each in two blocks of half the windows: those that start ``low`` to
    ``high`` words into the anchor's surroundings share all words from ``high`` to ``low + window``."""
    reach = window - gram

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for _, anchor, digest, before, words, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = words.split()
                first = reach - before  # where the part's first word is
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    # all windows of a half hold its core; a part without the whole core has none of them,
                    # for its windows are all that its document has with this anchor
                    core = own[max(0, b - first) : max(0, a + window - first)]
                    if a > b or b < first or len(core) < a + window - b:
                        continue
                    block = xxhash.xxh3_64_intdigest(b"%d %d " % (a, b) + b" ".join(core)) - 2**63
                    for column, value in zip(rows, (block, anchor, digest, before, words, a, b), strict=True):
                        column.append(value)
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)

    names = ["block", "anchor", "digest", "before", "words", "low", "high"]
    return blocks.select(*names).mapInArrow(
        deal, "block long, anchor long, digest long, before int, words binary, low int, high int"
    )


def duplicate_spans(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """``id`` and ``spans`` (start and end in words) of what repeats, in texts (``id``, ``text``)."""
    spark = texts.sparkSession
    place = F.xxhash64("id", "first")
    found = Staged(part_rows(texts, window, gram), "parts")
    rows = found.read()
    # written first, so that the join can split what a common anchor has on its left side
    anchors = Staged(
        rows.groupBy("anchor")
        .agg(
            F.min(place).alias("one"), F.max(place).alias("two"), F.min("digest").alias("low"), F.max("digest").alias("high")
        )
        .where("one <> two")
        .select("anchor", (F.col("low") == F.col("high")).alias("equal")),
        "anchors",
    )
    repeated = Staged(rows.join(anchors.read(), "anchor"), "repeated")
    anchors.discard()
    found.discard()
    let_go(spark)
    rows = repeated.read()
    end = F.col("first") + F.col("count") - 1 + window
    spans = rows.where("equal").select("id", F.col("first").alias("start"), end.alias("end"))
    open_rows = rows.where("NOT equal")
    variants = open_rows.groupBy("anchor", "digest").agg(
        F.min(place).alias("one"), F.max(place).alias("two"), F.min(F.struct("id", "first", "count", "before")).alias("at")
    )
    variants = Staged(variants.select("anchor", "digest", (F.col("one") != F.col("two")).alias("copied"), "at.*"), "variants")
    wanted = (
        variants.read()
        .groupBy("id")
        .agg(F.collect_list(F.struct("anchor", "digest", "first", "count", "before")).alias("wanted"))
    )
    dealt = Staged(
        contents(texts.join(wanted, "id"), window).dropDuplicates(["anchor", "digest"]).select(
            F.col("anchor").alias("block"), "anchor", "digest", "before", "words",
            F.lit(0).alias("low"), F.lit(window - gram).alias("high"),
        ),
        "blocks",
    )
    let_go(spark)
    # a part that occurs more than once as a whole
    by_variant = variants.read().where("copied").select("anchor", "digest", F.lit(0).alias("start"), F.lit(2**30).alias("end"))
    while True:
        blocks = dealt.read()
        sizes = blocks.groupBy("block").agg(
            F.countDistinct("anchor", "digest").alias("size"), F.max(F.col("high") - F.col("low")).alias("width")
        )
        sizes = Staged(sizes.where("size > 1"), "sizes").read()
        fits = sizes.where(f"size <= {block} AND width > 0").select("block")
        by_variant = by_variant.unionByName(
            Staged(parse_blocks(blocks.join(fits, "block", "left_semi"), window, gram), "spans").read()
        )
        # a block of one window: all its variants have it
        single = sizes.where("width = 0").select("block")
        shift = F.col("low") - (window - gram) + F.col("before")
        by_variant = by_variant.unionByName(
            blocks.join(single, "block", "left_semi").select("anchor", "digest", shift.alias("start"), (shift + window).alias("end"))
        )
        large = sizes.where(f"size > {block} AND width > 0").select("block")
        if large.isEmpty():
            break
        dealt = Staged(dealt_again(blocks.join(large, "block", "left_semi"), window, gram), "blocks")
    # written first, so that the join can split what a common variant has on its left side
    by_variant = by_variant.groupBy("anchor", "digest").agg(F.collect_set(F.struct("start", "end")).alias("own"))
    more = open_rows.join(Staged(by_variant, "variant-spans").read(), ["anchor", "digest"]).select("id", "first", end.alias("last"), F.explode("own").alias("x"))
    spans = spans.unionByName(
        more.select(
            "id", (F.col("first") + F.col("x.start")).alias("start"), F.least(F.col("first") + F.col("x.end"), "last").alias("end")
        )
    )
    return spans.groupBy("id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def substring_dedup(documents: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """A row per document: the columns of ``keep`` (the key alone if None), ``n_words``,
    ``n_removed``, ``kept_sha256``, ``kept_text``.

    A word goes if a window of 35 words over it starts anywhere else too. Kept words are joined by
    one space; a text that loses nothing is given as it is. Null texts have no words and stay null;
    texts under a window lose nothing. Equal rows are places of their own, so all their windows
    repeat. Other columns are not read; no documents give no rows.
    """
    keep = keep or [key]
    body = documents.withColumn("whole_text_id", F.unhex(F.substring(F.md5(F.coalesce(F.col(text), F.lit(""))), 1, 24)))
    rows = body.select(F.col("whole_text_id").alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    copies = rows.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    spans = Staged(duplicate_spans(rows), "text-spans")
    let_go(documents.sparkSession)
    notes = copies.where("copies > 1").join(spans.read(), "id", "full").select(
        F.col("id").alias("whole_text_id"), (F.coalesce("copies", F.lit(1)) > 1).alias("copied"), "spans"
    )

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for value, copied, spans in zip(*batch.columns[-3:], strict=True):
                whole = value.as_py()
                words = (whole or "").encode().split()
                gone = 0
                if copied.as_py() and len(words) >= WINDOW:
                    gone, kept = len(words), []
                elif spans.is_valid:
                    kept, last = [], 0
                    for start, end in joined_spans([(x["start"], min(x["end"], len(words))) for x in spans.as_py()]):
                        kept += words[last:start]
                        gone, last = gone + end - start, end
                    kept += words[last:]
                else:
                    kept = words
                joined = b" ".join(kept)
                for column, item in zip(
                    out, (len(words), gone, hashlib.sha256(joined).hexdigest(), joined.decode() if gone else whole), strict=True
                ):
                    column.append(item)
            kinds = pa.int64(), pa.int64(), pa.string(), pa.string()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                names=[*keep, "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    joined = body.join(notes, "whole_text_id", "left").select(*keep, F.col(text).alias("whole_text"), "copied", "spans")
    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep)
    return joined.mapInArrow(take_out, f"{kinds}, n_words long, n_removed long, kept_sha256 string, kept_text string")
