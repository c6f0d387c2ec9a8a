"""Strings that documents share, by suffix arrays of shards of the text that may repeat."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.anchored import PLACES, RangeHashes, mixed, running_least
from sluiceway.llm.external_suffixes import HELD_ENTRIES, suffixes
from sluiceway.llm.shared import Staged, let_go, part_count, portions
from sluiceway.llm.substrings import joined_spans

LENGTH = 50
#: Bytes of an anchor.
GRAM = 20
#: Bytes of text that a shard has, about, of blocks of at most a quarter; sorting them takes 50 times as much memory. Names are then sorted
#: in memory. In larger shards they are sorted by recursion, with queues and text on disk, which takes far longer.
SHARD_BYTES = 4_000_000
#: A shard's text up to this size is in memory, a larger one in a mapped file.
HELD_TEXT = 64_000_000
NOBODY = 2**63 - 1
#: Bytes of texts that are hashed together; with a window more they fit ``PLACE_BITS``.
TOGETHER = 200_000
#: Texts with neighbouring numbers of which hashes are told together.
PAGE_BITS = 9
#: Bytes of text that a bucket of hashes is for.
BUCKET_BYTES = 16_000_000
#: Of a hash the high bits count; a text's place in a page takes the others.
HASH_BITS, LOW_BITS, LOW_HALF = np.uint64(42), np.uint64(22), np.uint64(2**32 - 1)

CODES = mixed(np.arange(1, 257, dtype=np.uint64))


@dataclass
class Found:
    """Parts of some texts, and where they are in the texts' bytes, which are one after another."""

    text: np.ndarray
    first: np.ndarray
    count: np.ndarray
    before: np.ndarray
    anchor: np.ndarray
    begin: np.ndarray  # of the part in ``data``
    data: np.ndarray
    hashes: RangeHashes


def stretches(texts: list[np.ndarray], length: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Texts, long ones cut so that each window is in one piece, put together until there are enough bytes:
    the pieces, whose they are and where they start there."""
    some: list[np.ndarray] = []
    whose, starts, size = [], [], 0
    for n, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, TOGETHER):
            piece = text[start : start + TOGETHER + length - 1]
            if some and size + len(piece) > TOGETHER + length:
                yield some, np.array(whose), np.array(starts)
                some, whose, starts, size = [], [], [], 0
            some.append(piece), whose.append(n), starts.append(start)
            size += len(piece)
    if some:
        yield some, np.array(whose), np.array(starts)


def found_parts(texts: list[np.ndarray], length: int, gram: int) -> Iterator[Found]:
    """The parts of many texts, found together; their anchors are those of ``anchored.parts``."""
    for pieces, whose, starts in stretches(texts, length):
        data = np.concatenate(pieces)
        sizes = np.array([*map(len, pieces)])
        begins = np.cumsum(sizes) - sizes
        hashes = RangeHashes(CODES[data])
        grams = mixed((hashes.sums[gram:] - hashes.sums[:-gram]) * hashes.down[: len(data) - gram + 1])
        packed = (grams & ~PLACES) | np.arange(len(grams), dtype=np.uint64)
        where = (running_least(packed, length - gram + 1) & PLACES).astype(np.int32)
        ends = begins + sizes - length + 1  # of each piece's windows; others reach into the next piece
        inside = np.ones(len(where) + 1, bool)
        change = np.ones(len(where) + 1, bool)
        change[1:-1] = where[1:] != where[:-1]
        change[begins] = change[ends] = True
        for n in range(length - 1):
            inside[np.minimum(ends + n, len(where))] = False
        at = np.flatnonzero(change)
        mine = np.flatnonzero(inside[at])
        begin, count = at[mine], (at[mine + 1] - at[mine])
        anchor = where[begin].astype(np.int64)
        piece = np.searchsorted(begins, begin, "right") - 1
        yield Found(whose[piece], begin - begins[piece] + starts[piece], count, anchor - begin, grams[anchor], begin, data, hashes)


def halves(found: Found, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bytes that every window of a part has which reaches far to the left of the anchor, then of
    those that every other one has; and which part each is of. Equal windows are on one side, so of parts that
    share a window one hash is the same."""
    reach = length - gram
    half = reach // 2
    anchor = found.begin + found.before
    left = np.flatnonzero(found.before >= half)
    right = np.flatnonzero(found.before - found.count + 1 < half)
    one = found.hashes.of(anchor[left] - half, anchor[left] + gram)
    two = found.hashes.of(anchor[right], anchor[right] + gram + reach - half + 1)
    return np.concatenate([one, two]), np.concatenate([left, right])


def as_bytes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), np.uint8) for value in column]


def binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values one after another; ``ends``: where each begins, and the end, in bytes."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])


def common_halves(texts: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """``page``, ``bucket``, ``hashes``: the halves of each page's parts that parts of another text have too.

    Rows that are shuffled have a page's hashes of one bucket, 4 bytes each: once if one of the page's texts has
    it, twice if several have, so no bucket grows with a string that very many texts share."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (some for whole in batches for some in portions(whole)):
            pages = batch.column("page").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], pages[1:] != pages[:-1], [True]]))
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = as_bytes(batch.column("text").slice(low, high - low))
                known = []
                for found in found_parts(own, length, gram):
                    hashes, part = halves(found, length, gram)
                    known.append((hashes >> LOW_BITS) << LOW_BITS | found.text[part].astype(np.uint64))
                if not known:
                    continue
                each = np.concatenate(known)
                each.sort()
                each = each[np.concatenate([[True], each[1:] != each[:-1]])] >> LOW_BITS  # one of each text
                again = np.concatenate([[False], each[1:] == each[:-1]])
                third = again.copy()
                third[1:] &= again[:-1]
                each = each[~third]
                bucket = (each * np.uint64(buckets)) >> HASH_BITS
                starts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
                there = np.flatnonzero(starts[1:] > starts[:-1])
                ends = np.append(starts[there], len(each)) * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(there.astype(np.int32)), pa.array(np.full(len(there), pages[low])), binaries(each.astype(np.uint32), ends)],
                    names=["bucket", "page", "hashes"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, pages, hashes = [], [], []
        for batch in batches:
            buckets.append(batch.column("bucket").to_numpy()), pages.append(batch.column("page").to_numpy())
            hashes += [np.frombuffer(value.as_buffer(), np.uint32).copy() for value in batch.column("hashes")]
        if not hashes:
            return
        bucket, page = np.concatenate(buckets), np.concatenate(pages)
        sizes = np.array([*map(len, hashes)])
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        every = np.repeat(bucket.astype(np.uint64) << np.uint64(32), sizes) | np.concatenate(hashes)
        ordered = np.sort(every)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        hit = np.flatnonzero(among(every, twice))
        row, every = row[hit], every[hit]
        once = np.ones(len(hit), bool)
        once[1:] = (every[1:] != every[:-1]) | (row[1:] != row[:-1])
        row, every = row[once], every[once]
        starts = np.searchsorted(row, np.arange(len(sizes) + 1, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket), pa.array(page), binaries(every.astype(np.uint32), starts * 4)], names=["bucket", "page", "hashes"]
        )

    kind = "bucket int, page long, hashes binary"
    told = texts.select("page", "text").mapInArrow(tell, kind)
    return told.repartitionById(buckets, "bucket").mapInArrow(meet, kind).where("octet_length(hashes) > 0")


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each value is one of some in order."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def byte_parts(texts: DataFrame, halves_of_others: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """Of distinct texts (``n``, ``page``, ``text``, ``owner``): ``n``, ``owner``, ``anchor``, ``digest``, ``first`` window,
    bytes ``before`` the anchor, and ``bytes`` of each part that may have a window of another text."""

    def find(own: pa.Table, shared: pa.Table) -> pa.Table:
        own, shared = own.combine_chunks(), shared.combine_chunks()
        hashes = [np.frombuffer(value.as_buffer(), np.uint32) for value in shared.column("hashes")]
        high = np.repeat(shared.column("bucket").to_numpy().astype(np.uint64) << np.uint64(32), [*map(len, hashes)])
        known = np.sort(high | np.concatenate([*hashes, np.zeros(0, np.uint32)]))
        out = [schema.empty_table()]
        if not len(known):
            return out[0]
        texts = own.column("text").combine_chunks()
        for found in found_parts(as_bytes(texts), length, gram):
            both, part = halves(found, length, gram)
            both >>= LOW_BITS
            bucket = (both * np.uint64(buckets)) >> HASH_BITS
            hit = np.zeros(len(found.first), bool)
            hit[part[among(bucket << np.uint64(32) | both & LOW_HALF, known)]] = True
            mine = np.flatnonzero(hit)
            begin, count = found.begin[mine], found.count[mine]
            size = count - 1 + length
            ends = np.concatenate([[0], np.cumsum(size)])
            content = found.data[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
            digest = found.hashes.of(begin, begin + size) + mixed(count.astype(np.uint64))
            who = pa.array(found.text[mine])
            columns = [
                own.column("n").take(who), own.column("owner").take(who), pa.array(found.anchor[mine].view(np.int64)),
                pa.array(digest.view(np.int64)), pa.array(found.first[mine].astype(np.int32)),
                pa.array(found.before[mine].astype(np.int32)), binaries(content, ends),
            ]
            out.append(pa.table(columns, schema=schema))
        return pa.concat_tables(out)

    schema = pa.schema(
        [(name, pa.int64()) for name in ("n", "owner", "anchor", "digest")]
        + [("first", pa.int32()), ("before", pa.int32()), ("bytes", pa.binary())]
    )
    return texts.groupBy("page").cogroup(halves_of_others.groupBy("page")).applyInArrow(
        find, "n long, owner long, anchor long, digest long, first int, before int, bytes binary"
    )


BLOCK_COLUMNS = ["block", "anchor", "digest", "owner", "last_owner", "place", "offset", "low", "high", "bytes"]


def dealt_again(blocks: DataFrame, length: int) -> DataFrame:
    """Rows of too large blocks, each in up to two blocks of half the windows, with the bytes of these alone.

    ``low`` and ``high``: where windows start in the bytes that may surround an anchor; ``place``: where the
    row's bytes start there; ``offset``: where they start in the variant."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in BLOCK_COLUMNS]
            for _, anchor, digest, owner, last_owner, place, offset, low, high, own in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    first, last = max(a, place), min(b, place + len(own) - length)  # windows of the half
                    if first > last:
                        continue
                    core = own[b - place : a + length - place]  # all windows of a half hold it
                    block = xxhash.xxh3_64_intdigest(b"%d %d %d " % (anchor, a, b) + core) - 2**63
                    part = own[first - place : last - place + length]
                    row = block, anchor, digest, owner, last_owner, first, offset + first - place, a, b, part
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, [pa.int64()] * 5 + [pa.int32()] * 4 + [pa.binary()], strict=True)],
                names=BLOCK_COLUMNS,
            )

    return blocks.select(*BLOCK_COLUMNS).mapInArrow(
        deal,
        "block long, anchor long, digest long, owner long, last_owner long, place int, offset int, low int, high int, bytes binary",
    )


def least_owners(text: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int, held: int) -> np.ndarray:
    """For each place of a shard's text the smallest owner of a part with the string that starts there.

    ``starts``: of the parts, in order; ``owners``: theirs. Suffixes that share a string are
    neighbours whose common prefixes reach its length.
    """
    least = np.full(len(text), NOBODY, np.int64)
    waiting: list[np.ndarray] = []  # the last group so far
    part = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(text))))

    def close(places: np.ndarray, cuts: np.ndarray) -> None:
        owner = owners[part[places]]
        least[places] = np.repeat(np.minimum.reduceat(owner, cuts), np.diff(np.append(cuts, len(places))))

    for places, prefixes in suffixes(text, length, held):
        new = np.flatnonzero(prefixes < length)
        if not len(new):
            waiting.append(places)
            continue
        if waiting or new[0]:
            group = np.concatenate([*waiting, places[: new[0]]])
            if len(group):
                close(group, np.zeros(1, np.int64))
        if new[-1] > new[0]:
            close(places[new[0] : new[-1]], new[:-1] - new[0])
        waiting = [places[new[-1] :]]
    if waiting:
        close(np.concatenate(waiting), np.zeros(1, np.int64))
    return least


def sorted_shards(blocks: DataFrame, shards: int, length: int, held: int) -> DataFrame:
    """``anchor``, ``digest``, ``start``, ``end``, ``least``: for variants in blocks (``block``, ``anchor``,
    ``digest``, ``owner``, ``offset``, ``bytes``) the runs of windows and the smallest owner that has them. A
    task sorts the text of one shard, which has whole blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, digests, owners, offsets, sizes = [], [], [], [], []
        with tempfile.TemporaryFile() as file:  # gone with the process
            for batch in batches:
                for column, name in ((anchors, "anchor"), (digests, "digest"), (owners, "owner"), (offsets, "offset")):
                    column.append(batch.column(name).to_numpy(zero_copy_only=False))
                parts = as_bytes(batch.column("bytes"))
                size = np.array([*map(len, parts)], np.int64)
                whole = np.ones(int(size.sum()) + len(size), np.uint16)  # ones between parts
                whole[np.arange(len(whole) - len(size)) + np.repeat(np.arange(len(size)), size)] = (
                    np.concatenate([*parts, np.zeros(0, np.uint8)]).astype(np.uint16) + 2
                )
                whole.tofile(file)
                sizes.append(size)
            if not sum(map(len, sizes)):
                return
            np.zeros(1, np.uint16).tofile(file)  # the end
            file.flush()
            size = np.concatenate(sizes)
            total = int(size.sum()) + len(size) + 1
            if total * 2 <= HELD_TEXT:
                file.seek(0)
                text = np.fromfile(file, np.uint16, total)
            else:
                text = np.memmap(file, np.uint16, "r", shape=(total,))
            starts = np.cumsum(size + 1) - size - 1
            anchor, digest, owner, offset = (np.concatenate(c) for c in (anchors, digests, owners, offsets))
            least = least_owners(text, starts, owner, length, held)
        for low in range(0, len(size), 5000):
            windows = size[low : low + 5000] - length + 1
            ends = np.cumsum(windows)
            part = np.repeat(np.arange(len(windows)), windows)
            window = np.arange(ends[-1]) - (ends - windows)[part]
            own = least[starts[low + part] + window]
            cuts = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (part[1:] != part[:-1])]))
            last = window[np.append(cuts[1:], len(own)) - 1]
            who = low + part[cuts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[who]), pa.array(digest[who]), pa.array((offset[who] + window[cuts]).astype(np.int32)),
                    pa.array((offset[who] + last + length).astype(np.int32)), pa.array(own[cuts]),
                ],
                names=["anchor", "digest", "start", "end", "least"],
            )

    dealt = blocks.repartitionById(shards, F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int"))
    return dealt.select("anchor", "digest", "owner", "offset", "bytes").mapInArrow(
        work, "anchor long, digest long, start int, end int, least long"
    )


def runs_of(variants: DataFrame, length: int, gram: int, shard_bytes: int, held: int) -> DataFrame:
    """``anchor``, ``digest``, ``start``, ``end``, ``least`` of variants (``anchor``, ``digest``, ``owner``,
    ``last_owner``, ``before``, ``bytes``), no two of one anchor and digest; ``owner`` is the smallest that has
    the variant, ``last_owner`` the largest.

    An anchor's variants are a block. Blocks over a quarter of a shard are dealt again, down to one window,
    which needs no sorting, so no shard grows with an anchor. Nor do blocks whose variants have one smallest
    owner, though others may have them."""
    spark, reach = variants.sparkSession, length - gram
    blocks = variants.select(
        F.col("anchor").alias("block"), "anchor", "digest", "owner", "last_owner", (reach - F.col("before")).alias("place"),
        F.lit(0).alias("offset"), F.lit(0).alias("low"), F.lit(reach).alias("high"), "bytes",
    )
    limit = max(1, shard_bytes // 4)
    found: DataFrame | None = None
    while True:
        sizes = Staged(
            blocks.groupBy("block")
            .agg(
                F.sum(F.octet_length("bytes") + 1).alias("size"), F.max(F.col("high") - F.col("low")).alias("width"),
                F.min("owner").alias("least"), F.max("owner").alias("most"), F.max("last_owner").alias("last"),
            )
            .where("least <> last"),  # of others nobody has the block
            "sizes",
            once=True,
        ).read()
        several = sizes.where("width > 0 AND least <> most")
        fits = several.where(f"size <= {limit}")
        size = fits.agg(F.sum("size")).first()[0] or 0
        some = blocks.join(fits.select("block"), "block", "left_semi")
        runs = Staged(sorted_shards(some, part_count(spark, size, shard_bytes), length, held), "runs", once=True).read()
        # a block of one window: all its variants have it; of one smallest owner: it has every window
        single = sizes.where("width = 0 OR least = most").select("block", "least")
        end = (F.col("offset") + F.octet_length("bytes")).alias("end")
        runs = runs.unionByName(
            blocks.where("last_owner > owner OR high = low").join(single, "block")
            .where("last_owner > least").select("anchor", "digest", F.col("offset").alias("start"), end, "least")
        )
        found = runs if found is None else found.unionByName(runs)
        large = several.where(f"size > {limit}").select("block")
        if large.isEmpty():
            return found
        blocks = Staged(dealt_again(blocks.join(large, "block", "left_semi"), length), "blocks", once=True).read()
        let_go(spark)


def shared_spans(texts: DataFrame, length: int, gram: int, shard_bytes: int, held: int) -> DataFrame:
    """``n`` and ``spans`` (in bytes) that a text shares with one of a smaller owner, in distinct texts (``n``,
    ``text``, ``owner``)."""
    spark = texts.sparkSession
    if length >= 4096:
        raise ValueError(f"strings of {length} bytes: up to 4095 are known")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = part_count(spark, size, BUCKET_BYTES)
    texts = texts.withColumn("page", F.shiftright("n", PAGE_BITS))
    halves_of_others = Staged(common_halves(texts, length, gram, buckets), "halves", once=True)
    let_go(spark)
    # one shuffle tells which anchors several owners have, and whether all their parts are equal
    of_anchor = Window.partitionBy("anchor")
    rows = byte_parts(texts, halves_of_others.read(), length, gram, buckets).select(
        "*", F.min("digest").over(of_anchor).alias("low"), F.max("digest").over(of_anchor).alias("high"),
        F.min("owner").over(of_anchor).alias("least"), F.max("owner").over(of_anchor).alias("most"),
    )
    equal = F.col("low") == F.col("high")
    # of equal parts the smallest owner's lose nothing and are not wanted
    rows = rows.where("least <> most").where(~equal | F.expr("owner > least"))
    end = (F.col("first") + F.octet_length("bytes")).alias("end")
    # the bytes of equal parts are not compared any more
    content = F.when(~equal, F.col("bytes")).alias("bytes")
    columns = "n", "owner", "anchor", "digest", equal.alias("equal"), "first", end, "before", content
    groups = Staged(rows.select(*columns), "groups", once=True)
    let_go(spark)
    halves_of_others.discard()
    known = groups.read()
    spans = known.where("equal").select("n", F.col("first").alias("start"), "end")
    rest = known.where("NOT equal")
    variants = rest.groupBy("anchor", "digest").agg(
        F.min("owner").alias("owner"), F.max("owner").alias("last_owner"), F.first("before").alias("before"), F.first("bytes").alias("bytes")
    )
    body = Staged(variants, "variants", once=True)
    let_go(spark)
    runs = runs_of(body.read(), length, gram, shard_bytes, held)
    more = rest.drop("end", "bytes").join(runs, ["anchor", "digest"]).where("owner > least")
    spans = spans.unionByName(
        more.select("n", (F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("end")).alias("end"))
    )
    found = Staged(spans.groupBy("n").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "text-spans", once=True)
    let_go(spark)
    groups.discard()
    body.discard()
    return found.read()


def suffix_dedup(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    held: int = HELD_ENTRIES,
    keep: list[str] | None = None,
) -> DataFrame:
    """A row per document: the columns of ``keep`` (the key alone if None), ``n_bytes``, ``n_removed``,
    ``n_spans``, ``kept_sha256``, ``kept_bytes``.

    A byte goes if a string of 50 bytes over it starts in a document of a smaller key too. Null and
    empty texts have no bytes; shorter ones than a string lose none. Rows of one key are one
    document and lose nothing to each other; of equal texts the smallest key keeps its own. A null
    key counts as larger than any other. What is kept need not be valid text, so it is bytes. Other
    columns are not read; no documents give no rows.
    """
    keep = keep or [key]
    body = documents.withColumn("whole_text_id", F.unhex(F.substring(F.md5(F.coalesce(F.col(text), F.lit(""))), 1, 24)))
    body = body.withColumn("whole_text_owner", F.coalesce(F.col(key).cast("long"), F.lit(NOBODY)))
    # equal texts have equal parts; the smallest owner stands for all
    rows = body.where(F.octet_length(text) >= length).groupBy(F.col("whole_text_id").alias("id"))
    rows = rows.agg(F.min("whole_text_owner").alias("owner"), F.first(text).alias("text"))
    texts = Staged(rows.withColumn("n", F.monotonically_increasing_id()), "texts", once=True).read()
    let_go(documents.sparkSession)
    spans = shared_spans(texts, length, gram, shard_bytes, held)
    notes = texts.select("n", F.col("id").alias("whole_text_id"), "owner").join(spans, "n", "left").drop("n")

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for value, later, spans in zip(*batch.columns[-3:], strict=True):
                data = (value.as_py() or "").encode()
                gone: list[tuple[int, int]] = []
                if later.as_py() and len(data) >= length:
                    gone = [(0, len(data))]
                elif spans.is_valid:
                    gone = joined_spans([(x["start"], x["end"]) for x in spans.as_py()])
                edges = [0, *(x for span in gone for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                row = len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept
                for column, item in zip(out, row, strict=True):
                    column.append(item)
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                names=[*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"],
            )

    joined = body.join(notes, "whole_text_id", "left").select(
        *keep, F.col(text).alias("whole_text"), (F.col("whole_text_owner") > F.col("owner")).alias("later"), "spans"
    )
    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep)
    return joined.mapInArrow(
        take_out, f"{kinds}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"
    )
