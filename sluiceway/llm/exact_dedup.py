"""Exact duplicates: minimal perfect hashes over known digests, whose slots hold digests and the rows that stay.

A history is a folder of buckets, each a minimal perfect hash of the distinct digests that fall into
it. A text is looked up in the bucket of its digest: the hash names one slot, and the digest kept there
is compared byte by byte. Equal digests mean a repeat of the row that the slot locates; texts of no
history are grouped among themselves, into a history of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.anchored import mixed
from sluiceway.llm.shared import SPACES, Staged, new_path, part_count, store

#: Digests of a bucket, about: some 30 MB with their slots.
BUCKET_ROWS = 500_000
LEAST_BUCKETS = 64
#: Places of a level for each digest that is left; more makes for fewer levels and more bits.
ROOM = 2
DIGEST_BYTES = 32

_draw = np.random.default_rng(11)
#: By level, in turn, and word of the digest; odd.
FACTORS = _draw.integers(0, 2**63, (64, DIGEST_BYTES // 8), np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(digests: pa.Array) -> np.ndarray:
    """Digests as rows of four 64-bit words."""
    flat = digests.cast(pa.binary(DIGEST_BYTES))
    data = np.frombuffer(flat.buffers()[1], np.uint8)[flat.offset * DIGEST_BYTES :][: len(flat) * DIGEST_BYTES]
    return data.view("<u8").reshape(-1, DIGEST_BYTES // 8)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    spread = mixed((words * FACTORS[level % len(FACTORS)]).sum(axis=1, dtype=np.uint64) + np.uint64(level))
    return (spread % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers from 0 for so many distinct digests, without gaps.

    At each level the digests that are left draw a place; those alone at theirs keep it and the others
    go on. A digest's number is how many kept places come before its own.
    """

    def __init__(self, sizes: Sequence[int], marks: np.ndarray):
        self.sizes, self.marks = list(sizes), marks
        self.before = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])

    @classmethod
    def build(cls, words: np.ndarray) -> PerfectHash:
        sizes, marks, left = [], [], words
        while len(left):
            size = ROOM * len(left)
            places = _places(left, len(sizes), size)
            mark = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            marks.append(mark)
            left = left[~mark[places]]
        return cls(sizes, np.concatenate(marks) if marks else np.zeros(0, bool))

    def slots(self, words: np.ndarray) -> np.ndarray:
        """The number of each digest; of others any, or -1."""
        found, left, base = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = _places(words[left], level, size) + base
            kept = self.marks[at]
            found[left[kept]] = self.before[at[kept]]
            left, base = left[~kept], base + size
        return found


@dataclass(frozen=True)
class History:
    """Where the buckets of known digests are, and how many; ``bucket`` is a digest's."""

    spark: SparkSession
    path: str
    buckets: int

    def bucket(self, digest: Column) -> Column:
        return F.pmod(F.xxhash64(digest), F.lit(self.buckets)).cast("int")


def digested(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``digest`` of the text without white space, ``chars`` of the whole text, ``row`` (any distinct number)."""
    value = F.coalesce(F.col(text), F.lit(""))
    return documents.select(
        F.col(key).alias("id"),
        F.unhex(F.sha2(F.translate(value, SPACES, ""), 256)).alias("digest"),
        F.length(value).alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )


def write_history(rows: DataFrame, path: str, bucket_rows: int = BUCKET_ROWS, least: int = LEAST_BUCKETS) -> History:
    """A history of the rows of ``digested``: a slot for each distinct digest with the row that stays
    (``keep_id``, ``keep_row``) and the number of rows.

    Spark reduces the rows of a digest in each task before the shuffle, so one that a third of all rows
    have costs a row a task. Buckets follow from the digest, so they are about equally large.
    """
    spark, kind = rows.sparkSession, rows.schema["id"].dataType.simpleString()
    first = F.min(F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("n"), "id", "row"))
    groups = Staged(rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("size")), "digest-groups")
    distinct = groups.read()
    buckets = max(least, part_count(spark, distinct.count(), bucket_rows))
    history = History(spark, path, buckets)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, part in by_bucket(batches):
            words = words_of(part.column("digest"))
            order = np.empty(len(words), np.int64)
            hashed = PerfectHash.build(words)
            order[hashed.slots(words)] = np.arange(len(words))
            slots = part.take(pa.array(order))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket], pa.int32()), pa.array([hashed.sizes], pa.list_(pa.int64())),
                    pa.array([np.packbits(hashed.marks).tobytes()], pa.binary()),
                    pa.array([words[order].tobytes()], pa.binary()),
                    *(pa.ListArray.from_arrays([0, len(slots)], slots.column(name)) for name in ("keep_id", "keep_row", "size")),
                ],
                names=["bucket", "sizes", "marks", "digests", "keep_id", "keep_row", "size"],
            )

    dealt = distinct.select(
        history.bucket(F.col("digest")).alias("bucket"), "digest",
        F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "size",
    ).repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
    slots = f"keep_id array<{kind}>, keep_row array<long>, size array<long>"
    built = dealt.mapInArrow(build, f"bucket int, sizes array<long>, marks binary, digests binary, {slots}")
    built.write.partitionBy("bucket").parquet(path)
    groups.discard()
    return history


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each bucket together, from batches in the order of ``bucket``, their first column."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if held and own[low] != now:
                yield now, pa.concat_batches(held)
                held = []
            now = int(own[low])
            held.append(batch.slice(low, high - low))
    if held:
        yield now, pa.concat_batches(held)


class Bucket:
    """A bucket as it is looked up: the hash, digests and what their slots hold."""

    def __init__(self, path: str, bucket: int):
        files, place = store(f"{path}/bucket={bucket}")
        self.hashed = None
        if files.get_file_info(place).type == pyarrow.fs.FileType.NotFound:
            return
        found = files.get_file_info(pyarrow.fs.FileSelector(place))
        name = next(f.path for f in found if f.path.endswith(".parquet"))
        row = pyarrow.parquet.read_table(name, filesystem=files).combine_chunks().to_batches()[0]
        sizes = row.column("sizes")[0].as_py()
        marks = np.frombuffer(row.column("marks")[0].as_buffer(), np.uint8)
        self.hashed = PerfectHash(sizes, np.unpackbits(marks, count=sum(sizes)).astype(bool))
        self.digests = np.frombuffer(row.column("digests")[0].as_buffer(), "<u8").reshape(-1, DIGEST_BYTES // 8)
        self.slots = [row.column(name)[0].values for name in ("keep_id", "keep_row", "size")]

    def find(self, digests: pa.Array) -> list[pa.Array]:
        """What the slots of these digests hold; nulls for digests that are in none."""
        words = words_of(digests)
        if self.hashed is None:
            return []
        slots = self.hashed.slots(words)
        known = slots >= 0
        known[known] = (self.digests[slots[known]] == words[known]).all(axis=1)
        return [column.take(pa.array(slots, mask=~known)) for column in self.slots]


_loaded: dict[tuple[str, int], Bucket] = {}


def bucket_of(path: str, bucket: int) -> Bucket:
    """A bucket from the shared folder; a worker keeps the last one."""
    if (path, bucket) not in _loaded:
        _loaded.clear()
        _loaded[path, bucket] = Bucket(path, bucket)
    return _loaded[path, bucket]


def looked_up(rows: DataFrame, history: History) -> DataFrame:
    """The rows of ``digested`` with ``keep_id``, ``keep_row`` and ``size`` of their digest's slot, nulls if none.

    Rows meet the bucket of their digest; a bucket with very many rows is split over tasks by adaptive
    execution, as any task can read any bucket.
    """
    path, kind = history.path, rows.schema["id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, part in by_bucket(iter([batch])):
                found = bucket_of(path, bucket).find(part.column("digest"))
                types = (part.column("id").type, pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], *(found or (pa.nulls(part.num_rows, t) for t in types))],
                    names=[*part.schema.names[1:], "keep_id", "keep_row", "size"],
                )

    dealt = rows.select(history.bucket(F.col("digest")).alias("bucket"), "id", "digest", "chars", "row")
    return dealt.hint("rebalance", "bucket").sortWithinPartitions("bucket").mapInArrow(
        look, f"id {kind}, digest binary, chars int, row long, keep_id {kind}, keep_row long, size long"
    )


def exact_dedup(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    history: Sequence[History] = (),
    bucket_rows: int = BUCKET_ROWS,
    new_history: str | None = None,
) -> DataFrame:
    """A row per row of ``documents``: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are the same without ASCII white space. A text that one of the histories
    holds repeats the row located there: it is dropped, and ``group_size`` counts the rows that the
    history was made of. All others are grouped, into a history at ``new_history`` for later batches;
    of a group the row with the most characters stays, then the smallest key, a null key last, then
    any one of equal rows, so that exactly one row of a group is ``kept``.

    A null text counts as empty, and empty texts are a group like any other. Rows that repeat are rows
    of one group. Texts of any length are hashed whole; other columns are not read; no rows give none.
    """
    spark = documents.sparkSession
    left = Staged(digested(documents, key, text), "digests").read()
    rows = []
    for known in history:
        looked = Staged(looked_up(left, known), "looked-up").read()
        member = F.col("keep_row").isNotNull()
        rows.append(looked.where(member).withColumn("kept", F.lit(False)))
        left = looked.where(~member).select("id", "digest", "chars", "row")
    own = write_history(left, new_history or new_path(spark, "history"), bucket_rows)
    rows.append(looked_up(left, own).withColumn("kept", F.col("row") == F.col("keep_row")))
    found = rows[0]
    for more in rows[1:]:
        found = found.unionByName(more)
    return found.select(
        F.col("id").alias(key), "keep_id", F.col("size").alias("group_size"), "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
