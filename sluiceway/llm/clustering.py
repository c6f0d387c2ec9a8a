"""Centroid clustering over blocks of vectors in Hilbert order, with zone maps that leave few centroids to compare.

Vectors become integers, so that sums, means and distances are exact and do not depend on the order
rows come in. They are sorted along a Hilbert curve and cut into blocks that keep the smallest and
largest value of each component. From a block's box follow the least and the most distance each
centroid can have to its vectors; only centroids that can be nearest are compared, vector by vector.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import Staged, part_count

#: Vectors of a block, and of a sorted partition, about.
BLOCK_ROWS = 256
PART_ROWS = 200_000
LEAST_PARTS = 32
#: Bits of each component in the Hilbert order; more only refine it.
CURVE_BITS = 4
#: Components beyond this count as this, so that squared distances fit 64 bits.
LARGEST = 2**27
#: Up to this, products of 64 components are exact in double precision, where numpy is fastest.
EXACT = 2**22


def whole(vector: Column, dims: int) -> Column:
    """Whether a vector has so many components, all finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places along the Hilbert curve, as bytes that sort as the curve goes, of rows of whole numbers
    below ``2 ** bits``: the axes are folded bit by bit, then Gray-coded and interleaved."""
    axes = [cells[:, i].astype(np.uint32) for i in range(cells.shape[1])]
    top = 1 << (bits - 1)
    bit = top
    while bit > 1:
        low = np.uint32(bit - 1)
        for i in range(len(axes)):
            flip = (axes[i] & np.uint32(bit)) != 0
            swap = np.where(flip, np.uint32(0), (axes[0] ^ axes[i]) & low)
            axes[0] = axes[0] ^ np.where(flip, low, swap)
            axes[i] = axes[i] ^ swap if i else axes[0]
        bit >>= 1
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros(len(cells), np.uint32)
    bit = top
    while bit > 1:
        turn ^= np.where((axes[-1] & np.uint32(bit)) != 0, np.uint32(bit - 1), np.uint32(0))
        bit >>= 1
    planes = np.stack([a ^ turn for a in axes], axis=1)
    spread = np.concatenate([(planes >> np.uint32(b)) & np.uint32(1) for b in reversed(range(bits))], axis=1)
    return [row.tobytes() for row in np.packbits(spread.astype(bool), axis=1)]


def integers(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of the components, a row a vector."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.clip(np.floor(values * scale), -LARGEST, LARGEST).astype(np.int32)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Staged vectors of one length each as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to some vector in the box, ties included."""
    under, over = low - centroids, centroids - high
    least = np.square(np.maximum(np.maximum(under, over), 0)).sum(axis=1)
    most = np.square(np.maximum(np.abs(under), np.abs(over))).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def assigned(points: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point, the smallest number of several, and the squared distance."""
    near = candidates(low, high, centroids)
    some = centroids[near]
    largest = max(np.abs(low).max(), np.abs(high).max(), np.abs(some).max())
    kind = np.float64 if largest <= EXACT else np.int64
    x, c = points.astype(kind), some.astype(kind)
    costs = np.square(c).sum(axis=1) - 2 * (x @ c.T)
    best = costs.argmin(axis=1)
    distance = costs[np.arange(len(x)), best] + np.square(x).sum(axis=1)
    return near[best], distance.astype(np.int64)


def in_blocks(vectors: DataFrame, dims: int, block_rows: int) -> DataFrame:
    """``ids``, ``points``, ``low``, ``high`` of blocks along the curve, from ``id``, ``data``.

    Vectors in one cell of the curve, or all the same, are dealt by their keys, so that no partition
    holds more for having many of them.
    """
    kind = vectors.schema["id"].dataType.simpleString()

    def extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes = [(m.min(axis=0), m.max(axis=0)) for b in batches if len(m := matrix(b.column(0), dims))]
        if boxes:
            low, high = (np.stack(x) for x in zip(*boxes, strict=True))
            columns = [np.arange(dims, dtype=np.int32), low.min(axis=0), high.max(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "low", "high"])

    boxes = vectors.select("data").mapInArrow(extents, "dim int, low int, high int")
    found = boxes.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
    least = np.array([r.low for r in found], np.int64)
    span = np.array([r.high for r in found], np.int64) - least + 1

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = ((matrix(batch.column(1), dims) - least) << CURVE_BITS) // span
            keys = pa.array(hilbert_keys(cells, CURVE_BITS), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=["id", "data", "curve"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, block_rows):
            points = matrix(batch.column(1), dims)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays([0, len(points)], batch.column(0)),
                    *(pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (points, points.min(axis=0), points.max(axis=0))),
                ],
                names=["ids", "points", "low", "high"],
            )

    parts = max(LEAST_PARTS, part_count(vectors.sparkSession, vectors.count(), PART_ROWS))
    curve = vectors.mapInArrow(keyed, f"id {kind}, data binary, curve binary")
    order = [F.col("curve"), F.xxhash64("data"), F.xxhash64("id")]
    dealt = curve.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "data")
    return dealt.mapInArrow(cut, f"ids array<{kind}>, points binary, low binary, high binary")


def rebatched(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of so many; the last may have fewer."""
    held, size = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - size)
            batch = batch.slice(part.num_rows)
            held.append(part)
            size += part.num_rows
            if size == rows:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def blocks_of(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Identifiers, points and box of each staged block."""
    for batch in batches:
        for n in range(batch.num_rows):
            low, high = (np.frombuffer(batch.column(c)[n].as_py(), "<i4").astype(np.int64) for c in (2, 3))
            points = np.frombuffer(batch.column(1)[n].as_py(), "<i4").reshape(-1, dims)
            yield batch.column(0)[n].values, points, low, high


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floored mean of its vectors; one without any stays.

    A task adds its blocks up and gives a row for each centroid at most.
    """
    count, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, sums = np.zeros(count, np.int64), np.zeros((count, dims), np.int64)
        for _, points, low, high in blocks_of(batches, dims):
            own, _ = assigned(points, low, high, centroids)
            sizes += np.bincount(own, minlength=count)
            order = np.argsort(own, kind="stable")
            starts = np.flatnonzero(np.diff(own[order], prepend=-1))
            sums[own[order][starts]] += np.add.reduceat(points[order].astype(np.int64), starts, axis=0)
        some = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)), pa.array(sizes[some]),
                pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * dims, pa.array(sums[some].ravel())),
            ],
            names=["cluster", "n", "sums"],
        )

    added = blocks.mapInArrow(add, "cluster int, n long, sums array<long>").groupBy("cluster")
    totals = added.agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(dims))).alias("sums"))
    new = centroids.copy()
    for row in totals.collect():  # one for each centroid
        new[row.cluster] = np.array(row.sums, np.int64) // row.n
    return new


def clusters(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    dims: int = 64,
    scale: int = 256,
    count: int = 40,
    rounds: int = 5,
    seed: int = 2,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """A row per vector: key, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Components become ``floor(scale * x)``, at most 2 to the 27th either way. The first centroids are the
    vectors with the smallest SHA-256 of ``seed:key``; of rows with one key those with smaller bytes. Rounds
    of assigning and averaging follow, and a last assignment; ties go to the smaller number. Distances are
    squared; the sums of distances are null if they do not fit 64 bits.

    Vectors that are null, of another length, or hold a null or non-finite component are left out. A null
    key is hashed as empty text. Repeated rows count each. With fewer vectors than centroids each is a
    centroid; no rows give none. Other columns are not read.
    """
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    given = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector")).where(whole(F.col("vector"), dims))

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = integers(batch.column(1), dims, scale).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([row.tobytes() for row in rows], pa.binary())], names=["id", "data"]
            )

    points = Staged(given.mapInArrow(rounded, f"id {kind}, data binary"), "vectors").read()
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = points.select(draw.alias("draw"), "data").orderBy("draw", "data").limit(count).collect()
    columns = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], f"`{key}` {kind}, {columns}")
    centroids = np.stack([np.frombuffer(row.data, "<i4") for row in first]).astype(np.int64)
    blocks = Staged(in_blocks(points, dims, block_rows), "blocks").read()
    for _ in range(rounds):
        centroids = moved(blocks, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, members, low, high in blocks_of(batches, dims):
            own, distance = assigned(members, low, high, centroids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(own.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"]
            )

    found = Staged(blocks.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "assigned").read()
    totals = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    fits = lambda n: n if n < 2**63 else None
    inertia = fits(sum(int(row["sum"]) for row in totals))
    facts = [
        (row.cluster, fits(int(row["sum"])), inertia, hashlib.sha256(",".join(map(str, centroids[row.cluster])).encode()).hexdigest())
        for row in totals  # one for each centroid
    ]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
