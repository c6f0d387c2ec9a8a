"""Approximate nearest neighbours: a small-world graph per shard, and the shards' results merged."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.graph_index import SmallWorld
from sluiceway.llm.shared import Staged, new_path, part_count, store

#: Distinct vectors of a shard at most, about; a shard is built and searched in one task's memory.
SHARD_ROWS = 20_000
#: Shards at least, so that small tables use more than one core.
LEAST_SHARDS = 8
DEGREE, BUILD_BREADTH, SEARCH_BREADTH = 16, 100, 160
#: Queries that a search task has for a shard, about.
QUERY_ROWS = 5_000


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


_loaded: dict[str, tuple] = {}


def loaded(path: str) -> tuple[SmallWorld, list[list[int]]]:
    """The index of a shard; a worker keeps the last one."""
    if path not in _loaded:
        _loaded.clear()
        files, place = store(path)
        with files.open_input_stream(place) as stream:
            data, members = pickle.loads(stream.read())
        _loaded[path] = SmallWorld.load(data), members
    return _loaded[path]


def build_shards(vectors: DataFrame, most: int, shards: int, folder: str) -> Staged:
    """``dims``, ``shard``, ``path`` of the graphs over distinct vectors (``id``, ``vector``).

    Vectors that are equal are one node with the ``most`` smallest identifiers, all that a result of
    fewer rows can hold. Spark limits the rows of a vector before the shuffle.
    """
    same = Window.partitionBy("vector").orderBy("id")
    nodes = (
        vectors.withColumn("turn", F.row_number().over(same))
        .where(F.col("turn") <= most)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("dims", F.size("vector"))
        .withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[tuple[int, int], list[tuple[np.ndarray, list[list]]]] = {}
        for batch in batches:
            kinds = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in (0, 1)], axis=1)
            for dims, shard in np.unique(kinds, axis=0).tolist() if len(kinds) else []:
                part = batch.filter(pa.array((kinds == (dims, shard)).all(axis=1)))
                rows.setdefault((dims, shard), []).append((matrix(part.column(2), dims), part.column(3).to_pylist()))
        done: list[tuple[int, int, str]] = []
        files, base = store(folder)
        files.create_dir(base, recursive=True)
        for (dims, shard), held in sorted(rows.items()):
            ids = [own for _, part in held for own in part]
            order = sorted(range(len(ids)), key=lambda n: ids[n])  # the same graph whatever order rows come in
            index = SmallWorld.build(np.concatenate([part for part, _ in held])[order], DEGREE, BUILD_BREADTH)
            name = f"{uuid.uuid4().hex}.graph"  # of this attempt; only what it reports is read
            with files.open_output_stream(f"{base}/{name}") as stream:
                stream.write(pickle.dumps((index.dump(), [ids[n] for n in order])))
            done.append((dims, shard, f"{folder}/{name}"))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x for x, _, _ in done], pa.int32()), pa.array([x for _, x, _ in done], pa.int32()),
                pa.array([x for _, _, x in done], pa.string()),
            ],
            names=["dims", "shard", "path"],
        )

    dealt = nodes.select("dims", "shard", "vector", "ids").repartitionById(shards, F.col("shard"))
    return Staged(dealt.mapInArrow(build, "dims int, shard int, path string"), "graphs")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def nearest(
    vectors: DataFrame,
    queries: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = 20,
    breadth: int = SEARCH_BREADTH,
    shard_rows: int = SHARD_ROWS,
    least_shards: int = LEAST_SHARDS,
) -> DataFrame:
    """``query_id``, ``rank``, key, ``score``: for each row that ``queries`` holds for, the rows found
    with the largest inner product, its own key left out, ties to the smaller key.

    Vectors that are null, empty, all zero, or hold a null or non-finite component take no part, nor
    do rows with a null key; vectors meet those of their own length. A repeated row counts once; a key
    with several vectors is found, and asks, by each, and the largest product of a pair of keys counts.
    With fewer candidates all that are found come; no rows give none. Other columns are not read.
    Scores are products of the vectors as given, in double precision.
    """
    spark = vectors.sparkSession
    good = Staged(
        vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"), queries.alias("asks"))
        .where(F.col("id").isNotNull() & usable(F.col("vector")))
        .dropDuplicates(["id", "vector"]),
        "vectors",
    ).read()
    shards = max(least_shards, part_count(spark, good.count(), shard_rows))
    graphs = build_shards(good.select("id", "vector"), count + 1, shards, new_path(spark, "graphs")).read()
    asked = good.where("asks").select("id", "vector", F.size("vector").alias("dims")).join(graphs, "dims")
    splits = part_count(spark, asked.count(), shards * QUERY_ROWS)  # of the queries of a shard
    kind = vectors.schema[key].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            paths = batch.column(0).to_pylist()
            cuts = [n for n in range(len(paths)) if n == 0 or paths[n] != paths[n - 1]]
            for low, high in zip(cuts, [*cuts[1:], len(paths)], strict=True):
                index, members = loaded(paths[low])
                asking = matrix(batch.column(2).slice(low, high - low), index.vectors.shape[1])
                queries = batch.column(1).slice(low, high - low).to_pylist()
                for query, own, found in zip(queries, asking, index.search(asking, breadth), strict=True):
                    scores = np.einsum("ij,j->i", index.vectors[found], own)
                    rows = [(-s, i) for s, n in zip(scores.tolist(), found, strict=True) for i in members[n] if i != query]
                    for score, other in sorted(rows)[:count]:
                        for column, value in zip(out, (query, other, -score), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.column(1).type), pa.array(out[1], batch.column(1).type), pa.array(out[2], pa.float64())],
                names=["query_id", "found_id", "score"],
            )

    place = F.col("shard") * splits + F.pmod(F.xxhash64("id"), F.lit(splits)).cast("int")
    dealt = (
        asked.select("path", "id", "vector", place.alias("place"))
        .repartitionById(shards * splits, F.col("place"))
        .sortWithinPartitions("path")
        .select("path", "id", "vector")
    )
    found = dealt.mapInArrow(search, f"query_id {kind}, found_id {kind}, score double")
    found = found.groupBy("query_id", "found_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "found_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= count)
        .select("query_id", "rank", F.col("found_id").alias(key), "score")
    )
