"""Centroid clustering, against plain loops; the curve and the bounds alone; odd vectors."""

import hashlib
import itertools
import math
import random

import numpy as np
from corpus_fixtures import nothing  # noqa: F401  (fixture)
from pyspark.sql import functions as F

from sluiceway.llm import clustering


def plain(rows, dims, count, rounds):
    """Vector numbers, by row, of key, cluster, squared distance, sums and the centroid's hash."""
    good = [
        (key, [max(-clustering.LARGEST, min(clustering.LARGEST, math.floor(256 * x))) for x in vector]) for key, vector in rows
        if vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) for x in vector)
    ]
    draw = lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    bytes_of = lambda v: np.array(v, "<i4").tobytes()
    centres = [v for _, v in sorted(good, key=lambda r: (draw(r), bytes_of(r[1])))[:count]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for last in range(rounds + 1):
        own = [min(range(len(centres)), key=lambda c: (far(v, centres[c]), c)) for _, v in good]
        if last < rounds:
            for c in range(len(centres)):
                if members := [v for (_, v), o in zip(good, own, strict=True) if o == c]:
                    centres[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    distance = [far(v, centres[o]) for (_, v), o in zip(good, own, strict=True)]
    inertia = [sum(d for d, o in zip(distance, own, strict=True) if o == c) for c in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        ((key, o, d, inertia[o], sum(distance), sha[o]) for (key, _), o, d in zip(good, own, distance, strict=True)), key=str
    )


def found(frame, **options):
    rows = clustering.clusters(frame, **options)
    assert rows.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in rows.collect()), key=str)


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for dims, bits in ((2, 4), (3, 2), (4, 1), (1, 3)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = clustering.hilbert_keys(points, bits)
        assert len(set(keys)) == len(points)
        path = points[sorted(range(len(points)), key=keys.__getitem__)]
        assert set(np.abs(np.diff(path, axis=0)).sum(axis=1).tolist()) == {1}


def test_boxes_leave_out_only_centroids_that_cannot_be_nearest():
    draw = np.random.default_rng(3)
    left_out = 0
    for _ in range(300):
        middle = draw.integers(-200, 200, 6)
        points = middle + draw.integers(-20, 21, (30, 6))
        centroids = draw.integers(-200, 200, (12, 6))
        low, high = points.min(axis=0), points.max(axis=0)
        costs = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
        near = clustering.candidates(low, high, centroids)
        assert {n for row in costs for n in np.flatnonzero(row == row.min())} <= set(near.tolist())
        left_out += 12 - len(near)
        own, distance = clustering.assigned(points, low, high, centroids)
        assert own.tolist() == costs.argmin(axis=1).tolist() and distance.tolist() == costs.min(axis=1).tolist()
    assert left_out > 1000


def test_rows_against_loops(spark):
    draw = random.Random(8)
    middles = [[draw.uniform(-1, 1) for _ in range(6)] for _ in range(9)]
    rows = [(n, [x + draw.gauss(0, 0.1) for x in draw.choice(middles)]) for n in range(300)]
    rows += [(n, rows[0][1]) for n in range(300, 420)]  # very many of one vector
    rows += [(7, rows[7][1]), (8, rows[9][1]), (None, rows[3][1])]  # repeated, and a key with two vectors
    rows += [(500, None), (501, []), (502, [1.0] * 5), (503, [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    rows += [(504, [math.nan] * 6), (505, [math.inf] + [0.0] * 5), (506, [0.0] * 6), (507, [-0.001] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x")).repartition(4)
    assert found(frame, dims=6, count=7, rounds=3, block_rows=16) == plain(rows, 6, 7, 3)


def test_large_components_few_vectors_and_none(spark, nothing):
    rows = [(1, [1e30, -1e30]), (2, [3e5, 2.0]), (3, [3e5, 2.5]), (4, [-3e5, 0.25])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(frame, dims=2, count=2, rounds=2) == plain(rows, 2, 2, 2)
    assert found(frame, dims=2, count=9, rounds=1) == plain(rows, 2, 9, 1)
    assert found(frame, dims=3) == []
    assert found(spark.createDataFrame([], "vec_id long, embedding array<float>")) == []


def test_an_empty_cluster_stays(spark):
    rows = [(n, [0.0, 0.0]) for n in range(6)] + [(9, [5.0, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(frame, dims=2, count=7, rounds=2) == plain(rows, 2, 7, 2)
