"""Reachability and triangles, against sets; a hub, cycles, several types and labels."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sluiceway import NodePattern, PropertyGraph, Source, read
from sluiceway.graph import patterns
from sluiceway.storage import Staged


def graph_of(spark, path, pairs, kind="long"):
    graph = PropertyGraph(spark, str(path))
    frame = spark.createDataFrame(pairs, f"a {kind}, b {kind}")
    ends = NodePattern(":N", "a:id", "overwrite"), NodePattern(":N", "b:id", "overwrite")
    graph.write_relationships(frame, "R", *ends, "append")
    return graph


def closure(pairs, hops=10**9):
    found, newest, depth = {}, set(pairs), 1
    while newest and depth <= hops:
        found |= {pair: depth for pair in newest}
        newest = {(a, d) for a, b in newest for c, d in pairs if b == c} - set(found)
        depth += 1
    return found


def reached(rows):
    out = [((r["source.id"], r["target.id"]), r["hops"]) for r in rows.collect()]
    assert len(dict(out)) == len(out)
    return dict(out)


def test_reach(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(patterns, "MOST_SEEN", 3)
    draw = random.Random(4)
    pairs = [(n, n + 1) for n in range(9)] + [(9, 4), (20, 20), (30, 31), (31, 30)]  # a chain into a cycle, a loop
    pairs += [(draw.randrange(40, 60), draw.randrange(40, 60)) for _ in range(25)] * 2  # repeated ones
    graph = graph_of(spark, tmp_path / "g", pairs)
    assert reached(graph.reach("R")) == closure(set(pairs))
    starts = spark.createDataFrame([(0,), (0,), (30,), (99,), (None,)], "id int")
    some = {pair: n for pair, n in closure(set(pairs)).items() if pair[0] in (0, 30)}
    assert reached(graph.reach("R", starts)) == some
    assert reached(graph.reach("R", starts, hops=2)) == {pair: n for pair, n in some.items() if n <= 2}
    options = {"path": str(tmp_path / "g"), "relationship": "R", "relationship.hops": "1"}
    assert set(reached(read(spark, Source("graph", options)))) == set(pairs)
    with pytest.raises(ValueError, match="no relationships"):
        graph.reach("OTHER")


def triples(rows):
    out = [tuple(r[name]["id"] for name in ("first", "second", "third")) for r in rows.collect()]
    assert all(list(t) == sorted(t) for t in out) and len(set(out)) == len(out)
    return set(out)


def plain_triangles(pairs):
    near = {frozenset(p) for p in pairs if p[0] != p[1]}
    nodes = sorted({n for p in near for n in p})
    return {t for t in itertools.combinations(nodes, 3) if all(frozenset(p) in near for p in itertools.combinations(t, 2))}


def test_triangles(spark, tmp_path):
    draw = random.Random(7)
    pairs = [(draw.randrange(25), draw.randrange(25)) for _ in range(90)]
    pairs += [(b, a) for a, b in pairs[:30]] + [(3, 3), (100, 101)]
    assert triples(graph_of(spark, tmp_path / "g", pairs).triangles("R")) == plain_triangles(pairs) != set()
    assert triples(graph_of(spark, tmp_path / "h", [("x", "y"), ("y", "z")], "string").triangles("R")) == set()


def test_a_hub_is_not_squared(spark):
    """What is joined stays small, though one node has a third of all ends."""
    hub = spark.range(1, 3001).select(F.lit(0).cast("long").alias("s"), F.col("id").alias("t"))
    ring = spark.range(1, 3001).select(F.col("id").alias("s"), (F.col("id") % 3000 + 1).alias("t"))
    edges = hub.unionByName(ring)
    with Staged(spark) as staged:
        pairs = staged.rows(patterns.oriented(edges, staged))
        assert pairs.count() == 6000 and pairs.where("u = 0").count() == 0
        assert patterns.wedges(pairs).count() <= 6000 * 2  # squared, the hub alone would have 4.5 million
        assert patterns.triangles(edges, staged).count() == 3000


def test_recursive_query_of_over_a_million_rows(spark, tmp_path):
    graph = graph_of(spark, tmp_path / "g", list(itertools.product(range(4), repeat=2)))
    setting = "spark.sql.cteRecursionRowLimit"
    sql = """
        WITH RECURSIVE paths(a, b, n) AS (
            SELECT `source.id`, `target.id`, 1 FROM {R}
            UNION ALL SELECT a, r.`target.id`, n + 1 FROM paths JOIN {R} r ON r.`source.id` = b WHERE n < 9)
        SELECT n, count(*) AS paths FROM paths GROUP BY n
    """
    assert {tuple(row) for row in graph.query(sql).collect()} == {(n, 4 ** (n + 1)) for n in range(1, 10)}
    assert spark.conf.get(setting, None) is None
    spark.conf.set(setting, "1000")  # a limit of the session's own holds
    try:
        with pytest.raises(Exception, match="RECURSION_ROW_LIMIT"):
            graph.query(sql).collect()
    finally:
        spark.conf.unset(setting)


def test_what_may_close_is_one_row_a_pair(spark):
    """Forty nodes that all meet: lists of ends, not a row for every two pairs of a node."""
    edges = spark.createDataFrame(list(itertools.combinations(range(40), 2)), "s long, t long")
    with Staged(spark) as staged:
        pairs = staged.rows(patterns.oriented(edges, staged))
        assert patterns.wedges(pairs).count() < pairs.count() == 780  # 9,880 as rows
        found = patterns.triangles(edges, staged)
        assert found.count() == found.distinct().count() == 9880
