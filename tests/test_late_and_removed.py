"""Upserts into buckets, rows that arrive late, removed nodes and relationships, cleared properties."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from sluiceway import NodePattern, PropertyGraph
from sluiceway.graph import buckets
from sluiceway.graph.write import GraphWrite


@pytest.fixture(params=[1 << 30, 1500], ids=["one folder", "many folders"])
def folder_bytes(request, monkeypatch):
    monkeypatch.setattr(GraphWrite, "folder_bytes", request.param)


def stored(graph, *columns):
    return sorted(map(tuple, graph.read_nodes(":T").select(*columns).collect()), key=str)


def test_buckets_against_plain_upserts(spark, tmp_path):
    draw, graphs = random.Random(3), [PropertyGraph(spark, str(tmp_path / name)) for name in "ab"]
    batches = [[(draw.randrange(40), f"k{draw.randrange(3)}", n, draw.choice([None, "x", "y"])) for n in range(60)] for _ in range(3)]
    for turn, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "id long, kind string, n long, text string")
        frame = frame.withColumn("extra", F.lit(turn)) if turn == 2 else frame
        for graph, options in zip(graphs, ({}, {"buckets": 4} if turn != 1 else {}), strict=True):
            graph.write_nodes(frame, ":T", "id,kind", "overwrite", order_by=["n"], **options)
    columns = ("id", "kind", "n", "text", "extra")
    assert stored(graphs[0], *columns) == stored(graphs[1], *columns) != []
    assert len(graphs[1].folders()) == 1
    # another session, or a catalog that was lost, reads the same rows
    for table in spark.catalog.listTables():
        if table.name.startswith("sluiceway_"):
            spark.sql(f"DROP TABLE {table.name}")
    assert stored(graphs[1], *columns) == stored(graphs[0], *columns)
    graphs[1].write_nodes(spark.createDataFrame([(99, "k", 1)], "id long, kind string, n long"), ":T", "id,kind", "overwrite", buckets=4)
    assert graphs[1].read_nodes(":T").where("id = 99").count() == 1
    with pytest.raises(ValueError, match="without buckets"):
        graphs[0].write_nodes(frame, ":T", "id,kind", "overwrite", order_by=["n"], buckets=4)
    graphs[1].write_nodes(frame.select("id", "kind"), ":T", mode="append")  # a table of plain folders from now on
    assert graphs[1].read_nodes(":T").count() == graphs[0].read_nodes(":T").count() + 1 + 60
    graphs[1].delete_nodes(spark.createDataFrame([("k0",)], "kind string"), ":T", "kind")
    assert graphs[1].read_nodes(":T").where("kind = 'k0'").count() == 0


def test_the_stored_side_is_not_shuffled(spark, tmp_path, capsys, monkeypatch):
    plans = []
    plain = buckets.write_bucketed

    def explained(frame, *others):
        frame.explain()
        plans.append(capsys.readouterr().out)
        plain(frame, *others)

    monkeypatch.setattr("sluiceway.graph.write.write_bucketed", explained)
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    batch = lambda low, high: spark.range(low, high).withColumn("v", F.col("id") * 2)
    graph.write_nodes(batch(0, 500), ":T", "id", "overwrite", buckets=8)
    graph.write_nodes(batch(300, 900), ":T", "id", "overwrite")
    join = plans[1]
    assert "FullOuter" in join and join.count("Exchange") == 1 and "Bucketed: true" in join
    sides = join[join.index("FullOuter") :]
    assert "Bucketed: true" in sides[: sides.index("Exchange")]  # the stored side comes first, without one
    files = [re.search(r"_(\d{5})\.c000", f)[1] for f in map(str, (tmp_path / "g").rglob("*_0*.parquet"))]
    assert len(files) == 16 and len(set(files)) == 8  # a file for each bucket and version


@pytest.mark.parametrize("in_buckets", [0, 3])
def test_batches_in_any_order(spark, tmp_path, folder_bytes, in_buckets):
    rows = [[(n, day, f"{day}-{n}-{tie}") for n in range(30) if (n + day) % 4] for day, tie in ((1, "a"), (2, "b"), (2, "c"))]
    tables = []
    for turn, order in enumerate(([0, 1, 2], [2, 1, 0], [1, 0, 2])):
        graph = PropertyGraph(spark, str(tmp_path / f"g{turn}"))
        for n in order:
            frame = spark.createDataFrame(rows[n], "id long, day long, text string")
            graph.write_nodes(frame, ":T", "id", "overwrite", ["day"], newest=True, buckets=in_buckets)
        tables.append(stored(graph, "id", "day", "text"))
    best = {}
    for key, day, text in sorted(itertools.chain(*rows), key=lambda r: (r[1], r[2])):
        best[key] = (key, day, text)
    assert tables == [sorted(best.values(), key=str)] * 3


def test_a_first_value_of_the_order(spark, tmp_path):
    """Stored rows without the order, or with NULL, are before all others."""
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    graph.write_nodes(spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string"), ":T", "id", "overwrite")
    late = lambda rows: graph.write_nodes(
        spark.createDataFrame(rows, "id long, text string, day long"), ":T", "id", "overwrite", ["day"], newest=True
    )
    late([(1, "c", None), (2, "d", 5)])
    late([(1, "e", 1), (2, "f", 4), (3, "g", 1)])
    assert stored(graph, "id", "text", "day") == [(1, "e", 1), (2, "d", 5), (3, "g", 1)]
    for wrong in ({"mode": "append", "order_by": ["day"]}, {"mode": "overwrite"}):
        with pytest.raises(ValueError, match="newest"):
            graph.write_nodes(spark.createDataFrame([(1, 2)], "id long, day long"), ":T", "id", newest=True, **wrong)


@pytest.fixture
def people(spark, tmp_path, folder_bytes):
    """A hundred nodes, some of a second label, with two types of relationships in a ring."""
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    graph.write_nodes(spark.range(0, 60).withColumn("v", F.col("id") + 0.5), ":T", "id", "overwrite")
    graph.write_nodes(spark.range(60, 100).withColumn("v", F.col("id") + 0.5), ":T:U", "id", "overwrite")
    ring = spark.range(100).selectExpr("id AS a", "(id + 1) % 100 AS b", "id % 2 AS n")
    for rel_type in ("R", "S"):
        graph.write_relationships(ring, rel_type, NodePattern(":T", "a:id"), NodePattern(":T", "b:id"), "overwrite", keys="n")
    return graph


def ring(graph, rel_type="R"):
    return {r["source.id"] for r in graph.read_relationships(rel_type).collect()}


def test_removed_nodes(spark, people):
    gone = spark.createDataFrame([("5",), ("70",), ("70",), ("500",), ("x",), (None,)], "key string")
    with pytest.raises(ValueError, match="detach"):
        people.delete_nodes(gone, ":T", "key:id", detach=False)
    assert people.read_nodes(":T").count() == 100 and len(ring(people)) == 100
    people.delete_nodes(gone, ":U", "key:id")
    assert {r["id"] for r in people.read_nodes(":T").collect()} == set(range(100)) - {70}
    people.delete_nodes(gone, ":T", "key:id")
    left = set(range(100)) - {5, 70}
    assert {r["id"] for r in people.read_nodes(":T").collect()} == left
    assert ring(people) == ring(people, "S") == left - {4, 69}
    before = people.folders()
    people.delete_nodes(gone, ":T", "key:id", detach=False)  # nothing is left to remove
    assert people.folders() == before
    people.write_nodes(spark.createDataFrame([(5, 1.0)], "id long, v double"), ":T", "id", "overwrite")
    assert people.read_nodes(":T").count() == 99 and len(ring(people)) == 96  # a new node, without the old one's


def test_removed_relationships(spark, people):
    ends = NodePattern(":T", "a:id"), NodePattern(":T", "b:id")
    gone = spark.createDataFrame([(1, 2, 1), (1, 2, 1), (3, 4, 0), (7, 9, 1), (None, 3, 1)], "a long, b long, n long")
    people.delete_relationships(gone, "R", *ends, "n")
    assert ring(people) == set(range(100)) - {1} and ring(people, "S") == set(range(100))
    people.delete_relationships(gone, "R", *ends)
    assert ring(people) == set(range(100)) - {1, 3}
    assert people.read_nodes(":T").count() == 100


def test_cleared_properties(spark, people):
    rows = spark.createDataFrame([(5,), (5,), (70,), (500,), (None,)], "key long")
    people.clear_properties(rows, ":T", "key:id", "v,other")
    found = {r["id"]: r["v"] for r in people.read_nodes(":T").collect()}
    assert found == {n: None if n in (5, 70) else n + 0.5 for n in range(100)}
    with pytest.raises(ValueError, match="clearing"):
        people.clear_properties(rows, ":T", "key:id", "id")


@pytest.mark.parametrize("mixed", [False, True])
def test_removals_of_many_are_joined_by_keys(spark, tmp_path, monkeypatch, mixed):
    """Identities that follow from keys are not shuffled, unless other nodes of the type have the same keys."""
    graph, joined = PropertyGraph(spark, str(tmp_path / "g")), []
    rows = spark.createDataFrame([(n % 40, n % 30, n) for n in range(200)], "a long, b long, n long")
    ends = NodePattern(":Part", "a:id"), NodePattern(":Supplier", "b:id")
    graph.merge_pattern(rows, "SHIPPED", *ends, "n")
    others = NodePattern(":Tool", "a:id"), ends[1]
    if mixed:
        graph.merge_pattern(rows, "SHIPPED", *others, "n")
    work = GraphWrite._without

    def watched(self, item, wanted, keys, *rest):
        joined.append(list(keys))
        return work(self, item, wanted, keys, *rest)

    monkeypatch.setattr(GraphWrite, "_without", watched)
    graph.delete_relationships(rows.where("n % 2 = 0").unionByName(rows.selectExpr("a", "b", "n + 1000 AS n")), "SHIPPED", *ends, "n")
    # each pair of labels has a table of its own
    assert joined == [["source.id", "target.id", "rel.n"], ["<source.id>", "target.id", "rel.n"]][: 1 + mixed]
    left = sorted(r.n for r in graph.read_relationships("SHIPPED", ":Part").selectExpr("`rel.n` AS n").collect())
    assert left == list(range(1, 200, 2))
    if mixed:
        assert graph.read_relationships("SHIPPED", ":Tool").count() == 200
    # what is left can be merged and removed again
    graph.merge_pattern(rows, "SHIPPED", *ends, "n")
    assert graph.read_relationships("SHIPPED", ":Part").count() == 200
    graph.delete_relationships(rows, "SHIPPED", *ends, "n")
    assert graph.read_relationships("SHIPPED", ":Part").count() == 0
