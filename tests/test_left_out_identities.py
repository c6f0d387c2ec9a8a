"""Relationships do not store identities of their ends that follow from keys, and are merged by the keys."""

import pytest
from pyspark.sql import functions as F

from sluiceway import NodePattern, PropertyGraph
from sluiceway.graph.model import Table
from sluiceway.graph.write import GraphWrite

ENDS = NodePattern(":A", "a:id", "overwrite"), NodePattern(":B", "b:id", "overwrite")
MATCH = NodePattern(":A", "a:id"), NodePattern(":B", "b:id")
IDS = {"<source.id>", "<target.id>"}


def rows_of(spark, numbers, **properties):
    frame = spark.createDataFrame([(n, n % 3) for n in numbers], "a long, b long")
    return frame.withColumns({name: F.lit(value) for name, value in properties.items()})


def relationships(graph):
    return next(table for table in graph._catalog.load()[1] if table.rel_type)


def stored_columns(spark, graph):
    """Those that the files of relationships have, folder by folder."""
    return [set(spark.read.parquet(path).columns) for path in relationships(graph).paths]


def found(graph, *names):
    rows = graph.read_relationships("R").select("`source.id`", "`target.id`", *(f"`rel.{n}`" for n in names))
    return sorted(map(tuple, rows.collect()))


def test_an_upsert_of_all_stores_no_identities_and_shuffles_each_side_once(spark, tmp_path, monkeypatch):
    graph, plans, dealt = PropertyGraph(spark, str(tmp_path / "g")), [], []
    monkeypatch.setattr(GraphWrite, "folder_bytes", 10_000)
    kind, write = type(spark.range(0)), GraphWrite._write
    deal = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, *a: dealt.append(a) or deal(self, *a))

    def watched(self, frame, *rest):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return write(self, frame, *rest)

    monkeypatch.setattr(GraphWrite, "_write", watched)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        graph.write_relationships(rows_of(spark, range(8000), p="x"), "R", *ENDS, "overwrite")
        assert not any(IDS & names for names in stored_columns(spark, graph))
        dealt.clear()
        graph.write_relationships(rows_of(spark, range(4000, 12000), q="y"), "R", *ENDS, "overwrite")
    finally:
        spark.conf.unset(setting)
    paths = relationships(graph).paths
    assert not any(IDS & names for names in stored_columns(spark, graph))
    assert len(paths) > 2 and not dealt
    # four partitions of the join, each of which goes to neighbouring folders
    files = sum(len(list((tmp_path / path.split(f"{tmp_path}/")[1]).glob("*.parquet"))) for path in paths)
    assert files <= int(spark.conf.get("spark.sql.shuffle.partitions")) + len(paths) - 1
    (joined,) = [plan.split("Join FullOuter")[1].split("\n")[0] for plan in plans if "Join FullOuter" in plan]
    assert "source.id" in joined and "<source.id>" not in joined
    assert found(graph, "p", "q") == [
        (n, n % 3, "x" if n < 8000 else None, "y" if n >= 4000 else None) for n in range(12000)
    ]


@pytest.mark.parametrize("large", [True, False])
@pytest.mark.parametrize("before", ["left out", "stored"])
def test_stored_identities_and_such_that_follow_are_one(spark, tmp_path, monkeypatch, large, before):
    """Nodes that are found by joins, and relationships of a graph that has all identities stored."""
    monkeypatch.setattr(GraphWrite, "_large", lambda self, batch, item: large)
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    graph.write_relationships(rows_of(spark, range(10), p="x"), "R", *ENDS, "overwrite")
    if before == "stored":
        version, tables = graph._catalog.load()
        old = relationships(graph)
        graph.open(old).write.parquet(str(tmp_path / "g/data" / ("0" * 32)))
        plain = old.with_ends({}).with_data(old.schema, [str(tmp_path / "g/data" / ("0" * 32))], old.unique)
        graph._catalog.publish(version + 1, [plain, *(table for table in tables if table.labels)])
        assert IDS <= stored_columns(spark, graph)[0]
    # there are no nodes for the last of these
    graph.write_relationships(rows_of(spark, range(6, 14), q="y"), "R", *MATCH, "overwrite")
    assert found(graph, "p", "q") == [(n, n % 3, "x", "y" if n >= 6 else None) for n in range(10)]
    graph.write_relationships(rows_of(spark, range(8, 14), p="z"), "R", *ENDS, "overwrite")
    expected = [(n, n % 3, "x" if n < 8 else "z", "y" if 6 <= n < 10 else None) for n in range(14)]
    assert found(graph, "p", "q") == expected
    graph.write_relationships(rows_of(spark, range(0, 2)), "R", *MATCH, "append")
    again = sorted([*expected, *((n, n % 3, None, None) for n in range(2))], key=str)
    assert sorted(found_all(graph), key=str) == again
    graph.compact()
    assert sorted(found_all(graph), key=str) == again
    graph.delete_relationships(rows_of(spark, [0, 7, 12, 50]), "R", *MATCH)
    assert sorted(found_all(graph), key=str) == [row for row in again if row[0] not in (0, 7, 12)]
    graph.delete_nodes(spark.createDataFrame([(13,)], "id long"), ":A", "id")
    assert sorted(found_all(graph), key=str) == [row for row in again if row[0] not in (0, 7, 12, 13)]


def found_all(graph):
    rows = graph.read_relationships("R").select("`source.id`", "`target.id`", "`rel.p`", "`rel.q`")
    return list(map(tuple, rows.collect()))


def test_a_version_without_the_fields_can_be_read():
    values = Table(rel_type="R", source_derived=("s", "id")).to_dict()
    assert Table.from_dict(values).ends == {"source": ("s", "id")}
    old = {name: value for name, value in values.items() if name not in ("source_derived", "target_derived", "mixed")}
    assert Table.from_dict(old).ends == {} and not Table.from_dict(old).mixed
