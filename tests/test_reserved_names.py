"""Names of keys and properties that the writer's own columns would like to have, on small and on split tables."""

import pytest

from sluiceway import NodePattern, PropertyGraph
from sluiceway.graph.write import GraphWrite

NAMES = ("__folder", "__row", "__new", "__key0", "__order0", "source.x", "bucket_")


@pytest.fixture(params=[1 << 30, 1500], ids=["one folder", "many folders"])
def folder_bytes(request, monkeypatch):
    monkeypatch.setattr(GraphWrite, "folder_bytes", request.param)


@pytest.fixture(params=["bucket", "Bucket"])
def names(request):
    return (request.param, *NAMES)


def rows(names, low, high, tag):
    """Keys of all the names, and properties of their texts, by row."""
    return [(i, *(f"{tag}{n}-{i}" for n in range(len(names)))) for i in range(low, high)]


def test_properties(spark, tmp_path, folder_bytes, names):
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    frame = lambda low, high, tag: spark.createDataFrame(rows(names, low, high, tag), ["id", *names])
    graph.write_nodes(frame(0, 200, "a"), ":T", "id", "overwrite", order_by=names[:-2])
    graph.write_nodes(frame(100, 300, "b"), ":T", "id", "overwrite")
    found = sorted(map(tuple, graph.read_nodes(":T").select("id", *(f"`{n}`" for n in names)).collect()))
    assert found == rows(names, 0, 100, "a") + rows(names, 100, 300, "b")


def test_keys(spark, tmp_path, folder_bytes, names):
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    frame = lambda low, high, tag: spark.createDataFrame(
        [(*row, tag) for row in rows(names, low, high, "k")], ["id", *names, "tag"]
    )
    keys = {name: name for name in ("id", *names)}
    graph.write_nodes(frame(0, 200, "a"), ":T", keys, "overwrite")
    graph.write_nodes(frame(100, 300, "b"), ":T", keys, "overwrite")
    found = {row["id"]: row["tag"] for row in graph.read_nodes(":T").collect()}
    assert found == {i: "a" if i < 100 else "b" for i in range(300)}
    assert graph.read_nodes(":T").count() == 300


def test_relationships(spark, tmp_path, folder_bytes, names):
    """The names as keys of both ends and as properties, of which the last by one of them counts."""
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    own = [f"p{n}" for n in range(len(names))]
    frame = lambda low, high, tag: spark.createDataFrame(
        [(i % 7, *row, row[1]) for row in rows(names, low, high, tag) for i in [row[0]]], ["b", "a", *own, "c"]
    )
    ends = NodePattern(":S", {"a": names[0], "c": names[1]}, "overwrite"), NodePattern(":T", {"b": names[0]}, "overwrite")
    for low, high, tag, order in ((0, 200, "a", ["p5"]), (100, 300, "a", ["p4"])):
        graph.write_relationships(
            frame(low, high, tag), "R", *ends, "overwrite", properties=dict(zip(own, names, strict=True)), order_by=order
        )
    read = graph.read_relationships("R").collect()
    assert len(read) == 300
    found = sorted((row[f"source.{names[0]}"], *(row[f"rel.{name}"] for name in names)) for row in read)
    assert found == rows(names, 0, 300, "a")
    assert {(row[f"source.{names[0]}"] % 7, row[f"source.{names[1]}"][:2]) for row in read} == {(k, "a0") for k in range(7)}
    assert all(row[f"target.{names[0]}"] == row[f"source.{names[0]}"] % 7 for row in read)


@pytest.mark.parametrize("name", ["<id>", "<ID>", "<labels>"])
def test_names_of_the_graph_are_refused(spark, tmp_path, name):
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    frame = spark.createDataFrame([(1, 2)], ["id", name])
    with pytest.raises(ValueError, match="rename"):
        graph.write_nodes(frame, ":T", "id", "overwrite")
    with pytest.raises(ValueError, match="rename"):
        graph.write_relationships(frame, "R", NodePattern(":S", {"id": name}), NodePattern(":T", "id"), "overwrite")


def test_first_and_second_writes_stage_relationships_once(spark, tmp_path, monkeypatch):
    """A type that is new is written once; one that is stored takes a staged copy, which is kept as it is."""
    written = []
    plain = GraphWrite._write
    monkeypatch.setattr(GraphWrite, "_write", lambda self, frame, *a: written.append(frame.columns) or plain(self, frame, *a))
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    ends = NodePattern(":S", "a:id", "overwrite"), NodePattern(":T", "b:id", "overwrite")
    edges = lambda: sum("rel.p" in names and "<source.id>" in names for names in written)
    graph.write_relationships(spark.createDataFrame([(1, 2, 3), (4, 5, 6)], ["a", "b", "p"]), "R", *ends, "overwrite")
    assert edges() == 1
    written.clear()
    graph.write_relationships(spark.createDataFrame([(7, 8, 9)], ["a", "b", "p"]), "R", *ends, "overwrite")
    assert edges() == 1  # all rows are new: the staged copy becomes part of the table
    assert graph.read_edges("R").count() == 3
