"""Identities that follow from keys, and batches that change most of a table, by one join."""

import pytest

from sluiceway import NodePattern, PropertyGraph
from sluiceway.graph.write import GraphWrite

ENDS = NodePattern(":A", "a:id", "overwrite"), NodePattern(":B", "b:id", "overwrite")


@pytest.fixture
def joined(monkeypatch):
    """The columns of what a write stages, and how many of its plans join."""
    write, seen = GraphWrite._write, []

    def watched(self, frame, *rest):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        seen.append(("<source.id>" in frame.columns, plan.count("Join ")))
        return write(self, frame, *rest)

    monkeypatch.setattr(GraphWrite, "_write", watched)
    return seen


def rows_of(spark, rows, columns="a long, b long, p string"):
    return spark.createDataFrame(rows, columns)


def found(graph, *names):
    rows = graph.read_relationships("R").select("`source.id`", "`target.id`", *(f"`rel.{n}`" for n in names))
    return sorted(tuple(r) for r in rows.collect())


def test_relationships_are_written_once_and_upserted_by_one_join(spark, tmp_path, joined):
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    graph.write_relationships(rows_of(spark, [(1, 2, "x"), (3, 2, "x"), (5, 6, "x")]), "R", *ENDS, "overwrite")
    assert [joins for has_ids, joins in joined if has_ids] == [0]
    joined.clear()
    batch = rows_of(spark, [(1, 2, "y"), (3, 2, None), (7, 8, "z")], "a long, b long, q string")
    graph.write_relationships(batch, "R", *ENDS, "overwrite")
    assert [joins for has_ids, joins in joined if has_ids] == [0, 1]
    assert found(graph, "p", "q") == [(1, 2, "x", "y"), (3, 2, "x", None), (5, 6, "x", None), (7, 8, None, "z")]
    assert sorted(r.id for r in graph.read_nodes(":A").collect()) == [1, 3, 5, 7]
    assert sorted(r.id for r in graph.read_nodes(":B").collect()) == [2, 6, 8]


def test_removing_most_takes_one_join(spark, tmp_path, joined):
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    graph.merge_pattern(rows_of(spark, [(n, n % 3, "x") for n in range(9)]), "R", *ENDS, "p:p")
    joined.clear()
    gone = rows_of(spark, [(n, n % 3, "x") for n in range(6)] + [(99, 1, "x"), (None, 1, "x"), (7, 1, "other")])
    graph.delete_relationships(gone, "R", *ENDS, "p:p")
    assert [joins for _, joins in joined] == [0, 1]
    assert found(graph) == [(6, 0), (7, 1), (8, 2)]
    graph.delete_relationships(rows_of(spark, [(99, 1, "x")]), "R", *ENDS, "p:p")
    assert found(graph) == [(6, 0), (7, 1), (8, 2)]


def test_merging_most_again_takes_one_join(spark, tmp_path, joined):
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    rows = [(n, n % 3, "x") for n in range(9)]
    graph.merge_pattern(rows_of(spark, rows[:6]), "R", *ENDS, "p:p")
    joined.clear()
    graph.merge_pattern(rows_of(spark, rows), "R", *ENDS, "p:p")
    assert [joins for has_ids, joins in joined if has_ids] == [0, 1]
    assert found(graph, "p") == sorted(rows)


def test_other_nodes_end_the_derivation(spark, tmp_path):
    """Nodes that were appended with a key, or whose key was changed, are found by joins again."""
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    one = rows_of(spark, [(1, 2, "x")])
    graph.write_relationships(one, "R", *ENDS, "overwrite")
    assert all(table.derived for table in graph._catalog.load()[1] if table.labels)
    graph.write_nodes(spark.createDataFrame([(1,)], "id long"), ":A", mode="append")
    graph.write_relationships(one, "R", *ENDS, "overwrite")
    assert found(graph, "p") == [(1, 2, "x")] * 2
    graph.write_nodes(spark.createDataFrame([(2, "k")], "id long, code string"), ":B", "id", "overwrite")
    graph.write_nodes(spark.createDataFrame([("k", 4)], "code string, id long"), ":B", "code", "overwrite")
    graph.delete_relationships(rows_of(spark, [(1, 4, "x")]), "R", *ENDS)
    assert graph.read_edges("R").isEmpty()
    same = NodePattern(":N", "a:id", "overwrite"), NodePattern(":N", "b:id", "overwrite")
    graph.write_relationships(rows_of(spark, [(1, 1, "x"), (1, 2, "x"), (2, 1, "x")]), "S", *same, "overwrite")
    assert sorted(r.id for r in graph.read_nodes(":N").collect()) == [1, 2]
    assert graph.read_relationships("S").count() == 3
