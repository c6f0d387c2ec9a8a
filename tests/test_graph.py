"""Nodes and relationships: every save mode, keys, labels, versions and errors."""

import threading

import pytest
from pyspark.sql import Row, functions as F

from sluiceway import NodePattern, PropertyGraph, Source, Target, read, write
from sluiceway.graph import InvalidKeys, mapping, parse_labels
from sluiceway.graph.catalog import VersionTaken
from sluiceway.graph.write import GraphWrite


@pytest.fixture
def graph(spark, tmp_path):
    return PropertyGraph(spark, str(tmp_path / "graph"))


@pytest.fixture
def make(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows(frame, *columns):
    frame = frame.select(*(f"`{c}`" for c in columns)) if columns else frame
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def data_folders(graph):
    from pathlib import Path

    return {path.name for path in Path(graph._root, "data").iterdir()}


def test_label_and_mapping_text():
    assert parse_labels(":Person:Customer") == parse_labels(["Customer", "Person"])
    assert parse_labels(" Person ") == ("Person",)
    assert mapping("a:b, c ,d:e") == {"a": "b", "c": "c", "d": "e"}
    assert mapping(["a", "b:x"]) == {"a": "a", "b": "x"}
    assert mapping(None) == mapping("") == {}


# ---- nodes ---------------------------------------------------------------


def test_append_adds_rows_and_rewrites_nothing(graph, make):
    people = make([(1, "a"), (1, "a")], "id int, name string")
    graph.write_nodes(people, ":Person")
    before = data_folders(graph)
    graph.write_nodes(people, ":Person")
    assert rows(graph.read_nodes("Person"), "id", "name") == [(1, "a")] * 4
    assert len(data_folders(graph) - before) == 1


def test_append_with_other_columns_widens_the_table(graph, make):
    graph.write_nodes(make([(1, "a")], "id int, name string"), ":Person")
    graph.write_nodes(make([(2, 9)], "id int, age int"), ":Person")
    found = graph.read_nodes("Person")
    assert rows(found, "id", "name", "age") == [(1, "a", None), (2, None, 9)]


def test_upsert_sets_batch_columns_nulls_too_and_keeps_others(graph, make):
    first = make([(1, "a", 10), (2, "b", 20)], "id int, name string, age int")
    second = make([(2, None), (3, "c")], "id int, name string")
    graph.write_nodes(first, ":Person", "id", "Overwrite")
    graph.write_nodes(second, ":Person", "id", "Overwrite")
    expected = [(1, "a", 10), (2, None, 20), (3, "c", None)]
    assert rows(graph.read_nodes("Person"), "id", "name", "age") == expected
    graph.write_nodes(second, ":Person", "id", "Overwrite")
    assert rows(graph.read_nodes("Person"), "id", "name", "age") == expected


def test_upsert_of_new_keys_only_rewrites_nothing(graph, make):
    graph.write_nodes(make([(1, "a")], "id int, name string"), ":Person", "id", "overwrite")
    paths = graph._catalog.load()[1][0].paths
    graph.write_nodes(make([(2, "b")], "id int, name string"), ":Person", "id", "overwrite")
    (table,) = graph._catalog.load()[1]
    assert table.paths[:1] == paths and len(table.paths) == 2
    assert table.unique == ("id",)


def test_uniqueness_is_forgotten_when_rows_are_appended(graph, make):
    batch = make([(1, "a")], "id int, name string")
    graph.write_nodes(batch, ":Person", "id", "overwrite")
    graph.write_nodes(batch, ":Person", "id", "append")
    assert graph._catalog.load()[1][0].unique == ()
    graph.write_nodes(make([(1, "z")], "id int, name string"), ":Person", "id", "overwrite")
    assert rows(graph.read_nodes("Person"), "id", "name") == [(1, "z")] * 2


def test_upsert_by_another_column_may_change_the_first_key(graph, make):
    graph.write_nodes(
        make([(1, "a"), (2, "b")], "id int, name string"), ":Person", "id", "overwrite"
    )
    graph.write_nodes(make([(2, "a")], "id int, name string"), ":Person", "name", "overwrite")
    assert rows(graph.read_nodes("Person"), "id", "name") == [(2, "a"), (2, "b")]
    assert graph._catalog.load()[1][0].unique == ()
    graph.write_nodes(make([(2, "c")], "id int, name string"), ":Person", "id", "overwrite")
    assert rows(graph.read_nodes("Person"), "id", "name") == [(2, "c")] * 2


def test_several_rows_with_one_key(graph, make):
    batch = make([(1, "a", 3), (1, "c", 1), (1, "b", 2)], "id int, name string, day int")
    graph.write_nodes(batch, ":Largest", "id", "overwrite")
    assert rows(graph.read_nodes("Largest"), "name") == [("c",)]
    graph.write_nodes(batch, ":Last", "id", "overwrite", order_by=["day"])
    assert rows(graph.read_nodes("Last"), "name") == [("a",)]


def test_composite_and_renamed_keys(graph, make):
    for name in ("a", "b"):
        batch = make([(1, 1, name), (1, 2, name)], "x int, y int, name string")
        graph.write_nodes(batch, ":P", "x:left,y:right", "overwrite")
    expected = [(1, 1, "b"), (1, 2, "b")]
    assert rows(graph.read_nodes("P"), "left", "right", "name") == expected


def test_labels_select_sets_that_hold_them(graph, make):
    graph.write_nodes(make([(1,)], "id int"), ":Person:Customer")
    graph.write_nodes(make([(2,)], "id int"), ":Person")
    graph.write_nodes(make([("x",)], "id string"), ":Order")
    assert rows(graph.read_nodes(":Person"), "id") == [(1,), (2,)]
    assert rows(graph.read_nodes(":Customer"), "<labels>", "id") == [(["Customer", "Person"], 1)]
    with pytest.raises(ValueError, match="no nodes"):
        graph.read_nodes(":Customer:Order")


def test_upsert_finds_nodes_with_more_labels(graph, make):
    schema = "id int, name string"
    graph.write_nodes(make([(1, "a")], schema), ":Person:Customer", "id", "overwrite")
    graph.write_nodes(make([(1, "A"), (2, "B")], schema), ":Customer", "id", "overwrite")
    assert rows(graph.read_nodes("Customer"), "<labels>", "id", "name") == [
        (["Customer", "Person"], 1, "A"),
        (["Customer"], 2, "B"),
    ]


def test_modes_for_nodes_that_exist(graph, make):
    graph.write_nodes(make([(1,)], "id int"), ":P", mode="error")
    graph.write_nodes(make([(2,)], "id int"), ":P", mode="Ignore")
    assert rows(graph.read_nodes("P"), "id") == [(1,)]
    for mode in ("", "ErrorIfExists", "default"):
        with pytest.raises(ValueError, match="exist already"):
            graph.write_nodes(make([(2,)], "id int"), ":P", mode=mode)
    with pytest.raises(ValueError, match="unknown save mode"):
        graph.write_nodes(make([(2,)], "id int"), ":P", mode="upsert")


def test_overwrite_needs_keys_and_nodes_need_labels(graph, make):
    with pytest.raises(ValueError, match="node keys"):
        graph.write_nodes(make([(1,)], "id int"), ":P", mode="overwrite")
    with pytest.raises(ValueError, match="label"):
        graph.write_nodes(make([(1,)], "id int"), ":")


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_null_keys_are_counted_and_nothing_is_written(graph, make, mode):
    graph.write_nodes(make([(1, "a")], "id int, name string"), ":P", "id", "overwrite")
    bad = make([(None, "x"), (None, "y"), (None, "y"), (2, "z")], "id int, name string")
    with pytest.raises(InvalidKeys, match="^3 rows"):
        graph.write_nodes(bad, ":P", "id", mode)
    assert rows(graph.read_nodes("P"), "id") == [(1,)]


def test_keys_take_the_stored_type(graph, make):
    graph.write_nodes(make([(1, "a")], "id long, name string"), ":P", "id", "overwrite")
    for value, kind in ((1.0, "double"), ("1", "string"), (1, "int")):
        graph.write_nodes(make([(value, kind)], f"id {kind}, name string"), ":P", "id", "overwrite")
        assert rows(graph.read_nodes("P"), "id", "name") == [(1, kind)]


@pytest.mark.parametrize(
    ("value", "kind"), [(1.5, "double"), ("x", "string"), ("01", "string"), (float("nan"), "double")]
)
def test_keys_that_do_not_fit_are_rejected(graph, make, value, kind):
    graph.write_nodes(make([(1,)], "id long"), ":P", "id", "overwrite")
    with pytest.raises(InvalidKeys, match="^1 rows"):
        graph.write_nodes(make([(value,)], f"id {kind}"), ":P", "id", "overwrite")


def test_other_columns_may_not_change_type_or_spelling(graph, make):
    graph.write_nodes(make([(1, "a")], "id int, name string"), ":P", "id", "overwrite")
    with pytest.raises(ValueError, match="stored as string"):
        graph.write_nodes(make([(1, 5)], "id int, name int"), ":P", "id", "overwrite")
    with pytest.raises(ValueError, match="stored as 'name'"):
        graph.write_nodes(make([(1, "b")], "id int, NAME string"), ":P", "id", "append")
    assert rows(graph.read_nodes("P"), "id", "name") == [(1, "a")]


def test_empty_batches(graph, make):
    empty = make([], "id int, name string")
    graph.write_nodes(empty, ":P", "id", "overwrite")
    assert graph.read_nodes("P").count() == 0
    graph.write_nodes(make([(1, "a")], "id int, name string"), ":P", "id", "overwrite")
    graph.write_nodes(empty, ":P", "id", "overwrite")
    assert rows(graph.read_nodes("P"), "id") == [(1,)]


def test_nested_and_map_columns(graph, spark):
    frame = spark.sql("SELECT 1 AS id, array(1, 2) AS a, struct(3 AS x) AS s, map('k', 4) AS m")
    graph.write_nodes(frame, ":P", "id", "overwrite", order_by=["a"])
    row = graph.read_nodes("P").first()
    assert (row.a, row.s, row.m) == ([1, 2], Row(x=3), {"k": 4})


# ---- relationships ---------------------------------------------------------

BOTH = (NodePattern(":C", "c:id", "overwrite"), NodePattern(":O", "o:id", "overwrite"))
MATCH = (NodePattern(":C", "c:id"), NodePattern(":O", "o:id"))


def edges(graph, *properties):
    return rows(graph.read_edges("R"), "source.id", "target.id", *properties)


def test_overwrite_makes_both_ends_and_one_edge_per_pair(graph, make):
    frame = make([(1, 10, "x"), (1, 10, "y"), (1, 11, "z"), (2, 10, "w")], "c int, o int, p string")
    graph.write_relationships(frame, "R", *BOTH, mode="overwrite")
    expected = [(1, 10, "y"), (1, 11, "z"), (2, 10, "w")]
    assert edges(graph, "rel.p") == expected
    assert rows(graph.read_nodes("C"), "id") == [(1,), (2,)]
    assert rows(graph.read_nodes("O"), "id") == [(10,), (11,)]
    graph.write_relationships(frame, "R", *BOTH, mode="overwrite")
    assert edges(graph, "rel.p") == expected
    assert graph.read_nodes("C").count() == 2


def test_append_adds_every_row(graph, make):
    frame = make([(1, 10, "x"), (1, 10, "x")], "c int, o int, p string")
    for _ in range(2):
        graph.write_relationships(frame, "R", *BOTH, mode="append")
    assert edges(graph, "rel.p") == [(1, 10, "x")] * 4
    assert graph.read_nodes("C").count() == 1


def test_appended_ends_are_added_once_per_key(graph, make):
    ends = (NodePattern(":C", "c:id", "append"), NodePattern(":O", "o:id", "append"))
    frame = make([(1, 10), (1, 11)], "c int, o int")
    for _ in range(2):
        graph.write_relationships(frame, "R", *ends, mode="append")
    assert rows(graph.read_nodes("C"), "id") == [(1,), (1,)]
    assert graph.read_nodes("O").count() == 4


def test_match_keeps_rows_whose_nodes_exist(graph, make):
    graph.write_nodes(make([(1,), (2,)], "id long"), ":C:VIP", "id", "overwrite")
    graph.write_nodes(make([(10,)], "id long"), ":O", "id", "overwrite")
    frame = make([(1.0, 10), (2.0, 11), (3.0, 10)], "c double, o int")
    graph.write_relationships(frame, "R", *MATCH, mode="overwrite")
    assert edges(graph) == [(1, 10)]
    assert graph.read_nodes("C").count() == 2 and graph.read_nodes("O").count() == 1


def test_match_with_no_nodes_at_all_writes_no_edge(graph, make):
    graph.write_nodes(make([(1,)], "id int"), ":C", "id", "overwrite")
    source, target = MATCH[0], BOTH[1]
    graph.write_relationships(make([(5, 10)], "c int, o int"), "R", source, target)
    assert edges(graph) == []
    assert graph.read_nodes("O").count() == 0
    graph.write_relationships(make([(1, 10)], "c int, o int"), "R", *MATCH)
    assert edges(graph) == []


def test_upsert_of_edges_keeps_other_properties(graph, make):
    graph.write_relationships(make([(1, 10, "x")], "c int, o int, p string"), "R", *BOTH,
                              mode="overwrite")
    graph.write_relationships(make([(1, 10, 5), (2, 10, 6)], "c int, o int, q int"), "R", *BOTH,
                              mode="overwrite")
    assert edges(graph, "rel.p", "rel.q") == [(1, 10, "x", 5), (2, 10, None, 6)]


def test_last_edge_by_order_wins_and_order_is_no_property(graph, make):
    frame = make([(1, 10, "x", 2), (1, 10, "y", 1)], "c int, o int, p string, day int")
    graph.write_relationships(
        frame, "R", *BOTH, mode="overwrite", properties="p:kind", order_by=["day"]
    )
    assert edges(graph, "rel.kind") == [(1, 10, "x")]
    assert graph.read_edges("R").columns == ["source.id", "target.id", "rel.kind", "<rel.type>"]


def test_identity_with_and_without_a_property(graph, make):
    frame = make([(1, 10, "mon"), (1, 10, "tue"), (1, 10, "tue")], "c int, o int, d string")
    graph.merge_pattern(frame, "R", *MATCH, keys="d:day")
    assert edges(graph, "rel.day") == [(1, 10, "mon"), (1, 10, "tue")]
    graph.merge_pattern(frame, "R", *MATCH, keys="d:day")
    assert edges(graph, "rel.day") == [(1, 10, "mon"), (1, 10, "tue")]
    graph.write_relationships(
        make([(1, 10, "x")], "c int, o int, p string"), "R", *BOTH, mode="overwrite"
    )
    assert edges(graph, "rel.day", "rel.p") == [(1, 10, "mon", "x"), (1, 10, "tue", "x")]


def test_ends_with_the_same_label_and_different_key_types(graph, make):
    ends = (NodePattern(":C", "a:id", "overwrite"), NodePattern(":C", "b:id", "overwrite"))
    graph.write_relationships(make([(1, 2), (2, 1)], "a int, b long"), "R", *ends, mode="overwrite")
    assert rows(graph.read_nodes("C"), "id") == [(1,), (2,)]
    assert graph.read_relationships("R").count() == 2


@pytest.mark.parametrize("bad", [(None, 10, "d"), (1, None, "d"), (1, 10, None)])
def test_null_edge_keys_are_rejected(graph, make, bad):
    frame = make([bad, (1, 10, "d")], "c int, o int, d string")
    with pytest.raises(InvalidKeys, match="^1 rows"):
        graph.merge_pattern(frame, "R", *MATCH, keys="d")
    with pytest.raises(ValueError, match="no relationships"):
        graph.read_edges("R")


def test_modes_for_edges_that_exist(graph, make):
    frame = make([(1, 10)], "c int, o int")
    graph.write_relationships(frame, "R", *BOTH, mode="")
    graph.write_relationships(frame, "R", *BOTH, mode="ignore")
    assert edges(graph) == [(1, 10)]
    with pytest.raises(ValueError, match="exist already"):
        graph.write_relationships(frame, "R", *BOTH, mode="error")


def test_patterns_are_checked():
    with pytest.raises(ValueError, match="labels and node keys"):
        NodePattern("", "id")
    with pytest.raises(ValueError, match="labels and node keys"):
        NodePattern(":C", "")
    with pytest.raises(ValueError, match="save mode"):
        NodePattern(":C", "id", "upsert")


def test_read_relationships_joins_both_ends(graph, make):
    graph.write_nodes(make([(1, "a"), (2, "b")], "id int, name string"), ":C:VIP", "id", "overwrite")
    graph.write_nodes(make([(3, "c")], "id int, name string"), ":C", "id", "overwrite")
    frame = make([(1, 10, 5), (3, 11, 6)], "c int, o int, n int")
    graph.write_relationships(frame, "R", *BOTH, mode="overwrite")
    found = graph.read_relationships("R")
    assert found.columns == [
        "<rel.type>", "<source.labels>", "source.id", "source.name",
        "<target.labels>", "target.id", "rel.n",
    ]
    columns = ("source.id", "source.name", "target.id", "rel.n")
    assert rows(found, *columns) == [(1, "a", 10, 5), (3, "c", 11, 6)]
    vip = graph.read_relationships("R", source_labels=":VIP")
    assert rows(vip, *columns) == [(1, "a", 10, 5)]


def test_joins_read_and_filter_at_the_scan(graph, make, capsys):
    graph.write_nodes(make([(1, "a")], "id int, name string"), ":C", "id", "overwrite")
    graph.write_relationships(make([(1, 10, 5)], "c int, o int, n int"), "R", *BOTH,
                              mode="overwrite")
    capsys.readouterr()
    graph.read_relationships("R").where("`rel.n` > 3").select("`target.id`").explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThan(`rel.n`,3)" in text
    assert "name" not in text


def test_sql_over_labels_and_types(graph, make):
    graph.write_nodes(make([(1, "a"), (2, "b")], "id int, name string"), ":C", "id", "overwrite")
    graph.write_relationships(make([(1, 10), (1, 11)], "c int, o int"), "R", *BOTH,
                              mode="overwrite")
    sql = "SELECT name, count(*) AS n FROM {C} JOIN {R} r ON r.`source.id` = id GROUP BY name"
    assert rows(graph.query(sql)) == [("a", 2)]
    with pytest.raises(ValueError, match="Nothing"):
        graph.query("SELECT * FROM {Nothing}")


# ---- versions and options ----------------------------------------------------


def test_a_frame_read_before_a_write_still_reads(graph, make):
    schema = "id int, name string"
    graph.write_nodes(make([(1, "a")], schema), ":P", "id", "overwrite")
    before = graph.read_nodes("P")
    graph.write_nodes(before.selectExpr("id", "upper(name) AS name"), ":P", "id", "overwrite")
    assert rows(before, "name") == [("a",)]
    assert rows(graph.read_nodes("P"), "name") == [("A",)]


def test_of_two_writers_from_one_version_the_later_fails(graph, make, monkeypatch):
    graph.write_nodes(make([(1,)], "id int"), ":P")
    version, tables = graph._catalog.load()
    graph._catalog.publish(version + 1, tables)
    with pytest.raises(VersionTaken, match="version 2"):
        graph._catalog.publish(version + 1, tables)


def test_versions_are_ordered_as_numbers(graph, make):
    graph.write_nodes(make([(1,)], "id int"), ":P")
    tables = graph._catalog.load()[1]
    for version in range(2, 12):
        graph._catalog.publish(version, tables)
    assert graph._catalog.load()[0] == 11


def test_options_for_writing_and_reading(spark, tmp_path, make):
    path = {"path": str(tmp_path / "g")}
    frame = make([(1, 10, "d", "x")], "c int, o int, d string, p string")
    target = {
        **path,
        "relationship": "R",
        "relationship.save.strategy": "keys",
        "relationship.source.labels": ":C",
        "relationship.source.node.keys": "c:id",
        "relationship.source.save.mode": "Overwrite",
        "relationship.target.labels": ":O",
        "relationship.target.node.keys": "o:id",
        "relationship.target.save.mode": "Append",
        "relationship.properties": "p",
        "relationship.keys": "d:day",
    }
    write(frame, Target("graph", target, "Overwrite"))
    found = read(spark, Source("Graph", {**path, "relationship": "R"}))
    assert rows(found, "source.id", "rel.p", "rel.day") == [(1, "x", "d")]
    counted = read(spark, Source("graph", {**path, "query": "SELECT count(*) AS n FROM {C}"}))
    assert counted.first()["n"] == 1
    wanted = {**path, "relationship": "R", "relationship.source.labels": ":None"}
    with pytest.raises(ValueError, match="no nodes"):
        read(spark, Source("graph", wanted))


@pytest.mark.parametrize(
    ("options", "message"),
    [
        ({"query": "some graph query"}, "cannot be written"),
        ({"relationship": "R", "relationship.save.strategy": "native"}, "native"),
        ({"relationship": "R"}, "labels and node keys"),
    ],
)
def test_options_that_cannot_be_written(make, tmp_path, options, message):
    with pytest.raises(ValueError, match=message):
        write(make([(1,)], "id int"), Target("graph", {"path": str(tmp_path), **options}, "append"))


def test_hot_node_and_large_sides(spark, graph):
    """A third of the relationships start at one node; no side is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.range(0, 3000, 1, 6).selectExpr("IF(id % 3 = 0, -1, id) AS c", "id AS o")
        for _ in range(2):
            graph.write_relationships(frame, "R", *BOTH, mode="overwrite")
        found = graph.read_relationships("R")
        assert found.count() == 3000
        assert found.where("`source.id` = -1").count() == 1000
        assert graph.read_nodes("C").count() == 2001
        assert graph.read_nodes("C").agg(F.count_distinct("id")).first()[0] == 2001
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_over_several_tables_that_all_hold_the_keys(graph, make):
    schema = "id int, name string"
    for labels in (":A:B", ":A:C"):
        graph.write_nodes(make([(1, "x"), (2, "y")], schema), labels, "id", "overwrite")
    graph.write_nodes(make([(1, "X"), (2, "Y")], schema), ":A", "id", "overwrite")
    assert rows(graph.read_nodes("B"), "id", "name") == [(1, "X"), (2, "Y")]
    assert rows(graph.read_nodes("C"), "id", "name") == [(1, "X"), (2, "Y")]
    assert graph.read_nodes("A").count() == 4
    graph.write_nodes(make([(1, "Z"), (3, "W")], schema), ":A", "id", "overwrite")
    assert rows(graph.read_nodes("A"), "id", "name") == [
        (1, "Z"), (1, "Z"), (2, "Y"), (2, "Y"), (3, "W"),
    ]


def test_names_are_found_in_any_case_and_missing_ones_named(graph, make):
    frame = make([(1, 10, 5)], "C int, O int, N int")
    graph.write_relationships(frame, "R", *BOTH, mode="overwrite", properties="n", order_by=["n"])
    assert edges(graph, "rel.N") == [(1, 10, 5)]
    graph.write_nodes(make([(7,)], "ID int"), ":P", "id", "overwrite", order_by=["Id"])
    assert graph.read_nodes("P").columns == ["ID", "<labels>"]
    with pytest.raises(ValueError, match="no column name"):
        graph.write_nodes(make([(7,)], "id int"), ":P", "name", "overwrite")


def test_only_folders_with_hits_are_rewritten(graph, make):
    schema = "id int, name string"
    for n in range(3):
        graph.write_nodes(make([(n, "a"), (n + 10, "a")], schema), ":P", "id", "overwrite")
    before = set(graph.folders())
    assert len(before) == 3
    graph.write_nodes(make([(11, "b")], schema), ":P", "id", "overwrite")
    after = set(graph.folders())
    assert len(after) == 3 and len(before & after) == 2
    names = [(n + k, "b" if n + k == 11 else "a") for n in range(3) for k in (0, 10)]
    assert rows(graph.read_nodes("P"), "id", "name") == sorted(names, key=repr)


def test_large_tables_are_kept_in_buckets(graph, make, monkeypatch):
    monkeypatch.setattr(GraphWrite, "folder_bytes", 1000)
    frame = graph._spark.range(300).selectExpr("id", "'a' AS name")
    graph.write_nodes(frame, ":P", "id", "overwrite")
    before = set(graph.folders())
    assert len(before) > 2 and all("bucket=" in path for path in before)
    graph.write_nodes(make([(7, "b")], "id long, name string"), ":P", "id", "overwrite")
    after = set(graph.folders())
    assert len(before - after) == 1
    found = rows(graph.read_nodes("P"), "id", "name")
    assert found == sorted([(n, "b" if n == 7 else "a") for n in range(300)], key=repr)


def test_staged_folders_go_and_old_versions_can(graph, make):
    schema = "id int, name string"
    for name in "abc":
        graph.write_nodes(make([(1, name)], schema), ":P", "id", "overwrite")
    assert len(data_folders(graph)) == 3  # one for each version, nothing staged
    assert graph.clean() == []  # too young
    assert len(graph.clean(older_than_hours=0)) == 2
    assert len(data_folders(graph)) == 1 and graph._catalog.versions() == [3]
    assert rows(graph.read_nodes("P"), "id", "name") == [(1, "c")]
    graph.write_nodes(make([(2, "d")], schema), ":P", "id", "overwrite")
    assert graph._catalog.load()[0] == 4


def test_a_failed_write_leaves_nothing(graph, make):
    graph.write_nodes(make([(1,)], "id int"), ":P", "id", "overwrite")
    before = data_folders(graph)
    with pytest.raises(InvalidKeys):
        graph.write_nodes(make([(None,)], "id int"), ":P", "id", "overwrite")
    assert data_folders(graph) == before


def test_compaction_joins_folders(graph, make):
    for n in range(4):
        graph.write_nodes(make([(n,)], "id int"), ":P")
    graph.compact()
    assert len(graph.folders()) == 1
    assert rows(graph.read_nodes("P"), "id") == [(n,) for n in range(4)]


def test_many_writers_of_one_version(graph, make):
    """Every version is published by one writer, and the pointer is only a hint."""
    graph.write_nodes(make([(1,)], "id int"), ":P")
    for _ in range(20):
        version, tables = graph._catalog.load()
        start, results = threading.Barrier(6), []

        def publish(start=start, results=results, version=version, tables=tables):
            start.wait()
            try:
                graph._catalog.publish(version + 1, tables)
                results.append(True)
            except VersionTaken:
                results.append(False)

        threads = [threading.Thread(target=publish) for _ in range(6)]
        for thread in threads:
            thread.start()
        for thread in threads:
            thread.join()
        assert sorted(results) == [False] * 5 + [True]
        assert graph._catalog.newest() == version + 1
    graph._catalog.storage.write(graph._catalog._hint(), "3")
    assert graph._catalog.newest() == version + 1
    graph._catalog.storage.remove(graph._catalog._hint())
    assert graph._catalog.newest() == version + 1


def test_appended_ends_are_not_multiplied(graph, make):
    ends = [NodePattern(":C", "c:id", "append"), NodePattern(":O", "o:id", "append")]
    for _ in range(2):
        graph.write_relationships(make([(1, 10)], "c int, o int"), "R", *ends)
    assert graph.read_nodes("C").count() == 2
    assert graph.read_relationships("R").count() == 2


def test_label_filter_over_two_kinds_of_ends(graph, make):
    thing = NodePattern(":T", "t:id", "overwrite")
    for labels in (":Customer", ":Supplier"):
        graph.write_relationships(
            make([(1, labels[1:])], "c int, t string"), "OWNS", NodePattern(labels, "c:id", "overwrite"), thing, "overwrite"
        )
    found = graph.read_relationships("OWNS", ":Customer")
    assert rows(found, "source.id", "target.id") == [(1, "Customer")]
    assert graph.read_relationships("OWNS").count() == 2


def test_one_edge_whatever_label_names_its_end(graph, make):
    graph.write_nodes(make([(1,)], "id int"), ":Person:Customer", "id", "overwrite")
    thing = NodePattern(":T", "t:id", "overwrite")
    for labels in (":Customer", ":Person"):
        graph.write_relationships(
            make([(1, 5, labels)], "c int, t int, by string"), "OWNS", NodePattern(labels, "c:id"), thing, "overwrite"
        )
    assert rows(graph.read_relationships("OWNS"), "source.id", "target.id", "rel.by") == [(1, 5, ":Person")]


def test_nodes_that_are_both_ends(graph, make):
    end = lambda column: NodePattern(":P", f"{column}:id", "overwrite")
    frame = make([(1, 2), (2, 3), (3, 1)], "a int, b int")
    graph.write_relationships(frame, "KNOWS", end("a"), end("b"), "overwrite")
    assert rows(graph.read_nodes("P"), "id") == [(1,), (2,), (3,)]
    assert rows(graph.read_relationships("KNOWS"), "source.id", "target.id") == [(1, 2), (2, 3), (3, 1)]


def test_label_sets_that_store_a_property_in_other_types(graph, make):
    graph.write_nodes(make([(1, 5, 7)], "id int, code int, n int"), ":P:A", "id", "overwrite")
    graph.write_nodes(make([("x", "y", 8)], "id string, code string, n long"), ":P:B", "id",
                      "overwrite")
    assert rows(graph.read_nodes("P"), "id", "code", "n") == [("1", "5", 7), ("x", "y", 8)]
    assert rows(graph.read_nodes("A"), "id", "code") == [(1, 5)]


def test_relationships_after_a_label_set_with_another_key_type(graph, make):
    graph.write_relationships(make([(1, 10)], "c int, o int"), "R", *BOTH, mode="overwrite")
    graph.write_nodes(make([("x",), ("1",)], "id string"), ":C:VIP", "id", "overwrite")
    found = rows(graph.read_relationships("R"), "<source.labels>", "source.id", "target.id")
    # the relationship was made with the first node, whatever keys others get
    assert found == [(["C"], 1, 10)]
    with pytest.raises(ValueError, match="several types"):
        graph.write_relationships(make([(1, 11)], "c int, o int"), "R", *BOTH, mode="overwrite")
