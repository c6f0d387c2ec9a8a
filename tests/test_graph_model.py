"""Random sequences of writes against a graph held in plain Python."""

import random

import pytest

from sluiceway import NodePattern, PropertyGraph

LABEL_SETS = (("A",), ("B",), ("A", "B"))


class Model:
    def __init__(self):
        self.nodes, self.edges = [], []

    def having(self, labels, key):
        return [n for n in self.nodes if labels <= n["labels"] and n.get("id") == key]

    def add_node(self, labels, row):
        self.nodes.append({"labels": frozenset(labels), **row})

    def merge_node(self, labels, row):
        found = self.having(frozenset(labels), row["id"])
        for node in found:
            node.update(row)
        if not found:
            self.add_node(labels, row)

    def merge_edge(self, source, target, row, identity):
        same = [
            e
            for e in self.edges
            if (e["s"], e["t"]) == (source, target)
            and all(e.get(name) == row[name] for name in identity)
        ]
        for edge in same:
            edge.update(row)
        if not same:
            self.edges.append({"s": source, "t": target, **row})


def unique_rows(chance, columns):
    keys = chance.sample(range(6), chance.randint(1, 4))
    return [{"id": key, **{c: chance.choice([None, 1, 2, 3]) for c in columns}} for key in keys]


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes(spark, tmp_path, seed):
    chance, model = random.Random(seed), Model()
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    for _ in range(7):
        labels = chance.choice(LABEL_SETS)
        columns = chance.choice([[], ["p"], ["q"], ["p", "q"]])
        batch = unique_rows(chance, columns)
        schema = ", ".join(f"{c} int" for c in ["id", *columns])
        frame = spark.createDataFrame([tuple(row.values()) for row in batch], schema)
        append = chance.random() < 0.3
        graph.write_nodes(frame, labels, "id", "append" if append else "overwrite")
        for row in batch:
            (model.add_node if append else model.merge_node)(labels, row)
    for labels in LABEL_SETS:
        expected = [n for n in model.nodes if set(labels) <= n["labels"]]
        if not expected:
            continue
        columns = sorted({name for node in expected for name in node} - {"labels"})
        found = graph.read_nodes(labels).select("<labels>", *columns).collect()
        wanted = [(sorted(n["labels"]), *(n.get(c) for c in columns)) for n in expected]
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))


@pytest.mark.parametrize("seed", [3, 4])
def test_relationships(spark, tmp_path, seed):
    chance, model = random.Random(seed), Model()
    graph = PropertyGraph(spark, str(tmp_path / "g"))
    for _ in range(5):
        dated = chance.random() < 0.5
        append = chance.random() < 0.3
        triples = {
            (chance.randrange(4), chance.randrange(4), chance.randrange(3) if dated else 0)
            for _ in range(5)
        }
        if not dated:
            triples = {(s, t): (s, t, w) for s, t, w in triples}.values()
        batch = [(s, t, d, chance.randrange(9)) for s, t, d in sorted(triples)]
        frame = spark.createDataFrame(batch, "s int, t int, d int, w int")
        modes = [chance.choice(["match", "overwrite"]) for _ in range(2)]
        ends = [NodePattern("A", f"{c}:id", mode) for c, mode in zip("st", modes)]
        properties = {"d": "d", "w": "w"} if dated else {"w": "w"}
        graph.write_relationships(
            frame,
            "R",
            *ends,
            mode="append" if append else "overwrite",
            properties=properties,
            keys="d" if dated else (),
        )
        present = {n["id"] for n in model.nodes}
        kept = [
            row
            for row in batch
            if all(row[i] in present for i in (0, 1) if modes[i] == "match")
        ]
        for row in kept:
            for i in (0, 1):
                if modes[i] == "overwrite":
                    model.merge_node(("A",), {"id": row[i]})
            values = {"d": row[2], "w": row[3]} if dated else {"w": row[3]}
            if append:
                model.edges.append({"s": row[0], "t": row[1], **values})
            else:
                model.merge_edge(row[0], row[1], values, ["d"] if dated else [])
    edges = graph.read_edges("R")
    if "rel.d" not in edges.columns:
        edges = edges.selectExpr("*", "CAST(NULL AS INT) AS `rel.d`")
    found = edges.select("`source.id`", "`target.id`", "`rel.d`", "`rel.w`").collect()
    wanted = [(e["s"], e["t"], e.get("d"), e["w"]) for e in model.edges]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))
    if model.nodes:
        found = sorted(row.id for row in graph.read_nodes("A").select("id").collect())
        assert found == sorted(n["id"] for n in model.nodes)
        assert graph.read_relationships("R").count() == len(model.edges)
