"""Rounds of a grid: no node in two tasks of a round, all rows there, hot nodes spread by their other ends."""

import re

import pytest
from pyspark.sql import functions as F

from sluiceway import JobConfig, NodePattern, Partition, PropertyGraph, Source, Target, run_job
from sluiceway.operators.grid import grid_cell
from sluiceway.sinks.write import SelfOverwrite
from sluiceway.sources.presets import Preset, register_preset
from sluiceway.sinks.rounds import _later_mode


@pytest.fixture
def pairs(spark):
    """A third of all rows start at one node; one end is a NULL."""
    rows = [(1 if n % 3 == 0 else n % 50, n % 41, n) for n in range(1500)] + [(None, 3, -1), (4, None, -2)]
    return spark.createDataFrame(rows, "a long, b int, n long")


def tasks(frame, partition):
    at, task = grid_cell(frame, partition)
    return frame.withColumns({"round": at, "task": task}).collect()


@pytest.mark.parametrize("number", [1, 2, 5, 8])
def test_two_kinds_of_nodes(pairs, number):
    rows = tasks(pairs, Partition(number, grid=("a", "b")))
    for end in ("a", "b"):
        seen = {}
        for row in rows:
            seen.setdefault((row["round"], row[end]), set()).add(row["task"])
        assert all(len(found) == 1 for found in seen.values())
    assert {row["round"] for row in rows} == set(range(number))
    hot = {(row["round"], row["task"]) for row in rows if row["a"] == 1}
    assert len(hot) == number and len({turn for turn, _ in hot}) == number  # one task of every round


@pytest.mark.parametrize("number", [1, 2, 5, 8])
def test_one_kind_of_nodes(pairs, number):
    """A node may start one relationship and end another, in columns of two types."""
    rows = tasks(pairs, Partition(number, grid="a,b", sameNodes=True))
    seen = {}
    for row in rows:
        for node in (row["a"], row["b"]):
            seen.setdefault((row["round"], node), set()).add(row["task"])
    assert all(len(found) == 1 for found in seen.values())
    assert {row["round"] for row in rows} <= set(range(number))


def job(pairs, path, mode="overwrite", **partition):
    source = Source("parquet", {"path": pairs}, partition={"number": 4, "grid": ["a", "b"], **partition})
    return JobConfig(source=source, target=Target("parquet", {"path": path}, mode))


def test_files(spark, pairs, tmp_path):
    """Each round is a write of its own, in the target's mode and then by appending."""
    there, path = str(tmp_path / "in"), str(tmp_path / "out")
    pairs.withColumn("round", F.lit("r")).withColumn("lane", F.lit("l")).write.parquet(there)
    for _ in range(2):
        run_job(spark, job(there, path))
    found = spark.read.parquet(path)
    assert found.columns == ["a", "b", "n", "round", "lane"]
    assert sorted(row["n"] for row in found.collect()) == sorted(row["n"] for row in pairs.collect())
    names = [row[0] for row in found.select("_metadata.file_name").distinct().collect()]
    assert len({re.match(r"part-\d+-([0-9a-f-]{36})", name)[1] for name in names}) == 4 and 4 < len(names) <= 16
    run_job(spark, job(there, path, "append"))
    assert spark.read.parquet(path).count() == 2 * pairs.count()


def test_no_rows_and_modes(spark, pairs, tmp_path):
    there, path = str(tmp_path / "in"), str(tmp_path / "out")
    pairs.where("n > 9999").write.parquet(there)
    run_job(spark, job(there, path))
    assert spark.read.parquet(path).count() == 0
    with pytest.raises(ValueError, match="ignore"):
        run_job(spark, job(there, path, "ignore"))
    with pytest.raises(SelfOverwrite):
        run_job(spark, job(there, there))


def test_graph_target_upserts_in_every_round(spark, pairs, tmp_path):
    graph, there = PropertyGraph(spark, str(tmp_path / "g")), str(tmp_path / "in")
    pairs.dropna().write.parquet(there)
    options = {
        "path": str(tmp_path / "g"), "relationship": "R", "relationship.source.labels": ":S", "relationship.target.labels": ":T",
        "relationship.source.node.keys": "a:id", "relationship.target.node.keys": "b:id",
        "relationship.source.save.mode": "Overwrite", "relationship.target.save.mode": "Overwrite",
    }
    source = Source("parquet", {"path": there}, partition=Partition(2, grid=("a", "b")))
    run_job(spark, JobConfig(source=source, target=Target("graph", options, "Overwrite")))
    found = {(r["source.id"], r["target.id"]): r["rel.n"] for r in graph.read_relationships("R").collect()}
    want = {}
    for row in pairs.dropna().collect():
        want[row["a"], row["b"]] = max(row["n"], want.get((row["a"], row["b"]), -1))
    assert found == want


def test_later_rounds(monkeypatch):
    assert _later_mode(Target("graph", {"path": "/g", "labels": "T"}, "Overwrite")) == "Overwrite"
    assert _later_mode(Target("parquet", {"path": "/p"}, "Overwrite")) == "append"
    register_preset(Preset("OtherGraph", "example.graph.Source", upserts=True))
    assert _later_mode(Target("OtherGraph", {}, "Overwrite")) == "Overwrite"


def test_spec():
    assert Partition.of({"number": "3", "grid": "a, b", "sameNodes": "true"}) == Partition(3, grid=("a", "b"), sameNodes=True)
    for wrong in ({"grid": ["a", "b"]}, {"number": 3, "grid": ["a"]}, {"number": 3, "grid": "a,b", "by": "c"}):
        with pytest.raises(ValueError, match="grid"):
            Partition.of(wrong)
