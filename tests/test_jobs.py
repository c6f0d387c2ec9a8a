"""Whole jobs: from specification to stored rows, alone and in sequence."""

import json
import logging
import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest
from pyspark.errors import AnalysisException

from sluiceway import JobConfig, PropertyGraph, Source, Target, run_job, run_jobs, session_for
from sluiceway.__main__ import main
from sluiceway.plans import jobs as jobs_module


def copy(source, target, **more):
    return {
        "source": {"format": "parquet", "options": {"path": str(source)}, **more.pop("steps", {})},
        "target": {"format": "parquet", "options": {"path": str(target)}, **more.pop("to", {})},
        **more,
    }


@pytest.fixture
def numbers(spark, tmp_path):
    path = tmp_path / "numbers"
    spark.range(20).write.parquet(str(path))
    return path


def test_boats_of_a_harbour_into_a_graph(spark, tmp_path, boats_csv):
    """The filter is on a column that is not kept."""
    path = str(tmp_path / "g")
    job = {
        "source": {
            "format": "csv",
            "options": {"header": "true", "path": boats_csv},
            "columns": [{"name": "CAST(hull AS INT)", "alias": "number"}, "title"],
            "where": "harbour <> 'Cork'",
        },
        "target": {"format": "graph", "options": {"labels": ":Boat:Sail", "path": path, "node.keys": "number"}, "mode": "overwrite"},
    }
    run_job(spark, json.dumps(job))
    nodes = PropertyGraph(spark, path).read_nodes(":Sail")
    assert sorted(row.number for row in nodes.collect()) == [17, 23]


def test_a_job_with_every_step(spark, tmp_path, boats_csv, capsys):
    target = tmp_path / "out"
    steps = {"limit": 2, "show": 1, "printSchema": True, "partition": {"number": 3}}
    source = Source("csv", {"header": "true", "path": boats_csv}, ["title", "harbour"], **steps)
    run_job(spark, JobConfig("boats", {}, {}, source, Target("json", {"path": str(target)}), master="local"))
    found = spark.read.json(str(target))
    assert found.count() == 2 and set(found.columns) == {"title", "harbour"}
    assert "title: string" in capsys.readouterr().out


def test_sequence_each_reading_the_last(spark, tmp_path, numbers):
    first, second = tmp_path / "1", tmp_path / "2"
    run_jobs(
        spark,
        [
            copy(numbers, first, steps={"where": "id >= 5"}),
            copy(first, second, steps={"where": "id < 8"}),
        ],
    )
    assert sorted(row.id for row in spark.read.parquet(str(second)).collect()) == [5, 6, 7]


def test_sequence_stops_at_the_first_failure(spark, tmp_path, numbers):
    first, third = tmp_path / "1", tmp_path / "3"
    with pytest.raises(AnalysisException):
        run_jobs(
            spark,
            [
                copy(numbers, first),
                copy(tmp_path / "missing", tmp_path / "2"),
                copy(numbers, third),
            ],
        )
    assert first.exists() and not third.exists()


def test_empty_sequence(spark):
    run_jobs(spark, [])


def test_missing_mode_is_error_if_exists(spark, tmp_path, numbers):
    run_job(spark, copy(numbers, tmp_path / "t"))
    with pytest.raises(AnalysisException):
        run_job(spark, copy(numbers, tmp_path / "t"))


def test_settings_are_ignored_on_a_given_session(spark, tmp_path, numbers, caplog):
    job = copy(numbers, tmp_path / "t", conf={"spark.sql.shuffle.partitions": "77"})
    with caplog.at_level(logging.WARNING):
        run_job(spark, job)
    assert "ignored" in caplog.text
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


class Fake:
    def __init__(self, job):
        self.job, self.stopped = job, False

    def stop(self):
        self.stopped = True


@pytest.mark.parametrize("active", [False, True])
def test_jobs_share_a_session_while_their_settings_are_the_same(monkeypatch, active):
    sessions, runs = [], []

    def start(job):
        sessions.append(Fake(job))
        return sessions[-1]

    def move(session, job, strict):
        assert not session.stopped
        runs.append((job.name, sessions.index(session)))

    def running():
        return active or any(not session.stopped for session in sessions) or None

    monkeypatch.setattr(jobs_module, "session_for", start)
    monkeypatch.setattr(jobs_module, "_move", move)
    monkeypatch.setattr(jobs_module.SparkSession, "getActiveSession", running)
    quiet = {"hadoopConfiguration": {"a": "b"}}
    jobs = [
        copy("s", "t", name="1", **quiet),
        copy("s", "t", name="2", **quiet),
        copy("s", "t", name="3"),
        copy("s", "t", name="4", conf={"c": "d"}),
    ]
    run_jobs(None, jobs)
    assert runs == [("1", 0), ("2", 0), ("3", 1), ("4", 2)]
    assert [s.stopped for s in sessions] == ([False] * 3 if active else [True, True, False])


def test_settings_reach_their_own_job_only(numbers, tmp_path):
    """Submitted as a job of its own, as there is a session here already."""
    quiet = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    conf = {"spark.ui.enabled": "false"}
    jobs = tmp_path / "jobs.json"
    jobs.write_text(
        json.dumps(
            [
                copy(numbers, tmp_path / "1", master="local", conf=conf, hadoopConfiguration=quiet),
                copy(numbers, tmp_path / "2", master="local", conf=conf),
            ]
        )
    )
    repository = Path(__file__).resolve().parent.parent
    submit = Path(pyspark.__file__).parent / "bin" / "spark-submit"
    command = [submit, repository / "sluiceway" / "__main__.py", "-p", jobs, "-ft", "ARRAY"]
    paths = os.pathsep.join([str(repository), *sys.path])
    environment = {**os.environ, "PYTHONPATH": paths, "PYSPARK_PYTHON": sys.executable}
    subprocess.run(command, env=environment, check=True, timeout=300, capture_output=True)
    assert (tmp_path / "1").exists() and not (tmp_path / "1" / "_SUCCESS").exists()
    assert (tmp_path / "2" / "_SUCCESS").exists()


def test_session_from_a_job(spark, numbers, tmp_path):
    job = JobConfig.load(
        copy(numbers, tmp_path / "t", conf={"sluiceway.test": "x"}, hadoopConfiguration={"a": "b"})
    )
    session = session_for(job)
    assert session.conf.get("sluiceway.test") == "x"
    assert session.conf.get("spark.hadoop.a") == "b"


@pytest.mark.parametrize("fails", [False, True])
def test_session_is_closed_in_the_end(monkeypatch, numbers, tmp_path, fails):
    def move(spark, job, strict):
        if fails:
            raise RuntimeError("no")

    monkeypatch.setattr(jobs_module, "_move", move)
    for run, given in ((run_job, copy("a", "b")), (run_jobs, [copy("a", "b")])):
        session = Fake(None)
        if fails:
            with pytest.raises(RuntimeError):
                run(session, given, close_session=True)
        else:
            run(session, given, close_session=True)
        assert session.stopped


def test_command_line(monkeypatch, tmp_path):
    calls = []
    monkeypatch.setattr("sluiceway.__main__.run_job", lambda *a, **k: calls.append(("one", a, k)))
    monkeypatch.setattr("sluiceway.__main__.run_jobs", lambda *a, **k: calls.append(("all", a, k)))
    main(["-p", "job.json"])
    main(["-p", "jobs.json", "-ft", "array"])
    closing = {"close_session": True}
    assert calls == [("one", (None, "job.json"), closing), ("all", (None, "jobs.json"), closing)]


def test_command_line_stub(tmp_path):
    path = tmp_path / "stub.json"
    main(["-c", "-s", "snowflake", "-t", "Graph", "-p", str(path)])
    assert JobConfig.load(path).target.format == "graph"
    with pytest.raises(SystemExit):
        main(["-c", "-s", "snowflake", "-p", str(path)])
