"""Job descriptions: every field, every form they come in, defaults and bad input."""

import json
from pathlib import Path

import pytest

from sluiceway import Column, JobConfig, Partition, Source, Target
from sluiceway.spec import DEFAULT_JOB_NAME

FULL = """
{
  "name": "boats into a graph",
  "master": "local",
  "_comment": "ignored",
  "conf": {"spark.x": "1"},
  "_comment": "ignored again",
  "hadoopConfiguration": {"fs.y": "2"},
  "source": {
    "format": "warehouse",
    "options": {"url": "u", "_comment": "not an option", "rows": 5, "fast": true},
    "columns": [{"name": "hull * 2", "alias": "double"}, {"name": "title"}],
    "where": "harbour <> 'Cork'",
    "printSchema": true,
    "limit": 7,
    "show": 3,
    "partition": {"number": 12, "by": "harbour"},
    "later": "unknown keys are ignored"
  },
  "target": {"format": "graph", "options": {"labels": ":Boat"}, "mode": "Overwrite"}
}
"""


def minimal(**source):
    return {"source": {"format": "csv", **source}, "target": {"format": "json"}}


def check_full(job):
    assert (job.name, job.master) == ("boats into a graph", "local")
    assert job.conf == {"spark.x": "1"}
    assert job.hadoopConfiguration == {"fs.y": "2"}
    source = job.source
    assert source.format == "warehouse"
    assert source.options == {"url": "u", "rows": "5", "fast": "true"}
    assert source.columns == (Column("hull * 2", "double"), Column("title", ""))
    assert source.where == "harbour <> 'Cork'"
    assert (source.printSchema, source.limit, source.show) == (True, 7, 3)
    assert source.partition == Partition(12, "harbour")
    assert job.target == Target("graph", {"labels": ":Boat"}, "Overwrite")


def test_every_field_from_text():
    check_full(JobConfig.load(FULL))


def test_from_dict_path_text_path_and_url(tmp_path):
    file = tmp_path / "job.json"
    file.write_text(FULL)
    for form in (json.loads(FULL), file, str(file), file.as_uri(), JobConfig.load(FULL)):
        check_full(JobConfig.load(form))


def test_many_jobs(tmp_path):
    file = tmp_path / "jobs.json"
    file.write_text(f"[{FULL}, {FULL}]")
    for form in (f"[{FULL}]", file, [json.loads(FULL), JobConfig.load(FULL)]):
        for job in JobConfig.load_all(form):
            check_full(job)
    assert len(JobConfig.load_all(Path(file))) == 2


def test_defaults():
    job = JobConfig.load(minimal())
    assert job.name == DEFAULT_JOB_NAME
    assert (job.master, job.conf, job.hadoopConfiguration) == ("", {}, {})
    source = job.source
    assert (source.columns, source.where, source.printSchema) == ((), "", False)
    assert (source.limit, source.show, source.partition) == (-1, -1, Partition(0, ""))
    assert job.target.mode == ""


def test_nulls_and_empty_objects_are_defaults():
    job = JobConfig.load(minimal(columns=None, where=None, limit=None, partition={}))
    assert job.source == JobConfig.load(minimal()).source


def test_positional_arguments_as_in_a_notebook():
    job = JobConfig("n", {}, {}, Source("csv"), Target("json", {}, "Append"), "local")
    assert (job.name, job.master, job.target.mode) == ("n", "local", "Append")


def test_column_text():
    assert str(Column("a + 1", "b")) == "a + 1 AS b"
    assert str(Column("a", "  ")) == "a"


@pytest.mark.parametrize("bad", [5, 5.0, None, object()])
def test_other_types_are_rejected(bad):
    with pytest.raises(ValueError):
        JobConfig.load(bad)
    with pytest.raises(ValueError):
        JobConfig.load_all(bad)


def test_one_job_is_no_list_and_a_list_no_job():
    with pytest.raises(ValueError):
        JobConfig.load_all(minimal())
    with pytest.raises(ValueError):
        JobConfig.load([minimal()])


@pytest.mark.parametrize("missing", ["source", "target"])
def test_both_ends_are_needed(missing):
    job = minimal()
    del job[missing]
    with pytest.raises(ValueError, match="source"):
        JobConfig.load(job)


def test_format_is_needed():
    with pytest.raises(ValueError, match="format"):
        JobConfig.load({"source": {"options": {}}, "target": {"format": "json"}})


def test_secrets_are_not_shown():
    source = Source("jdbc", {"password": "hush"})
    job = JobConfig(source=source, target=Target("jdbc", {"password": "hush"}))
    assert "hush" not in repr(job)
