"""Writing files, save modes and the guard against deleting one's own input."""

import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from sluiceway import JobConfig, PropertyGraph, Source, Target, run_job, write
from sluiceway.sinks import SelfOverwrite
from sluiceway.sinks.write import refuse_self_overwrite


def job(source, target):
    return JobConfig(source=source, target=target)


def test_graph_to_csv_text(spark, tmp_path):
    boats = spark.createDataFrame([("Tern", 23)], "title string, hull int")
    graph, csv = str(tmp_path / "g"), tmp_path / "csv"
    PropertyGraph(spark, graph).write_nodes(boats, ":Boat")
    source = Source("graph", {"path": graph, "labels": ":Boat"}, ["hull", "upper(title) AS t"])
    run_job(spark, job(source, Target("csv", {"sep": ";", "path": str(csv)})))
    assert "".join(file.read_text() for file in csv.glob("*.csv")) == "23;TERN\n"


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_formats(spark, tmp_path, format):
    path = {"path": str(tmp_path / "t"), "header": "true"}
    write(spark.range(5).selectExpr("CAST(id AS STRING) AS id"), Target(format, path))
    assert spark.read.format(format).options(**path).load().count() == 5


@pytest.mark.parametrize(
    ("mode", "rows"),
    [("append", 8), ("Append", 8), ("OVERWRITE", 3), ("ignore", 5)],
)
def test_save_modes(spark, tmp_path, mode, rows):
    path = {"path": str(tmp_path / "t")}
    write(spark.range(5), Target("parquet", path))
    write(spark.range(3), Target("parquet", path, mode))
    assert spark.read.parquet(path["path"]).count() == rows


@pytest.mark.parametrize("mode", ["", "  ", "error", "ErrorIfExists", "default"])
def test_existing_data_is_an_error_by_default(spark, tmp_path, mode):
    path = {"path": str(tmp_path / "t")}
    write(spark.range(5), Target("parquet", path))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write(spark.range(3), Target("parquet", path, mode))


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(Exception, match="INVALID_SAVE_MODE"):
        write(spark.range(1), Target("parquet", {"path": str(tmp_path / "t")}, "upsert"))


def test_placeholder_in_a_target(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("OUT", str(tmp_path / "t"))
    write(spark.range(2), Target("parquet", {"path": "${env:OUT}"}))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


@pytest.fixture
def stored(spark, tmp_path):
    path = tmp_path / "a b" / "t"
    spark.range(5).write.parquet(str(path / "part=1"))
    return path


@pytest.mark.parametrize("target", ["part=1", ".", ".."])
def test_overwriting_the_input_is_refused(spark, stored, target):
    source = Source("parquet", {"path": str(stored / "part=1")})
    path = {"path": str((stored / target).resolve())}
    with pytest.raises(SelfOverwrite):
        run_job(spark, job(source, Target("parquet", path, "overwrite")))
    with pytest.raises(SelfOverwrite):
        write(spark.read.parquet(str(stored)), Target("json", path, "Overwrite"))
    assert spark.read.parquet(str(stored)).count() == 5


def test_input_read_through_a_subquery_is_refused(spark, stored, tmp_path):
    spark.read.parquet(str(stored)).createOrReplaceTempView("stored_rows")
    other = str(tmp_path / "other")
    spark.range(9).write.parquet(other)
    source = Source("parquet", {"path": other}, where="id IN (SELECT id FROM stored_rows)")
    with pytest.raises(SelfOverwrite):
        run_job(spark, job(source, Target("parquet", {"path": str(stored)}, "overwrite")))


def test_a_neighbour_may_be_overwritten(spark, stored):
    neighbour = str(stored) + "2"
    for _ in range(2):
        run_job(
            spark,
            job(
                Source("parquet", {"path": str(stored)}),
                Target("parquet", {"path": neighbour}, "overwrite"),
            ),
        )
    assert spark.read.parquet(neighbour).count() == 5


def test_appending_to_the_input_is_allowed(spark, stored):
    path = {"path": str(stored / "part=1")}
    run_job(spark, job(Source("parquet", path), Target("parquet", path, "append")))
    assert spark.read.parquet(path["path"]).count() == 10


@pytest.mark.parametrize(
    ("folder", "read", "refused"),
    [
        ("s3a://bucket/t", "s3a://bucket/t/part-0.parquet", True),
        ("s3a://bucket/t/", "s3a://bucket/t", True),
        ("s3a://bucket/t/x", "s3a://bucket/t", True),
        ("s3a://bucket/u/../t", "s3a://bucket//t", True),
        ("s3a://bucket/t", "s3a://other/t", False),
        ("s3a://bucket/t", "s3a://bucket/t2", False),
        ("/data/t", "file:///data/t/a%20b", True),
        ("file:/data/t/../t", "/data//t", True),
        ("/", "file:/data/t", True),
    ],
)
def test_paths_that_overlap(spark, folder, read, refused):
    if refused:
        with pytest.raises(SelfOverwrite):
            refuse_self_overwrite(spark, folder, [read])
    else:
        refuse_self_overwrite(spark, folder, [read])


@pytest.mark.parametrize(
    ("format", "option", "spelled"),
    [
        ("PARQUET", "path", "{place}"),
        ("parquet", "PATH", "{place}"),
        (" Parquet ", "Path", "{place}"),
        ("parquet", "path", "{folder}/x/../{name}"),
        ("parquet", "path", "{folder}//{name}/"),
        ("parquet", "path", "file:{place}"),
        ("parquet", "path", "{relative}"),
        ("parquet", "path", "{link}"),
        ("org.apache.spark.sql.execution.datasources.parquet.ParquetFileFormat", "path", "{place}"),
    ],
)
@pytest.mark.parametrize("source", ["{place}", "{folder}/t_*"])
def test_every_spelling_of_the_input_is_refused(spark, tmp_path, format, option, spelled, source):
    place = tmp_path / "t_1"
    spark.range(5).write.parquet(str(place))
    (tmp_path / "link").symlink_to(place)
    words = {
        "place": place, "folder": tmp_path, "name": "t_1", "link": tmp_path / "link",
        "relative": os.path.relpath(place),
    }
    target = Target(format, {option: spelled.format(**words)}, "Overwrite")
    frame = spark.read.parquet(source.format(**words))
    for attempt in (
        lambda: run_job(spark, job(Source("parquet", {"path": source.format(**words)}), target)),
        lambda: write(frame, target),
        lambda: write(frame.groupBy("id").count(), target),
    ):
        with pytest.raises(SelfOverwrite):
            attempt()
    assert spark.read.parquet(str(place)).count() == 5


def test_a_column_named_like_a_word_of_sql(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("id AS valid_from", "id AS Exchange").write.parquet(path)
    target = Target("parquet", {"path": str(tmp_path / "u")}, "overwrite")
    run_job(spark, job(Source("parquet", {"path": path}, where="valid_from > 1", limit=2), target))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 2


def test_rows_of_an_rdd_over_files_are_refused(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("x\n")
    lines = spark.sparkContext.textFile(str(tmp_path / "t")).map(lambda line: (line,))
    frame = spark.createDataFrame(lines, "line string")
    with pytest.raises(SelfOverwrite):
        write(frame, Target("text", {"path": str(tmp_path / "t")}, "overwrite"))
    assert (tmp_path / "t" / "a.txt").exists()


def test_rows_from_memory_may_overwrite(spark, tmp_path):
    for _ in range(2):
        frame = spark.createDataFrame([(1,)], "id int").unionByName(spark.range(1).selectExpr("CAST(id AS INT) AS id"))
        write(frame, Target("parquet", {"path": str(tmp_path / "t")}, "overwrite"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_array_columns_are_the_format_s_to_reject(spark, tmp_path, table):
    with pytest.raises(AnalysisException, match="UNSUPPORTED_DATA_TYPE_FOR_DATASOURCE"):
        write(table("embeddings"), Target("csv", {"path": str(tmp_path / "t")}))
    assert not list(Path(tmp_path).glob("t/*.csv"))
