"""Rows that cannot be cast, counts of rows moved, and jobs that run at once."""

import threading
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway import JobConfig, PropertyGraph, Source, Target, run_job, run_jobs
from sluiceway.operators.rejects import Cast, lenient, with_reason
from sluiceway.plans import together
from sluiceway.spec import Column


@pytest.mark.parametrize(
    ("expression", "mild", "casts"),
    [
        ("a + 1", "a + 1", []),
        ("CAST(a AS INT)", "TRY_CAST(a AS INT)", [Cast("a", "INT")]),
        ("cast ( a as decimal(10, 2) ) * 2", "TRY_CAST( a as decimal(10, 2) ) * 2", [Cast("a", "decimal(10, 2)")]),
        ("'CAST(x AS INT)' || `cast(`", "'CAST(x AS INT)' || `cast(`", []),
        ("CAST(CAST(a AS INT) AS DATE)", "TRY_CAST(TRY_CAST(a AS INT) AS DATE)", [Cast("a", "INT"), Cast("TRY_CAST(a AS INT)", "DATE")]),
        ("f(CAST(concat(a, ' as (') AS INT), b)", "f(TRY_CAST(concat(a, ' as (') AS INT), b)", [Cast("concat(a, ' as (')", "INT")]),
        ("TRY_CAST(a AS INT) + t.cast", "TRY_CAST(a AS INT) + t.cast", []),
        ("CAST(a", "CAST(a", []),
    ],
)
def test_lenient(expression, mild, casts):
    found = lenient(expression)
    assert " ".join(found[0].replace(" AS ", " as ").replace("AS", "as").split()) == " ".join(mild.replace(" AS ", " as ").replace("AS", "as").split())
    assert found[1] == casts


@given(st.text(alphabet="abAScast()'`\" ,\\1", max_size=40))
def test_lenient_takes_any_text(text):
    lenient(text)


TEXTS = [("1", "2.5", "x"), ("one", "2", "y"), (None, None, "z"), ("3", "no", None), ("999999999999", "1", "w"), (" 7 ", "1e2", "v")]
COLUMNS = [{"name": "CAST(a AS INT)", "alias": "n"}, {"name": "CAST(b AS DOUBLE) * 2", "alias": "m"}, {"name": "c", "alias": "reason"}]


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame(TEXTS, "a string, b string, c string").repartition(2).write.parquet(path)
    return path


def job(tmp_path, source, **more):
    target, rejected = str(tmp_path / "good"), str(tmp_path / "bad")
    return JobConfig(
        source=Source("parquet", {"path": source}, columns=more.pop("columns", COLUMNS), **more),
        target=Target("parquet", {"path": target}, "overwrite"),
        rejected=Target("parquet", {"path": rejected}, "overwrite"),
    )


def test_rejected_rows(spark, tmp_path, source):
    counts = run_job(spark, job(tmp_path, source), counts=True)
    good, bad = (spark.read.parquet(str(tmp_path / name)) for name in ("good", "bad"))
    assert good.columns == ["n", "m", "reason"] and bad.columns == ["a", "b", "c", "reason"]
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 5.0, "x"), (7, 200.0, "v"), (None, None, "z")]
    assert {(r["a"], r["b"], r["c"]): r["reason"] for r in bad.collect()} == {
        ("one", "2", "y"): "n: cannot cast a to INT: one",
        ("3", "no", None): "m: cannot cast b to DOUBLE: no",
        ("999999999999", "1", "w"): "n: cannot cast a to INT: 999999999999",
    }
    assert counts == {"read": 6, "kept": 6, "rejected": 3, "written": 3}
    assert run_job(spark, job(tmp_path, source, where="a = 'one'"), counts=True)["rejected"] == 1
    assert spark.read.parquet(str(tmp_path / "good")).count() == 0
    run_job(spark, job(tmp_path, source, columns=[]))  # nothing is cast
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 0


def test_one_scan(spark, source, capsys):
    apart = with_reason(spark.read.parquet(source), [Column.of(c) for c in COLUMNS])
    apart.explain()
    assert capsys.readouterr().out.count("FileScan") == 1


def test_spec_of_rejected():
    data = {"source": {"format": "csv"}, "target": {"format": "csv"}, "rejected": {"format": "json", "mode": "append"}}
    assert JobConfig.load(data).rejected == Target("json", {}, "append")
    assert JobConfig.load({**data, "rejected": None}).rejected is None


def test_counts(spark, tmp_path, source, capsys):
    plain = JobConfig(
        source=Source("parquet", {"path": source}, columns=["c"], where="b > '1'", show=1),
        target=Target("parquet", {"path": str(tmp_path / "out")}, "overwrite"),
    )
    want = {"read": 6, "kept": 4, "written": 4}
    assert spark.read.parquet(source).where("b > '1'").count() == 4
    assert run_job(spark, plain, counts=True) == want
    assert run_job(spark, plain) == {}
    graph = JobConfig(
        source=Source("parquet", {"path": source}, columns=["c", "b"], where="b > '1'"),
        target=Target("graph", {"path": str(tmp_path / "g"), "labels": "T"}, "append"),
    )
    assert run_job(spark, graph, counts=True) == want
    assert PropertyGraph(spark, str(tmp_path / "g")).read_nodes("T").count() == 4


def test_the_source_is_read_once(spark, tmp_path, source):
    """Counting takes no further scan: a function of the rows is called once for each."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(value):
        seen.add(1)
        return value

    spark.udf.register("noted", noted.asNondeterministic())
    counted = JobConfig(
        source=Source("parquet", {"path": source}, columns=["noted(c) AS c"]),
        target=Target("parquet", {"path": str(tmp_path / "out")}, "overwrite"),
    )
    assert run_job(spark, counted, counts=True)["written"] == 6 and seen.value == 6


def moves(tmp_path, *pairs):
    return [
        JobConfig(
            source=Source("parquet", {"path": str(tmp_path / a)}),
            target=Target("parquet", {"path": str(tmp_path / b)}, "overwrite"),
        )
        for a, b in pairs
    ]


def test_who_waits_for_whom(spark, tmp_path):
    jobs = moves(tmp_path, ("a", "b"), ("a", "c"), ("b", "d"), ("x", "b/inner"), ("c", "a"), ("y", "bb"))
    assert together.predecessors(spark, jobs) == [set(), set(), {0}, {0, 2}, {0, 1}, set()]
    tables = [JobConfig(source=Source("jdbc", {"dbtable": "t"}), target=Target("parquet", {"path": "/p"})) for _ in range(2)]
    assert together.predecessors(spark, tables)[1] == {0}  # one target
    others = [JobConfig(source=Source("csv", {"path": f"/{n}"}), target=Target("jdbc", {"dbtable": str(n)})) for n in range(2)]
    assert together.predecessors(spark, others)[1] == {0}  # which tables of a database are one is not known


def test_jobs_overlap_and_keep_their_order(spark, tmp_path):
    jobs = moves(tmp_path, ("a", "b"), ("x", "y"), ("b", "c"))
    spans, both = {}, threading.Barrier(2, timeout=60)

    def move(one):
        n = jobs.index(one)
        spans[n] = [time.monotonic()]
        if n < 2:
            both.wait()  # passes only while both are running
        spans[n].append(time.monotonic())

    together.run_together(spark, jobs, move, 2)
    assert spans[2][0] >= spans[0][1] and len(spans) == 3


def test_together_gives_the_same_tables(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "a"))
    run_jobs(spark, moves(tmp_path, ("a", "b"), ("a", "c"), ("b", "d"), ("c", "e")), together=3)
    assert all(spark.read.parquet(str(tmp_path / name)).count() == 100 for name in "bcde")
    with pytest.raises(ValueError, match="session"):
        run_jobs(None, moves(tmp_path, ("a", "b")), together=2)


def test_a_failure_stops_the_others(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "a"))
    source = Source("parquet", {"path": str(tmp_path / "a")}, columns=["slowly(id) AS id"])
    slow = JobConfig(source=source, target=Target("parquet", {"path": str(tmp_path / "slow")}))
    spark.udf.register("slowly", lambda x: time.sleep(1) or x, "long")
    began = time.monotonic()
    with pytest.raises(Exception, match="(?i)path_not_found|does not exist"):
        run_jobs(spark, [slow, *moves(tmp_path, ("none", "z"), ("a", "late"), ("late", "later"))], together=2)
    assert time.monotonic() - began < 80
    assert not (tmp_path / "later").exists() and not list((tmp_path / "slow").glob("_SUCCESS"))
