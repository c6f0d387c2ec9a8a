"""Filter, projection, schema print, limit, preview, repartitioning, and their order."""

import re

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sluiceway import Column, Partition, Source, read
from sluiceway.operators import repartition_rows
from sluiceway.operators.shape import shape


@pytest.fixture
def customer(spark, sf):
    def read_customer(**steps):
        return read(spark, Source("parquet", {"path": f"{sf}/customer.parquet"}, **steps))

    return read_customer


def plan(frame, capsys):
    frame.explain("formatted")
    return capsys.readouterr().out


def sizes(frame):
    return [len(part) for part in frame.rdd.glom().collect()]


def places(frame, key):
    """In how many partitions each key lies."""
    return (
        frame.select(key, F.spark_partition_id().alias("part"))
        .groupBy(key)
        .agg(F.countDistinct("part").alias("n"))
    )


def test_filter_sees_columns_the_projection_drops(spark, boats_csv):
    source = Source(
        "csv",
        {"header": "true", "path": boats_csv},
        [Column("hull", "number"), Column("title")],
        where="harbour = 'Bergen'",
    )
    rows = read(spark, source).collect()
    assert [tuple(row) for row in rows] == [("17", "Petrel"), ("23", "Tern")]


def test_filter_does_not_see_aliases(customer):
    with pytest.raises(AnalysisException):
        customer(columns=[Column("c_custkey", "id")], where="id > 3")


def test_blank_filter_and_no_columns_mean_everything(customer, table):
    assert customer(where="  ").collect() == table("customer").collect()


def test_scan_reads_and_filters_only_what_is_needed(customer, capsys):
    frame = customer(columns=["c_name"], where="c_acctbal > 100")
    text = plan(frame, capsys)
    assert "ReadSchema: struct<c_name:string,c_acctbal:double>" in text
    assert "GreaterThan(c_acctbal,100.0)" in text
    assert "Exchange" not in text


def test_requested_case_is_kept(customer):
    assert customer(columns=["C_NAME"]).columns == ["C_NAME"]


@pytest.mark.parametrize("alias", ["plain", "two words", "with `tick`", "ünï-cödé"])
def test_alias_may_be_any_text(customer, alias):
    assert customer(columns=[Column("c_name", alias)]).columns == [alias]


def test_quoted_and_multiple_aliases(customer):
    assert customer(columns=[Column("c_name", "`a b`")]).columns == ["a b"]
    frame = customer(columns=[Column("explode(map(c_custkey, c_name))", "(k, v)")])
    assert frame.columns == ["k", "v"]


def test_star_cast_and_lateral_alias(customer):
    columns = ["*", Column("CAST(c_nationkey AS LONG)", "n"), Column("n + 1", "m")]
    frame = customer(columns=columns)
    assert frame.columns[-2:] == ["n", "m"]
    assert frame.schema["n"].dataType == LongType()
    assert frame.where("m <> c_nationkey + 1").isEmpty()


def test_user_function_in_a_column(spark, customer):
    @F.pandas_udf("string")
    def shout(names: pd.Series) -> pd.Series:
        return names.str.upper()

    spark.udf.register("shout", shout)
    rows = customer(columns=[Column("shout(c_name)", "name"), Column("upper(c_name)", "same")])
    assert rows.where("name <> same").isEmpty()


def test_schema_print_shows_the_projection(customer, capsys):
    customer(columns=[Column("c_custkey", "id")], printSchema=True)
    out = capsys.readouterr().out
    assert "id: long" in out and "c_name" not in out


def test_show_follows_limit(customer, capsys):
    customer(columns=[Column("c_custkey", "id")], limit=2, show=5)
    lines = [line for line in capsys.readouterr().out.splitlines() if line.startswith("|")]
    assert len(lines) == 3  # the heading and two rows


@pytest.mark.parametrize(("limit", "rows"), [(10, 10), (1000, 150), (0, 150), (-1, 150)])
def test_limit(customer, limit, rows):
    assert customer(limit=limit).count() == rows


def test_limit_comes_before_repartition(customer):
    frame = customer(limit=12, partition=Partition(4))
    assert sizes(frame) == [3, 3, 3, 3]


def limit_plans(frame, capsys):
    text = plan(frame, capsys)
    return [line.split(" ", 1)[-1] for line in re.findall(r"\w*Limit\w*", text)]


@pytest.mark.parametrize("over", ["parquet", "window", "no file"])
def test_one_plan_for_every_limit(spark, tmp_path, capsys, over):
    """No size at which the plan changes, no checkpoint folder, no job before an action."""
    path = str(tmp_path / "t")
    spark.range(0, 100_005, 1, 4).write.parquet(path)
    columns = ["id", Column("row_number() OVER (PARTITION BY id % 7 ORDER BY id)", "n")]
    group = f"no job {over}"
    spark.sparkContext.setJobGroup(group, group)
    found = []
    for rows in (100_000, 100_001):
        if over == "no file":
            spark.range(100_005).createOrReplaceTempView("numbers")
            frame = shape(spark.table("numbers"), Source("any", {}, limit=rows))
        else:
            steps = {"columns": columns} if over == "window" else {}
            frame = read(spark, Source("parquet", {"path": path}, limit=rows, **steps))
        found.append((frame, limit_plans(frame, capsys), rows))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group) or over != "no file"
    assert found[0][1] == found[1][1]
    for frame, _, rows in found:
        ids = [row.id for row in frame.select("id").collect()]
        assert len(ids) == len(set(ids)) == rows and max(ids) < 100_005


def test_limit_filters_first(spark, sf):
    source = Source(
        "parquet", {"path": f"{sf}/lineitem.parquet"}, where="l_returnflag = 'R'", limit=500
    )
    frame = read(spark, source)
    assert frame.count() == 500
    assert frame.where("l_returnflag <> 'R'").isEmpty()


def test_round_robin(customer):
    assert sorted(sizes(customer(partition=Partition(4)))) == [37, 37, 38, 38]


@pytest.mark.parametrize("number", [0, -1])
def test_no_repartition(customer, number):
    assert len(sizes(customer(partition=Partition(number, "c_custkey")))) == 1


def test_hash_keeps_a_small_key_together(customer):
    frame = customer(partition=Partition(5, "c_nationkey"))
    assert places(frame, "c_nationkey").where("n > 1").isEmpty()


def test_by_is_a_column_not_an_expression(customer):
    with pytest.raises(AnalysisException):
        customer(partition=Partition(5, "c_nationkey % 3"))


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.01",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture
def skewed(spark):
    """9000 rows, a third with one key, read by several tasks."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    return spark.range(0, 9000, 1, 6).select(key.alias("key"), F.md5(F.col("id").cast("string")).alias("text"))


def files(frame, path, condition):
    """In how many of the written files there are rows for which the condition holds."""
    frame.write.parquet(str(path))
    back = frame.sparkSession.read.parquet(str(path)).where(condition)
    return back.select(F.input_file_name()).distinct().count()


def test_hot_key_is_spread_in_one_lazy_pass(spark, skewed, small_partitions, tmp_path):
    spark.sparkContext.setJobGroup("spread", "spread")
    frame = repartition_rows(skewed, Partition(10, "key"))
    assert frame.columns == ["key", "text"]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("spread")
    assert files(frame, tmp_path / "t", "key = -1") > 1
    assert frame.exceptAll(skewed).isEmpty() and skewed.exceptAll(frame).isEmpty()


def test_null_may_be_the_hot_key(skewed, small_partitions, tmp_path):
    nulls = skewed.select(F.when(F.col("key") != -1, F.col("key")).alias("key"), "text")
    frame = repartition_rows(nulls, Partition(10, "key"))
    assert frame.count() == 9000
    assert files(frame, tmp_path / "t", "key IS NULL") > 1


def test_keep_together_is_plain_hashing(skewed, small_partitions):
    frame = repartition_rows(skewed, Partition(10, "key", keepTogether=True))
    assert frame.rdd.getNumPartitions() == 10
    spread = frame.where("key = -1").select(F.spark_partition_id()).distinct().count()
    assert spread == 1


def test_earlier_query_names_stay():
    from showcase import ORACLES, QUERIES

    assert {"limit_count", "limit_large", "limit_distributed"} <= QUERIES.keys() & ORACLES.keys()
