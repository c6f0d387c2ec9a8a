"""Writing to file formats, save modes and sequences of jobs, read back afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from showcase.registry import parquet, query, scratch
from sluiceway import Column, JobConfig, Source, Target, read, run_job, run_jobs

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _through(spark: SparkSession, source: Source, format: str, **options: str) -> Source:
    """The source's rows, written in a format by one job and ready to be read again."""
    path = {"path": scratch(spark), **options}
    run_job(spark, JobConfig(source=source, target=Target(format, path, "Overwrite")))
    return Source(format, path)


@query(CUSTOMER)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV brings back text; the second source casts it."""
    written = _through(spark, parquet(sf_dir, "customer"), "csv", header="true")
    columns = [
        Column("CAST(c_custkey AS LONG)", "c_custkey"),
        Column("c_name"),
        Column("CAST(c_nationkey AS INT)", "c_nationkey"),
        Column("CAST(c_acctbal AS DOUBLE)", "c_acctbal"),
        Column("c_mktsegment"),
    ]
    return read(spark, Source("csv", written.options, columns))


@query("SELECT * FROM orders")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, _through(spark, parquet(sf_dir, "orders"), "parquet"))


@query("SELECT * FROM supplier")
def orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, _through(spark, parquet(sf_dir, "supplier"), "orc"))


@query("SELECT doc_id, text, lang FROM documents")
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, line breaks and all."""
    source = parquet(sf_dir, "documents", columns=["doc_id", "text", "lang"])
    return read(spark, _through(spark, source, "json"))


@query("SELECT p_partkey, p_name, p_size FROM part")
def xml_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = parquet(sf_dir, "part", columns=["p_partkey", "p_name", "p_size"])
    written = _through(spark, source, "xml", rowTag="part")
    columns = [
        Column("p_partkey"),
        Column("p_name"),
        Column("CAST(p_size AS INT)", "p_size"),
    ]
    return read(spark, Source("xml", written.options, columns))


@query("SELECT url AS value FROM pages")
def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, _through(spark, parquet(sf_dir, "pages", columns=["url"]), "text"))


def _twice(spark: SparkSession, sf_dir: str, first: str, second: str, mode: str) -> DataFrame:
    """Suppliers matching ``first``, then those matching ``second`` with a save mode."""
    path = {"path": scratch(spark)}
    for where, how in ((first, ""), (second, mode)):
        source = parquet(sf_dir, "supplier", where=where)
        run_job(spark, JobConfig(source=source, target=Target("parquet", path, how)))
    return read(spark, Source("parquet", path))


@query("SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_acctbal > 5000")
def save_mode_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice(spark, sf_dir, "", "s_acctbal > 5000", "Append")


@query("SELECT * FROM supplier WHERE s_acctbal > 5000")
def save_mode_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice(spark, sf_dir, "s_acctbal > 5000", "", "Ignore")


@query("SELECT * FROM supplier WHERE s_acctbal <= 5000")
def save_mode_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice(spark, sf_dir, "", "s_acctbal <= 5000", "Overwrite")


@query(
    "SELECT o_custkey AS id, o_totalprice AS price FROM orders"
)
def job_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three jobs in a row, each reading what the one before wrote."""
    first, second, third = (scratch(spark) for _ in range(3))
    columns = [{"name": "o_custkey", "alias": "id"}, {"name": "o_totalprice", "alias": "price"}]
    run_jobs(
        spark,
        [
            {
                "name": "orders",
                "source": {
                    "format": "parquet",
                    "options": {"path": f"{sf_dir}/orders.parquet"},
                    "columns": columns,
                    "partition": {},
                },
                "target": {"format": "parquet", "options": {"path": first}, "mode": "Overwrite"},
            },
            {
                "name": "as text",
                "source": {"format": "parquet", "options": {"path": first}},
                "target": {"format": "json", "options": {"path": second}},
            },
            {
                "name": "as a table again",
                "source": {"format": "json", "options": {"path": second}},
                "target": {"format": "parquet", "options": {"path": third}, "mode": "append"},
            },
        ],
    )
    return spark.read.parquet(third)
