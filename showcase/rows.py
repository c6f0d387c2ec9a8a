"""Scan, filter, projection, limit and repartitioning."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

from showcase.registry import parquet, query, scratch
from sluiceway import Column, Partition, PropertyGraph, Source, read


@query(
    """
    SELECT CAST(c_acctbal AS DOUBLE) AS c_acctbal, CAST(c_custkey AS BIGINT) AS c_custkey,
           c_mktsegment, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey
    FROM customer WHERE c_acctbal > 0
    """
)
def filter_project_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(
        spark,
        parquet(
            sf_dir,
            "customer",
            where="C_ACCTBAL > 0",
            columns=[
                Column("CAST(C_ACCTBAL AS DOUBLE)", "c_acctbal"),
                Column("CAST(C_CUSTKEY AS LONG)", "c_custkey"),
                Column("c_mktsegment"),
                Column("c_name"),
                Column("CAST(C_NATIONKEY AS LONG)", "c_nationkey"),
            ],
        ),
    )


@query("SELECT c_name AS name, c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_unprojected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(
        spark,
        parquet(
            sf_dir,
            "customer",
            where="c_mktsegment = 'BUILDING'",
            columns=[Column("c_name", "name"), Column("c_custkey", "id")],
        ),
    )


@query("SELECT * FROM lineitem")
def project_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, parquet(sf_dir, "lineitem"))


@query('SELECT p_partkey AS "part number", p_brand AS "the brand" FROM part')
def rename_freely(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bare alias may be any text; one in backticks is SQL already."""
    columns = [Column("p_partkey", "part number"), Column("p_brand", "`the brand`")]
    return read(spark, parquet(sf_dir, "part", columns=columns))


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
    """
)
def where_in_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/customer.parquet").createOrReplaceTempView("all_customers")
    return read(
        spark,
        parquet(
            sf_dir,
            "orders",
            where="o_custkey IN (SELECT c_custkey FROM all_customers "
            "WHERE c_mktsegment = 'MACHINERY')",
            columns=["o_orderkey", "o_totalprice"],
        ),
    )


@query(
    """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders
                      WHERE o_custkey = c_custkey AND o_totalprice > 400000)
    """
)
def where_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inner side is made distinct first: a customer may have a third of all orders."""
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("all_orders")
    return read(
        spark,
        parquet(
            sf_dir,
            "customer",
            where="NOT EXISTS (SELECT 1 FROM "
            "(SELECT DISTINCT o_custkey FROM all_orders WHERE o_totalprice > 400000) "
            "WHERE o_custkey = c_custkey)",
            columns=["c_custkey", "c_name"],
        ),
    )


def _taken(spark: SparkSession, sf_dir: str, table: str, rows: int) -> DataFrame:
    """A limit takes any rows: how many, how often each, and how many of them the table has."""
    taken = read(spark, parquet(sf_dir, table, limit=rows))
    copies = taken.groupBy(*taken.columns).agg(F.count("*").alias("taken"))
    there = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    stored = there.groupBy(*there.columns).agg(F.count("*").alias("stored"))
    return copies.join(stored, taken.columns, "left").agg(
        F.sum("taken").alias("taken"),
        F.sum(F.least("taken", F.coalesce("stored", F.lit(0)))).alias("from_the_table"),
    )


@query("SELECT count(*) AS taken, count(*) AS from_the_table FROM (SELECT * FROM orders LIMIT 10)")
def limit_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small limit: so many rows, all of the table, none more often than there."""
    return _taken(spark, sf_dir, "orders", 10)


@query(
    "SELECT count(*) AS taken, count(*) AS from_the_table FROM (SELECT * FROM lineitem LIMIT 20000)"
)
def limit_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large limit has the same plan and the same promise."""
    return _taken(spark, sf_dir, "lineitem", 20000)


@query(
    "SELECT count(*) AS taken, count(*) AS from_the_table FROM (SELECT * FROM lineitem LIMIT 20000)"
)
def limit_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier name of the large limit, kept for those who compare rounds."""
    return limit_large(spark, sf_dir)


@query("SELECT * FROM supplier")
def repartition_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, parquet(sf_dir, "supplier", partition=Partition(4)))


@query("SELECT * FROM customer")
def repartition_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, parquet(sf_dir, "customer", partition=Partition(8, "c_custkey")))


@query("SELECT * FROM lineitem")
def repartition_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three values over sixteen partitions: adaptive execution splits those that are too large."""
    return read(spark, parquet(sf_dir, "lineitem", partition=Partition(16, "l_returnflag")))


@query("SELECT * FROM orders")
def repartition_keys_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict form: whatever its size, a key stays in one partition."""
    partition = Partition(8, "o_custkey", keepTogether=True)
    return read(spark, parquet(sf_dir, "orders", partition=partition))


@query("SELECT n_nationkey, n_name FROM nation")
def option_placeholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source's path comes from the environment."""
    os.environ["SLUICEWAY_SHOWCASE_TABLE"] = f"{sf_dir}/nation.parquet"
    path = {"path": "${env:SLUICEWAY_SHOWCASE_TABLE}"}
    return read(spark, Source("parquet", path, columns=["n_nationkey", "n_name"]))


@query(
    "SELECT c_nationkey AS nation, count(*) AS customers, sum(c_acctbal) AS balance "
    "FROM customer GROUP BY c_nationkey"
)
def option_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query of a graph source comes from a text file."""
    graph, text = scratch(spark), tempfile.NamedTemporaryFile("w", suffix=".sql", delete=False)
    with text as file:
        file.write(
            "SELECT c_nationkey AS nation, count(*) AS customers, sum(c_acctbal) AS balance "
            "FROM {Buyer} GROUP BY c_nationkey"
        )
    PropertyGraph(spark, graph).write_nodes(
        spark.read.parquet(f"{sf_dir}/customer.parquet"), ":Buyer"
    )
    query_text = f"${{file:{text.name}}}"
    try:
        return read(spark, Source("graph", {"path": graph, "query": query_text}))
    finally:
        os.remove(text.name)
