"""What the filter and the projection accept: all of Spark SQL's expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from showcase.registry import parquet, query
from sluiceway import Column, read


@query(
    """
    SELECT upper(p_name) AS name, substr(p_brand, 7) AS brand_number,
           p_type || '/' || p_brand AS type_brand, CAST(length(p_name) AS INTEGER) AS name_length
    FROM part
    """
)
def expr_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        Column("upper(p_name)", "name"),
        Column("substr(p_brand, 7)", "brand_number"),
        Column("concat(p_type, '/', p_brand)", "type_brand"),
        Column("length(p_name)", "name_length"),
    ]
    return read(spark, parquet(sf_dir, "part", columns=columns))


@query(
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
           CAST(month(o_orderdate) AS INTEGER) AS order_month,
           date_trunc('month', o_orderdate)::TIMESTAMP AS order_month_start
    FROM orders
    """
)
def expr_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        Column("o_orderkey"),
        Column("year(o_orderdate)", "order_year"),
        Column("month(o_orderdate)", "order_month"),
        Column("CAST(date_trunc('month', o_orderdate) AS TIMESTAMP_NTZ)", "order_month_start"),
    ]
    return read(spark, parquet(sf_dir, "orders", columns=columns))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS discounted,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charged
    FROM lineitem
    """
)
def expr_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        Column("l_orderkey"),
        Column("l_linenumber"),
        Column("l_extendedprice * (1 - l_discount)", "discounted"),
        Column("discounted * (1 + l_tax)", "charged"),
    ]
    return read(spark, parquet(sf_dir, "lineitem", columns=columns))


@query(
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
    """
)
def expr_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(
        spark,
        parquet(
            sf_dir,
            "events",
            columns=[Column("event_id"), Column("CAST(get_json_object(props, '$.k') AS INT)", "k")],
        ),
    )


@query(
    """
    SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderpriority LIKE '1%' THEN o_orderpriority
                                ELSE split_part(o_orderpriority, '-', 1) END AS INTEGER) AS priority
    FROM orders
    """
)
def expr_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cast that gives NULL for text that is no number."""
    text = (
        "CASE WHEN o_orderpriority LIKE '1%' THEN o_orderpriority "
        "ELSE split_part(o_orderpriority, '-', 1) END"
    )
    columns = [Column("o_orderkey"), Column(f"try_cast({text} AS INT)", "priority")]
    return read(spark, parquet(sf_dir, "orders", columns=columns))


@query(
    """
    SELECT vec_id, len(embedding) AS dimensions, CAST(embedding[1] AS DOUBLE) AS first_value,
           CASE WHEN label = 0 THEN 'zero' ELSE 'other' END AS label_kind
    FROM embeddings
    """
)
def expr_array_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        Column("vec_id"),
        Column("CAST(size(embedding) AS LONG)", "dimensions"),
        Column("CAST(embedding[0] AS DOUBLE)", "first_value"),
        Column("CASE WHEN label = 0 THEN 'zero' ELSE 'other' END", "label_kind"),
    ]
    return read(spark, parquet(sf_dir, "embeddings", columns=columns))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem
    """
)
def expr_registered_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function the user registered; written in SQL, it stays inside generated code."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION net_price(price DOUBLE, discount DOUBLE) "
        "RETURNS DOUBLE RETURN price * (1 - discount)"
    )
    columns = [
        Column("l_orderkey"),
        Column("l_linenumber"),
        Column("net_price(l_extendedprice, l_discount)", "net"),
    ]
    return read(spark, parquet(sf_dir, "lineitem", columns=columns))


@query(
    """
    SELECT count(*) AS n, max(o_totalprice) AS highest, min(o_orderdate) AS first_order,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM orders
    """
)
def expr_global_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        Column("count(*)", "n"),
        Column("max(o_totalprice)", "highest"),
        Column("min(o_orderdate)", "first_order"),
        Column("CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE)", "total"),
    ]
    return read(spark, parquet(sf_dir, "orders", columns=columns))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS position,
           max(l_shipdate) OVER (PARTITION BY l_orderkey) AS last_shipped
    FROM lineitem
    """
)
def expr_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window per order; an order has a handful of lines."""
    columns = [
        Column("l_orderkey"),
        Column("l_linenumber"),
        Column("l_partkey"),
        Column(
            "CAST(rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS LONG)", "position"
        ),
        Column("max(l_shipdate) OVER (PARTITION BY l_orderkey)", "last_shipped"),
    ]
    return read(spark, parquet(sf_dir, "lineitem", columns=columns))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def expr_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [Column("p_partkey"), Column("explode(split(p_name, ' '))", "word")]
    return read(spark, parquet(sf_dir, "part", columns=columns))


@query(
    """
    SELECT s_suppkey, s_acctbal, (SELECT max(s_acctbal) FROM supplier) AS highest FROM supplier
    """
)
def expr_scalar_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/supplier.parquet").createOrReplaceTempView("all_suppliers")
    columns = [
        Column("s_suppkey"),
        Column("s_acctbal"),
        Column("(SELECT max(s_acctbal) FROM all_suppliers)", "highest"),
    ]
    return read(spark, parquet(sf_dir, "supplier", columns=columns))
