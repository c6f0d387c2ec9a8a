"""Nodes and relationships: append, upsert, merge and reading back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from showcase.registry import parquet, query, scratch
from sluiceway import JobConfig, NodePattern, PropertyGraph, Source, Target, read, run_job

CUSTOMER = NodePattern(":Buyer", "o_custkey:id", "overwrite")
ORDER = NodePattern(":Order", "o_orderkey:id", "overwrite")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _graph(spark: SparkSession) -> PropertyGraph:
    return PropertyGraph(spark, scratch(spark))


def _labels(column: str = "<labels>") -> Column:
    return F.array_join(F.col(f"`{column}`"), ":").alias("labels")


@query(
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
    """
)
def nodes_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables appended under one label; the second lacks a property of the first."""
    graph = _graph(spark)
    customers = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"
    )
    suppliers = _table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name")
    graph.write_nodes(customers, ":Party", mode="append")
    graph.write_nodes(suppliers, ":Party", mode="append")
    return graph.read_nodes(":Party").select("id", "name", "segment")


@query(
    """
    SELECT c_custkey AS id, upper(c_name) AS name, c_acctbal * 2 AS balance,
           CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS segment
    FROM customer
    """
)
def nodes_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some customers first, then all of them: matched ones change and keep their segment."""
    graph = _graph(spark)
    customers = _table(spark, sf_dir, "customer")
    some = customers.where("c_acctbal > 5000")
    graph.write_nodes(
        some.selectExpr(
            "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
        ),
        ":Buyer",
        "id",
        "overwrite",
    )
    graph.write_nodes(
        customers.selectExpr(
            "c_custkey AS id", "upper(c_name) AS name", "c_acctbal * 2 AS balance"
        ),
        ":Buyer",
        "id",
        "overwrite",
    )
    return graph.read_nodes(":Buyer").select("id", "name", "balance", "segment")


@query(
    """
    SELECT c_custkey AS id, c_name AS name, o_orderdate AS last_order, o_orderpriority AS priority
    FROM customer LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders
    ) ON o_custkey = c_custkey AND rn = 1
    """
)
def nodes_upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many orders per customer in one batch: the last one sets the customer's columns."""
    graph = _graph(spark)
    customers = _table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "o_orderkey", "o_orderdate AS last_order", "o_orderpriority AS priority"
    )
    graph.write_nodes(customers, ":Buyer", "id", "overwrite")
    graph.write_nodes(
        orders, ":Buyer", "o_custkey:id", "overwrite", order_by=["last_order", "o_orderkey"]
    )
    return graph.read_nodes(":Buyer").select("id", "name", "last_order", "priority")


@query(
    """
    SELECT user_id, event_type, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id
                                     ORDER BY event_type DESC, event_id DESC) AS rn
        FROM events
    ) WHERE rn = 1
    """
)
def nodes_upsert_largest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With no order given the largest row of a key wins, whatever the partitioning."""
    graph = _graph(spark)
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    graph.write_nodes(events, ":User", "user_id", "overwrite")
    return graph.read_nodes(":User").select("user_id", "event_type", "event_id")


@query(
    """
    SELECT c_custkey AS id, 'Buyer:Party' AS labels, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, 'Party:Supplier', 'supply' FROM supplier
    """
)
def nodes_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label of several finds the nodes of every set of labels that holds it."""
    graph = _graph(spark)
    customers = _table(spark, sf_dir, "customer")
    suppliers = _table(spark, sf_dir, "supplier")
    parts = _table(spark, sf_dir, "part")
    graph.write_nodes(
        customers.selectExpr("c_custkey AS id", "c_mktsegment AS segment"), ":Party:Buyer"
    )
    graph.write_nodes(
        suppliers.selectExpr("s_suppkey AS id", "'supply' AS segment"), ":Party:Supplier"
    )
    graph.write_nodes(parts.selectExpr("p_partkey AS id"), ":Part")
    return graph.read_nodes(":Party").select("id", _labels(), "segment")


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM orders")
def relationships_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as relationships; both ends are merged as nodes."""
    graph = _graph(spark)
    orders = _table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority"
    )
    graph.write_relationships(orders, "PLACED", CUSTOMER, ORDER, "overwrite")
    return graph.read_relationships("PLACED").selectExpr(
        "`source.id` AS o_custkey",
        "`target.id` AS o_orderkey",
        "`rel.o_orderdate` AS o_orderdate",
        "`rel.o_orderpriority` AS o_orderpriority",
    )


@query(
    """
    SELECT l_partkey, l_suppkey, max(l_quantity) AS quantity, max(l_shipdate) AS shipped
    FROM lineitem GROUP BY l_partkey, l_suppkey
    """
)
def relationships_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One relationship per pair of nodes; the second write adds a property to each."""
    graph = _graph(spark)
    lines = _table(spark, sf_dir, "lineitem")
    part = NodePattern(":Part", "l_partkey:id", "overwrite")
    supplier = NodePattern(":Supplier", "l_suppkey:id", "overwrite")
    for column, name in (("l_quantity", "quantity"), ("l_shipdate", "shipped")):
        graph.write_relationships(
            lines.select("l_partkey", "l_suppkey", F.col(column).alias(name)),
            "SUPPLIED_BY",
            part,
            supplier,
            "overwrite",
        )
    return graph.read_edges("SUPPLIED_BY").selectExpr(
        "`source.id` AS l_partkey",
        "`target.id` AS l_suppkey",
        "`rel.quantity` AS quantity",
        "`rel.shipped` AS shipped",
    )


@query(
    """
    SELECT o_custkey, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'AUTOMOBILE'
    UNION ALL
    SELECT o_custkey, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'AUTOMOBILE' AND o_orderstatus = 'O'
    """
)
def relationships_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only customers that are nodes get relationships; appending adds to what is there.

    The order's customer comes as a DOUBLE and is matched in the node's own type.
    """
    graph = _graph(spark)
    customers = _table(spark, sf_dir, "customer").where("c_mktsegment = 'AUTOMOBILE'")
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS DOUBLE) AS o_custkey", "o_orderkey", "o_orderstatus"
    )
    graph.write_nodes(customers, ":Buyer", "c_custkey:id", "overwrite")
    known = NodePattern(":Buyer", "o_custkey:id")
    graph.write_relationships(orders, "PLACED", known, ORDER, "append")
    open_orders = orders.where("o_orderstatus = 'O'")
    graph.write_relationships(open_orders, "PLACED", known, ORDER, "append")
    return graph.read_edges("PLACED").selectExpr(
        "`source.id` AS o_custkey", "`target.id` AS o_orderkey"
    )


@query(
    """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice, o_orderdate,
           'Buyer:Party' AS labels
    FROM customer JOIN orders ON o_custkey = c_custkey
    """
)
def relationships_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relationships joined with the properties of the nodes at both ends."""
    graph = _graph(spark)
    orders = _table(spark, sf_dir, "orders")
    graph.write_nodes(
        _table(spark, sf_dir, "customer"), ":Buyer:Party", "c_custkey:id", "overwrite"
    )
    graph.write_nodes(
        orders.select("o_orderkey", "o_totalprice"), ":Order", "o_orderkey:id", "overwrite"
    )
    graph.write_relationships(
        orders.select("o_custkey", "o_orderkey", "o_orderdate"),
        "PLACED",
        NodePattern(":Buyer", "o_custkey:id"),
        NodePattern(":Order", "o_orderkey:id"),
        "overwrite",
    )
    return graph.read_relationships("PLACED", source_labels=":Party").select(
        F.col("`source.id`").alias("c_custkey"),
        F.col("`source.c_name`").alias("c_name"),
        F.col("`target.id`").alias("o_orderkey"),
        F.col("`target.o_totalprice`").alias("o_totalprice"),
        F.col("`rel.o_orderdate`").alias("o_orderdate"),
        _labels("<source.labels>"),
    )


@query("SELECT n_nationkey AS nation, n_regionkey AS region FROM nation UNION ALL SELECT n_nationkey, n_regionkey FROM nation")
def relationships_append_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends appended, twice: as many relationships as rows, each with nodes of its own write."""
    graph = _graph(spark)
    nations = _table(spark, sf_dir, "nation")
    ends = (NodePattern(":Nation", "n_nationkey:id", "append"), NodePattern(":Region", "n_regionkey:id", "append"))
    for _ in range(2):
        graph.write_relationships(nations, "LIES_IN", *ends, "append", properties=())
    return graph.read_relationships("LIES_IN").selectExpr("`source.id` AS nation", "`target.id` AS region")


@query("SELECT c_custkey AS customer, c_nationkey AS nation FROM customer")
def relationships_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type with customers and suppliers at its start, read for customers alone."""
    graph = _graph(spark)
    nation = ":Nation", "nation:id", "overwrite"
    for table, label, key in (("customer", ":Buyer", "c"), ("supplier", ":Supplier", "s")):
        frame = _table(spark, sf_dir, table)
        own = "c_custkey" if key == "c" else "s_suppkey"
        graph.write_relationships(
            frame.selectExpr(f"{own} AS id", f"{key}_nationkey AS nation"),
            "AT_HOME_IN",
            NodePattern(label, "id", "overwrite"),
            NodePattern(*nation),
            "overwrite",
        )
    found = graph.read_relationships("AT_HOME_IN", source_labels=":Buyer")
    return found.selectExpr("`source.id` AS customer", "`target.id` AS nation")


@query("SELECT c_custkey AS customer, c_nationkey AS nation, 'second' AS written FROM customer")
def relationships_other_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One relationship, though the second write names its start by another of its labels."""
    graph = _graph(spark)
    customers = _table(spark, sf_dir, "customer")
    graph.write_nodes(customers.selectExpr("c_custkey AS id"), ":Party:Buyer", "id", "overwrite")
    for label, written in ((":Buyer", "first"), (":Party", "second")):
        graph.write_relationships(
            customers.select("c_custkey", "c_nationkey", F.lit(written).alias("written")),
            "AT_HOME_IN",
            NodePattern(label, "c_custkey:id"),
            NodePattern(":Nation", "c_nationkey:id", "overwrite"),
            "overwrite",
        )
    return graph.read_relationships("AT_HOME_IN").selectExpr(
        "`source.id` AS customer", "`target.id` AS nation", "`rel.written` AS written"
    )


@query(
    """
    SELECT o_custkey AS customer, o_orderkey AS "order", o_orderstatus AS folder, 'b' || o_orderpriority AS new
    FROM orders
    """
)
def relationships_reserved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and properties with the names that the writer's own columns would like to have."""
    graph = _graph(spark)
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS a", "o_orderkey AS b", "o_orderstatus AS __folder", "concat('a', o_orderpriority) AS __new"
    )
    ends = NodePattern(":Buyer", "a:bucket", "overwrite"), NodePattern(":Order", "b:__key0", "overwrite")
    graph.write_relationships(orders, "PLACED", *ends, "overwrite")
    later = orders.withColumn("__new", F.expr("concat('b', substr(__new, 2))")).drop("__folder")
    graph.write_relationships(later, "PLACED", *ends, "overwrite")
    return graph.read_relationships("PLACED").selectExpr(
        "`source.bucket` AS customer", "`target.__key0` AS order", "`rel.__folder` AS folder", "`rel.__new` AS new"
    )


@query("SELECT DISTINCT l_partkey, l_suppkey, l_shipdate FROM lineitem")
def merge_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part)-[shipped {date}]->(supplier): two dates are two relationships.

    Merging the finished lines first changes nothing about the result.
    """
    graph = _graph(spark)
    lines = _table(spark, sf_dir, "lineitem")
    pattern = (
        "SHIPPED",
        NodePattern(":Part", "l_partkey:id"),
        NodePattern(":Supplier:Company", "l_suppkey:id"),
        "l_shipdate:date",
    )
    graph.merge_pattern(lines.where("l_linestatus = 'F'"), *pattern)
    graph.merge_pattern(lines, *pattern)
    return graph.read_edges("SHIPPED").selectExpr(
        "`source.id` AS l_partkey", "`target.id` AS l_suppkey", "`rel.date` AS l_shipdate"
    )


@query(
    """
    SELECT c_mktsegment AS segment, count(*) AS orders, count(DISTINCT c_custkey) AS customers,
           max(o_orderdate) AS last_order
    FROM customer JOIN orders ON o_custkey = c_custkey
    GROUP BY c_mktsegment ORDER BY orders DESC, segment LIMIT 3
    """
)
def graph_sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job's source may be a SQL query over a graph's nodes and relationships."""
    path = scratch(spark)
    graph = PropertyGraph(spark, path)
    graph.write_nodes(
        _table(spark, sf_dir, "customer"), ":Buyer", "c_custkey:id", "overwrite"
    )
    graph.write_relationships(
        _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"),
        "PLACED",
        NodePattern(":Buyer", "o_custkey:id"),
        ORDER,
        "overwrite",
    )
    sql = """
        SELECT c.c_mktsegment AS segment, count(*) AS orders,
               count(DISTINCT c.id) AS customers, max(r.`rel.o_orderdate`) AS last_order
        FROM {Buyer} c JOIN {PLACED} r ON r.`source.id` = c.id
        GROUP BY c.c_mktsegment ORDER BY orders DESC, segment LIMIT 3
    """
    return read(spark, Source("graph", {"path": path, "query": sql}))


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def table_to_graph_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs in the form of job files: a table into a graph, the graph into CSV."""
    path, csv = scratch(spark), scratch(spark)
    graph = {"path": path, "labels": ":Buyer:Party"}
    run_job(
        spark,
        JobConfig(
            source=parquet(
                sf_dir,
                "customer",
                columns=[
                    {"name": "c_custkey", "alias": "id"},
                    {"name": "c_name", "alias": "name"},
                ],
            ),
            target=Target("graph", {**graph, "node.keys": "id"}, "Overwrite"),
        ),
    )
    run_job(
        spark,
        JobConfig(
            source=Source("graph", graph, columns=["ID", "NAME"]),
            target=Target("csv", {"header": "true", "path": csv}, "Overwrite"),
        ),
    )
    back = Source("csv", {"header": "true", "path": csv}, columns=["CAST(id AS LONG) AS id", "name"])
    return read(spark, back)


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders")
def table_to_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relationship target in the form of a job file, read back by another source."""
    path = scratch(spark)
    run_job(
        spark,
        JobConfig(
            source=parquet(
                sf_dir,
                "orders",
                columns=["o_custkey", "o_orderkey", "o_orderdate"],
            ),
            target=Target(
                "graph",
                {
                    "path": path,
                    "relationship": "PLACED",
                    "relationship.save.strategy": "keys",
                    "relationship.source.save.mode": "Overwrite",
                    "relationship.source.labels": ":Buyer",
                    "relationship.source.node.keys": "o_custkey",
                    "relationship.target.save.mode": "Overwrite",
                    "relationship.target.labels": ":Order",
                    "relationship.target.node.keys": "o_orderkey",
                },
                "Overwrite",
            ),
        ),
    )
    source = Source(
        "graph",
        {"path": path, "relationship": "PLACED"},
        columns=[
            {"name": "`source.o_custkey`", "alias": "o_custkey"},
            {"name": "`target.o_orderkey`", "alias": "o_orderkey"},
            {"name": "`rel.o_orderdate`", "alias": "o_orderdate"},
        ],
    )
    return read(spark, source)


@query("SELECT DISTINCT l_suppkey, l_partkey, l_shipdate FROM lineitem")
def table_to_merged_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern to merge in the form of a job file: the date is part of the identity."""
    path = scratch(spark)
    run_job(
        spark,
        JobConfig(
            source=parquet(
                sf_dir,
                "lineitem",
                columns=["l_suppkey", "l_partkey", "l_shipdate"],
            ),
            target=Target(
                "graph",
                {
                    "path": path,
                    "relationship": "SHIPPED",
                    "relationship.keys": "l_shipdate:date",
                    "relationship.source.save.mode": "Overwrite",
                    "relationship.source.labels": ":Company:Supplier",
                    "relationship.source.node.keys": "l_suppkey:id",
                    "relationship.target.save.mode": "Overwrite",
                    "relationship.target.labels": ":Part",
                    "relationship.target.node.keys": "l_partkey:id",
                },
                "Overwrite",
            ),
        ),
    )
    source = Source(
        "graph",
        {
            "path": path,
            "relationship": "SHIPPED",
            "relationship.source.labels": ":Supplier",
        },
        columns=[
            {"name": "`source.id`", "alias": "l_suppkey"},
            {"name": "`target.id`", "alias": "l_partkey"},
            {"name": "`rel.date`", "alias": "l_shipdate"},
        ],
    )
    return read(spark, source)
