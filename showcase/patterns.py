"""Patterns over several relationships, rounds without shared nodes, buckets, late rows and removals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from showcase.registry import parquet, query, scratch
from sluiceway import JobConfig, NodePattern, Partition, PropertyGraph, Source, Target, read, run_job


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tree(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """Every customer below that of a quarter of its number; the first is its own parent."""
    graph = PropertyGraph(spark, scratch(spark))
    parents = _table(spark, sf_dir, "customer").selectExpr("c_custkey AS child", "c_custkey DIV 4 AS parent")
    ends = NodePattern(":Buyer", "child:id", "overwrite"), NodePattern(":Buyer", "parent:id", "overwrite")
    graph.write_relationships(parents, "BELOW", *ends, "overwrite")
    return graph


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 0 AS shared FROM lineitem")
def relationships_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relationships in rounds: all rows, each with the number of other tasks of its round that wrote one of its nodes.

    Rounds and tasks are told by the names of the files they left.
    """
    path, ends = scratch(spark), ("l_partkey", "l_suppkey")
    columns = ["l_orderkey", "l_linenumber", *ends]
    rounds = Partition(6, grid=ends)
    run_job(
        spark,
        JobConfig(
            source=parquet(sf_dir, "lineitem", columns=columns, partition=rounds),
            target=Target("parquet", {"path": path}, "overwrite"),
        ),
    )
    name = F.col("_metadata.file_name")
    rows = spark.read.parquet(path).select(
        "*",
        F.regexp_extract(name, r"^part-(\d+)-", 1).alias("task"),
        F.regexp_extract(name, r"^part-\d+-([0-9a-f-]{36})", 1).alias("round"),
    )
    for end in ends:
        # most nodes have one task, so the others are written first, and rows need no shuffle to meet them
        touched = rows.groupBy("round", end).agg((F.count_distinct("task") - 1).alias(f"{end}_others"))
        several, place = touched.where(f"{end}_others > 0"), scratch(spark)
        several.write.parquet(place)
        rows = rows.join(spark.read.schema(several.schema).parquet(place), ["round", end], "left")
    others = (F.coalesce(f"{end}_others", F.lit(0)) for end in ends)
    return rows.select(*columns, sum(others, F.lit(0)).alias("shared"))


@query(
    """
    WITH RECURSIVE above AS (
        SELECT c_custkey AS child, c_custkey // 4 AS parent FROM customer
        UNION SELECT a.child, c.c_custkey // 4 FROM above a JOIN customer c ON c.c_custkey = a.parent)
    SELECT child, parent FROM above
    """
)
def graph_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ancestors of every node, over a cycle at the root."""
    rows = _tree(spark, sf_dir).reach("BELOW")
    return rows.selectExpr("`source.id` AS child", "`target.id` AS parent")


@query(
    """
    WITH RECURSIVE above AS (
        SELECT c_custkey AS child, c_custkey // 4 AS parent, 1 AS hops FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT a.child, a.parent // 4, a.hops + 1 FROM above a WHERE a.hops < 3)
    SELECT child, parent, min(hops) AS hops FROM above GROUP BY child, parent
    """
)
def graph_reach_few_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From some nodes, at most three relationships far, and how far."""
    starts = _table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("c_custkey AS id")
    rows = _tree(spark, sf_dir).reach("BELOW", starts, hops=3)
    return rows.selectExpr("`source.id` AS child", "`target.id` AS parent", "hops")


@query(
    """
    WITH RECURSIVE above AS (
        SELECT c_custkey AS child, c_custkey // 4 AS parent, 1 AS depth FROM customer WHERE c_custkey > 0
        UNION ALL SELECT a.child, a.parent // 4, a.depth + 1 FROM above a WHERE a.parent > 0)
    SELECT child, max(depth) AS depth FROM above GROUP BY child
    """
)
def graph_recursive_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recursive SQL query over relationships: how deep each node lies."""
    return _tree(spark, sf_dir).query(
        """
        WITH RECURSIVE above(child, parent, depth) AS (
            SELECT `source.id`, `target.id`, 1 FROM {BELOW} WHERE `source.id` <> `target.id`
            UNION ALL
            SELECT a.child, b.`target.id`, a.depth + 1 FROM above a JOIN {BELOW} b ON b.`source.id` = a.parent
            WHERE b.`source.id` <> b.`target.id` AND a.depth < 60)
        SELECT child, max(depth) AS depth FROM above GROUP BY child
        """
    )


@query(
    """
    WITH pairs AS (
        SELECT DISTINCT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b
        FROM lineitem WHERE l_partkey <> l_suppkey)
    SELECT x.a AS node, count(*) AS triangles
    FROM pairs x JOIN pairs y ON y.a = x.b JOIN pairs z ON z.a = x.a AND z.b = y.b GROUP BY x.a
    """
)
def graph_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles by their first node, where parts and suppliers with one number are one node."""
    graph = PropertyGraph(spark, scratch(spark))
    ends = NodePattern(":Item", "l_partkey:id", "overwrite"), NodePattern(":Item", "l_suppkey:id", "overwrite")
    lines = _table(spark, sf_dir, "lineitem")
    graph.write_relationships(lines, "MEETS", *ends, "overwrite", properties=())
    found = graph.triangles("MEETS")
    return found.groupBy(F.col("first.id").alias("node")).agg(F.count("*").alias("triangles"))


@query(
    """
    SELECT c_custkey AS id, upper(c_name) AS name, c_acctbal * 2 AS balance,
           CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS segment
    FROM customer
    """
)
def nodes_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``nodes_upsert``, into a table in buckets, which the second batch does not shuffle."""
    graph = PropertyGraph(spark, scratch(spark))
    customers = _table(spark, sf_dir, "customer")
    some = customers.where("c_acctbal > 5000")
    first = some.selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    graph.write_nodes(first, ":Buyer", "id", "overwrite", buckets=8)
    later = customers.selectExpr("c_custkey AS id", "upper(c_name) AS name", "c_acctbal * 2 AS balance")
    graph.write_nodes(later, ":Buyer", "id", "overwrite")
    return graph.read_nodes(":Buyer").select("id", "name", "balance", "segment")


@query(
    """
    SELECT user_id, ts, event_type, event_id, rounds.n AS written FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
        (VALUES (1), (2)) rounds(n)
    WHERE rn = 1
    """
)
def nodes_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches in both orders give the same table: rows that arrive late change nothing."""
    events = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    batches = [events.where("event_type < 'm'"), events.where("event_type >= 'm'")]
    tables = []
    for n, ordered in enumerate((batches, batches[::-1]), 1):
        graph = PropertyGraph(spark, scratch(spark))
        for batch in ordered:
            graph.write_nodes(batch, ":User", "user_id", "overwrite", ["ts", "event_id"], newest=True)
        tables.append(graph.read_nodes(":User").withColumn("written", F.lit(n)))
    found = tables[0].unionByName(tables[1])
    return found.select("user_id", "ts", "event_type", "event_id", "written")


@query(
    """
    SELECT o_custkey AS customer, o_orderkey AS "order" FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey) AND c_mktsegment <> 'BUILDING'
    UNION ALL
    SELECT c_custkey, NULL FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey) AND c_mktsegment <> 'BUILDING'
    """
)
def nodes_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes removed by two batches of event rows, the second a job's; the nodes and relationships that are left."""
    path = scratch(spark)
    graph = PropertyGraph(spark, path)
    customers, suppliers = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "supplier")
    graph.write_nodes(customers, ":Buyer", "c_custkey:id", "overwrite")
    ends = NodePattern(":Buyer", "o_custkey:id"), NodePattern(":Order", "o_orderkey:id", "overwrite")
    graph.write_relationships(_table(spark, sf_dir, "orders"), "PLACED", *ends, "overwrite", properties=())
    graph.delete_nodes(suppliers, ":Buyer", "s_suppkey:id")
    run_job(
        spark,
        JobConfig(
            source=parquet(sf_dir, "customer", where="c_mktsegment = 'BUILDING'", columns=["c_custkey"]),
            target=Target("graph", {"path": path, "labels": ":Buyer", "node.keys": "c_custkey:id", "delete": "detach"}),
        ),
    )
    placed = graph.read_relationships("PLACED").selectExpr("`source.id` AS customer", "`target.id` AS order")
    return placed.unionByName(graph.read_nodes(":Buyer").selectExpr("id AS customer", "CAST(NULL AS LONG) AS order"))


@query(
    """
    SELECT DISTINCT l_partkey, l_suppkey, l_shipdate FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_partkey = l.l_partkey
                      AND r.l_suppkey = l.l_suppkey AND r.l_shipdate = l.l_shipdate)
    """
)
def relationships_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relationships of pairs and dates that were returned are removed; their nodes stay."""
    graph = PropertyGraph(spark, scratch(spark))
    lines = _table(spark, sf_dir, "lineitem")
    ends = NodePattern(":Part", "l_partkey:id"), NodePattern(":Supplier", "l_suppkey:id")
    graph.merge_pattern(lines, "SHIPPED", *ends, "l_shipdate:date")
    graph.delete_relationships(lines.where("l_returnflag = 'R'"), "SHIPPED", *ends, "l_shipdate:date")
    return graph.read_relationships("SHIPPED").selectExpr(
        "`source.id` AS l_partkey", "`target.id` AS l_suppkey", "`rel.date` AS l_shipdate"
    )


@query(
    """
    SELECT c_custkey AS id, c_name AS name,
           CASE WHEN c_custkey NOT IN (SELECT s_suppkey FROM supplier) THEN c_acctbal END AS balance
    FROM customer
    """
)
def nodes_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One property of the nodes that rows name is cleared; keys without a node add none."""
    path = scratch(spark)
    graph = PropertyGraph(spark, path)
    customers = _table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    graph.write_nodes(customers, ":Buyer", "id", "overwrite")
    options = {"path": path, "labels": ":Buyer", "node.keys": "s_suppkey:id", "clear": "balance"}
    run_job(spark, JobConfig(source=parquet(sf_dir, "supplier"), target=Target("graph", options)))
    return read(spark, Source("graph", {"path": path, "labels": ":Buyer"}, columns=["id", "name", "balance"]))
