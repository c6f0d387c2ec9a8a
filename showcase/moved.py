"""What jobs move: rows that cannot be cast, counts, and jobs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from showcase.registry import parquet, query, scratch
from sluiceway import JobConfig, Target, run_job, run_jobs


SIGN = "substr(o_orderpriority, if(o_orderstatus = 'O', 1, 2), 1)"


@query(
    f"""
    SELECT o_orderkey, TRY_CAST(sign AS INTEGER) AS code,
           CASE WHEN TRY_CAST(sign AS INTEGER) IS NULL
                THEN 'code: cannot cast {SIGN.replace("'", "''")} to INT: ' || sign END AS reason
    FROM (SELECT o_orderkey, substr(o_orderpriority, CASE o_orderstatus WHEN 'O' THEN 1 ELSE 2 END, 1) AS sign FROM orders)
    """
)
def rows_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad rows together are the source: a priority's first character is a number, its second is not."""
    good, bad = scratch(spark), scratch(spark)
    columns = ["o_orderkey", {"name": f"CAST({SIGN} AS INT)", "alias": "code"}]
    run_job(
        spark,
        JobConfig(
            source=parquet(sf_dir, "orders", columns=columns),
            target=Target("parquet", {"path": good}),
            rejected=Target("parquet", {"path": bad}),
        ),
    )
    taken = spark.read.parquet(good).selectExpr("o_orderkey", "code", "CAST(NULL AS STRING) AS reason")
    return taken.unionByName(spark.read.parquet(bad).selectExpr("o_orderkey", "CAST(NULL AS INT) AS code", "reason"))


@query(
    """
    SELECT count(*) AS "read", count(*) FILTER (l_quantity > 25) AS kept, count(*) FILTER (l_quantity > 25) AS written
    FROM lineitem
    """
)
def job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a job says it has read, kept and written."""
    source = parquet(sf_dir, "lineitem", where="l_quantity > 25", columns=["l_orderkey"])
    counts = run_job(spark, JobConfig(source=source, target=Target("parquet", {"path": scratch(spark)})), counts=True)
    return spark.createDataFrame([counts], "read long, kept long, written long")


@query("SELECT n_name AS name, 'nation' AS kind FROM nation UNION ALL SELECT c_name, 'customer' FROM customer")
def jobs_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs at once, and a third that waits for both and appends to the place of one."""
    nations, customers = scratch(spark), scratch(spark)
    jobs = [
        JobConfig(source=parquet(sf_dir, "nation", columns=["n_name AS name", "'nation' AS kind"]), target=Target("parquet", {"path": nations})),
        JobConfig(source=parquet(sf_dir, "customer", columns=["c_name AS name", "'customer' AS kind"]), target=Target("parquet", {"path": customers})),
    ]
    jobs.append(JobConfig(source={"format": "parquet", "options": {"path": nations}}, target=Target("parquet", {"path": customers}, "append")))
    run_jobs(spark, jobs, together=2)
    return spark.read.parquet(customers)
