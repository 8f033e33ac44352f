"""Registration of queries, and the driver tables seen as an experiment catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from expatlas.scratch import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query by its function's name, with the DuckDB SQL that says the same."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def bridge(spark: SparkSession, d: str) -> DataFrame:
    """Orders as items of customers."""
    return table(spark, d, "orders").select(F.col("o_custkey").alias("group_id"), F.col("o_orderkey").alias("item_id"), F.col("o_totalprice").alias("libsize"))


def counts(spark: SparkSession, d: str) -> DataFrame:
    """Parts sold by suppliers as a long count table."""
    lines = table(spark, d, "lineitem")
    return lines.groupBy(F.col("l_suppkey").alias("group_id"), F.col("l_partkey").alias("feature_id")).agg(F.sum("l_quantity").cast("long").alias("count"))


def lengths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("feature_id"), F.col("p_size").cast("long").alias("length"))


#: The same views in SQL, to begin a WITH clause.
BRIDGE = "bridge AS (SELECT o_custkey AS group_id, o_orderkey AS item_id, o_totalprice AS libsize FROM orders)"
COUNTS = "counts AS (SELECT l_suppkey AS group_id, l_partkey AS feature_id, CAST(sum(l_quantity) AS BIGINT) AS count FROM lineitem GROUP BY ALL)"
LENGTHS = "lengths AS (SELECT p_partkey AS feature_id, CAST(p_size AS BIGINT) AS length FROM part)"
