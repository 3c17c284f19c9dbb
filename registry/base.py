"""Registration of queries and their SQL checks, and the views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

AS_OF = "2002-01-01 00:00:00"


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL check when there is one."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(col: Column | str, digits: int = 6) -> Column:
    """Round at the query edge; adding zero turns -0.0 into 0.0."""
    return F.round(F.col(col) if isinstance(col, str) else col, digits) + F.lit(0.0)


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in cols})


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: numbers, categories, dates and columns with gaps."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    per_customer = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("o_totalprice").alias("total_spend"),
        F.avg("o_totalprice").alias("avg_order"),
        F.max("o_totalprice").alias("max_order"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.min("o_orderdate").alias("first_order_date"),
        F.max("o_orderdate").alias("last_order_date"),
    )
    key, balance, segment = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    return customer.join(per_customer, customer.c_custkey == per_customer.o_custkey, "left").select(
        key.alias("row_id"),
        segment.alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
        balance.alias("acctbal"),
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.coalesce("total_spend", F.lit(0.0)).alias("total_spend"),
        F.col("avg_order"),
        F.coalesce("max_order", F.lit(0.0)).alias("max_order"),
        F.coalesce("n_urgent", F.lit(0)).alias("n_urgent"),
        F.col("first_order_date"),
        F.col("last_order_date"),
        F.when(key % 20 == 0, balance).alias("mostly_missing"),
        F.when(key % 10 != 0, balance).alias("acctbal_gaps"),
        F.when(key % 13 != 0, segment).alias("segment_gaps"),
        F.col("c_name").alias("high_card"),
        F.lit(3.0).alias("constant_col"),
    )


# The same view for the SQL side.
FEATURES = """
features AS (
SELECT c.c_custkey AS row_id, c.c_mktsegment AS segment, c.c_nationkey AS nation_key, c.c_acctbal AS acctbal,
       CAST(COALESCE(o.n_orders, 0) AS BIGINT) AS n_orders, COALESCE(o.total_spend, CAST(0 AS DOUBLE)) AS total_spend,
       o.avg_order AS avg_order, COALESCE(o.max_order, CAST(0 AS DOUBLE)) AS max_order,
       CAST(COALESCE(o.n_urgent, 0) AS BIGINT) AS n_urgent,
       o.first_order_date AS first_order_date, o.last_order_date AS last_order_date,
       CASE WHEN c.c_custkey % 20 <> 0 THEN NULL ELSE c.c_acctbal END AS mostly_missing,
       CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE c.c_acctbal END AS acctbal_gaps,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE c.c_mktsegment END AS segment_gaps,
       c.c_name AS high_card, CAST(3.0 AS DOUBLE) AS constant_col
FROM customer c LEFT JOIN (
  SELECT o_custkey, COUNT(*) AS n_orders, SUM(o_totalprice) AS total_spend, AVG(o_totalprice) AS avg_order,
         MAX(o_totalprice) AS max_order, SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_urgent,
         MIN(o_orderdate) AS first_order_date, MAX(o_orderdate) AS last_order_date
  FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey)
"""

NUMBERS = ["acctbal", "n_orders", "total_spend", "avg_order", "max_order", "n_urgent", "acctbal_gaps"]


def facts(spark: SparkSession, **values) -> DataFrame:
    """(fact, value): what must hold for a result that SQL cannot compute itself."""
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "fact string, value double")


def facts_sql(**values) -> str:
    """The same facts in SQL; each value is a number or a scalar query."""
    return union_all([f"SELECT '{k}' AS fact, ({v})::DOUBLE AS value" for k, v in values.items()])


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def hash_sql(key: str, seed: int = 42) -> str:
    """The pseudo-random row order, as SQL."""
    first = f"(((({key}) % 2147483647) * 1583458089 + {seed * 1103515245 % 2147483647}) % 2147483647)"
    return f"((xor({first}, {first} >> 15) * 742938285) % 2147483647)"
