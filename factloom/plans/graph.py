"""The driver's tables seen as a temporal knowledge graph.

Suppliers, parts and customers are entities; every line item is a dated fact from its supplier to its
part, valid from the order's date to the shipping date; orders are episodes that mention their parts;
market segments are communities of customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entities(spark: SparkSession, d: str) -> DataFrame:
    """uuid, name, group_id, labels, summary, ord (position of creation)."""
    part = table(spark, d, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("uuid"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("group_id"),
        F.array(F.lit("Entity"), F.col("p_type")).alias("labels"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand", F.repeat(F.lit("x"), F.col("p_size"))).alias("summary"),
        F.col("p_partkey").alias("ord"),
    )
    supplier = table(spark, d, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("uuid"),
        F.col("s_name").alias("name"),
        F.lit("supply").alias("group_id"),
        F.array(F.lit("Entity"), F.lit("Company")).alias("labels"),
        F.lit(None).cast("string").alias("summary"),
        F.col("s_suppkey").alias("ord"),
    )
    return part.unionByName(supplier)


def links(spark: SparkSession, d: str) -> DataFrame:
    """Facts without dates, from line items alone: uuid, src, dst, name, group_id."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("uuid"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"),
        F.col("l_returnflag").alias("name"),
        F.col("l_linestatus").alias("group_id"),
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("episode"),
    )


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Dated facts: uuid, src, dst, name, episode, valid_at, invalid_at, created_at, expired_at, days."""
    li, orders = table(spark, d, "lineitem"), table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    joined = li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("uuid"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"),
        F.col("l_returnflag").alias("name"),
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("episode"),
        F.col("o_orderdate").alias("valid_at"),
        F.col("l_shipdate").alias("invalid_at"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("expired_at"),
    )


def mentions(spark: SparkSession, d: str) -> DataFrame:
    """episode, entity: orders and the parts on them (with repeats)."""
    return links(spark, d).select("episode", F.col("dst").alias("entity"))


#: The same tables in SQL, for oracles.
SQL = {
    "entities": """SELECT 'p' || p_partkey AS uuid, p_name AS name, p_brand AS group_id, p_type AS label,
  p_name || ' ' || p_type || ' ' || p_brand || ' ' || repeat('x', p_size) AS summary, p_partkey AS ord FROM part
  UNION ALL SELECT 's' || s_suppkey, s_name, 'supply', 'Company', NULL, s_suppkey FROM supplier""",
    "links": """SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS uuid, 's' || l_suppkey AS src, 'p' || l_partkey AS dst,
  l_returnflag AS name, l_linestatus AS group_id, 'o' || l_orderkey AS episode FROM lineitem""",
    "facts": """SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS uuid, 's' || l_suppkey AS src, 'p' || l_partkey AS dst,
  l_returnflag AS name, 'o' || l_orderkey AS episode, o_orderdate AS valid_at, l_shipdate AS invalid_at, o_orderdate AS created_at, l_shipdate AS expired_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "mentions": "SELECT 'o' || l_orderkey AS episode, 'p' || l_partkey AS entity FROM lineitem",
}


def with_sql(body: str, *names: str) -> str:
    """A query over the graph's tables: the ones named are put in front."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + "\n" + body.strip()
