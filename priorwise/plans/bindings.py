"""How the supplied tables play the operators' roles.

Orders are claims: key, entity (the customer), date and a binary target.
Order lines, one per (order, line number), are the event history; customer
months summed from them are the monthly facts; parts and suppliers the
dimensions.  Amounts are whole cents, so sums are exact.  Each frame has the
same relation as a SQL common table expression below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from priorwise.operators.bridges import tasks_for


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("claim_key"), F.col("o_custkey").alias("entity_key"), F.to_date("o_orderdate").alias("claim_date"),
        (F.col("o_orderstatus") == "F").cast("int").alias("target"), F.col("o_orderpriority").alias("priority"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("total_cents"),
    )


ANCHORS = """
anchors AS (
  SELECT o_orderkey AS claim_key, o_custkey AS entity_key, CAST(o_orderdate AS DATE) AS claim_date,
         CAST(o_orderstatus = 'F' AS INTEGER) AS target, o_orderpriority AS priority,
         CAST(round(o_totalprice * 100) AS BIGINT) AS total_cents
  FROM orders
)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt by order once: lines of an order are grouped, and joined to it, where they are
    li = table(spark, sf_dir, "lineitem")
    tasks = tasks_for(li)
    li = li.withColumn("l_shipdate", F.to_date("l_shipdate")).repartition(tasks, "l_orderkey")
    grouped = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_shipdate").alias("event_date"), F.min("l_partkey").alias("part_key"), F.min("l_suppkey").alias("supp_key"),
        F.sum(F.col("l_quantity").cast("long")).alias("qty"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"),
        F.max(F.round(F.col("l_discount") * 100).cast("long")).alias("discount_pct"), (F.max("l_returnflag") == "R").alias("returned"), F.min("l_linestatus").alias("line_status"),
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("entity_key")).repartition(tasks, "o_orderkey")
    return grouped.join(o, grouped["l_orderkey"] == o["o_orderkey"]).select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("event_key"), F.col("l_orderkey").alias("order_key"), "entity_key",
        "event_date", "part_key", "supp_key", "qty", "cents", "discount_pct", "returned", "line_status",
    )


LINES = """
lines AS (
  SELECT l_orderkey * 100 + l_linenumber AS event_key, l_orderkey AS order_key, any_value(o_custkey) AS entity_key,
         CAST(min(l_shipdate) AS DATE) AS event_date, min(l_partkey) AS part_key, min(l_suppkey) AS supp_key,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
         max(CAST(round(l_discount * 100) AS BIGINT)) AS discount_pct, max(l_returnflag) = 'R' AS returned, min(l_linestatus) AS line_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY l_orderkey, l_linenumber
)"""


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months_of(lines(spark, sf_dir))


def months_of(order_lines: DataFrame) -> DataFrame:
    x = order_lines.withColumn("month_start", F.trunc("event_date", "month"))
    g = x.groupBy("entity_key", "month_start").agg(F.sum("qty").alias("qty"), F.sum("cents").alias("cents"), F.max("discount_pct").alias("discount_pct"), F.count(F.lit(1)).alias("n_lines"))
    return g.withColumn("month_key", F.col("entity_key") * 100000 + F.year("month_start") * 12 + F.month("month_start"))


MONTHS = """
months AS (
  SELECT entity_key, CAST(date_trunc('month', event_date) AS DATE) AS month_start,
         CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(cents) AS BIGINT) AS cents, max(discount_pct) AS discount_pct, count(*) AS n_lines,
         entity_key * 100000 + year(min(event_date)) * 12 + month(min(event_date)) AS month_key
  FROM lines GROUP BY entity_key, date_trunc('month', event_date)
)"""


def installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return installs_of(lines(spark, sf_dir), spark, sf_dir)


def installs_of(x: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("system"), F.col("p_brand").alias("category"), F.col("p_size").alias("life"))
    return x.join(p, x["part_key"] == p["p_partkey"], "left").drop("p_partkey")


INSTALLS = """
installs AS (
  SELECT lines.*, p_type AS system, p_brand AS category, p_size AS life FROM lines LEFT JOIN part ON part_key = p_partkey
)"""

CLAIM = ("claim_key", "entity_key", "claim_date")
EVENT = ("entity_key", "event_date")


def ctes(*parts: str) -> str:
    """WITH clause of the named relations."""
    return "WITH " + ",".join(parts)
