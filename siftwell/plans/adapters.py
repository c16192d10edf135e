"""The tables of the driver seen as the admissions domain; the same text serves both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def adm(spark: SparkSession, d: str) -> DataFrame:
    """Admission facts: school = supplier, major = part, province = the supplier's nation, year = the order's."""
    o = t(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("yr"), F.col("o_orderpriority").alias("batch"))
    s = t(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("province"))
    # suppliers first: they are few, and a province's leave few items to meet the orders
    li = t(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return li.select(
        F.col("l_suppkey").alias("school_id"), F.col("l_partkey").alias("major_id"), "province", "yr", "batch",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("subject"),
        F.when(F.col("l_quantity") >= 5, F.floor(F.col("l_extendedprice") / 100).cast("bigint")).alias("min_score"),
        F.when(F.col("l_quantity") <= 45, F.col("l_orderkey") % 5000 + 1).alias("min_rank"),
        F.col("l_quantity").cast("bigint").alias("plan_count"), F.col("l_linestatus").alias("origin"),
        F.col("l_orderkey").alias("k1"), F.col("l_linenumber").cast("bigint").alias("k2"),
    )


def plan(spark: SparkSession, d: str, year: int = 2000) -> DataFrame:
    """Enrollment plans: the facts of one year; odd keys lack a major id, every seventh its subject."""
    return adm(spark, d).filter(F.col("yr") == year).withColumn("plan_major", F.when(F.col("k1") % 10 != 0, F.col("major_id")))


ADM = """
adm AS (
  SELECT l_suppkey AS school_id, l_partkey AS major_id, CAST(s_nationkey AS BIGINT) AS province, CAST(year(o_orderdate) AS BIGINT) AS yr, o_orderpriority AS batch,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS subject,
    CASE WHEN l_quantity >= 5 THEN CAST(floor(l_extendedprice / 100) AS BIGINT) END AS min_score,
    CASE WHEN l_quantity <= 45 THEN l_orderkey % 5000 + 1 END AS min_rank,
    CAST(l_quantity AS BIGINT) AS plan_count, l_linestatus AS origin, l_orderkey AS k1, CAST(l_linenumber AS BIGINT) AS k2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
plan AS (SELECT *, CASE WHEN k1 % 10 <> 0 THEN major_id END AS plan_major FROM adm WHERE yr = 2000)
"""
