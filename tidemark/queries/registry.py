"""Registered queries: a name, the Spark query and, where SQL can say it, the SQL to check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.panel import churn_panel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def half_year(date: Column) -> Column:
    """Half-year ordinal, 1 for the first half of 1995."""
    return (F.year(date) - 1995) * 2 + F.when(F.month(date) > 6, 2).otherwise(1)


def orders_t(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("t", half_year(F.col("o_orderdate")))


def orders_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by half-year with target and history."""
    return churn_panel(orders_t(spark, sf), "o_custkey", "t")


def customer_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The panel with customer attributes: segment, nation, region, balance and its bands."""
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    profile = (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
               .select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "n_name", "r_name",
                       "c_acctbal", F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"),
                       F.floor(F.col("c_acctbal") / 100).cast("int")
                       .alias("balance_band"),
                       F.floor(F.col("c_acctbal") / 2500).cast("double").alias("stratum")))
    return orders_panel(spark, sf).join(profile, "o_custkey")


SQL_ORDERS_T = """
orders_t as (
  select *, cast((year(o_orderdate) - 1995) * 2
            + case when month(o_orderdate) > 6 then 2 else 1 end as integer) as t
  from orders)"""

SQL_PANEL = SQL_ORDERS_T + """,
panel as (
  select o_custkey, t,
    lead(t) over w as next_t,
    cast(case when t >= (select max(t) from orders_t) then null
              when lead(t) over w is null then 1
              when lead(t) over w = t + 1 then 0 else 1 end as integer) as churned_next,
    row_number() over w as periods_so_far,
    t - lag(t) over w as gap_since_previous,
    cast(case when lag(t) over w is null then 1 else 0 end as integer) as is_first_period
  from (select distinct o_custkey, t from orders_t)
  window w as (partition by o_custkey order by t))"""

SQL_CUSTOMER_PANEL = SQL_PANEL + """,
cpanel as (
  select p.*, c_mktsegment, n_name, r_name, c_acctbal,
    cast(round(c_acctbal * 100) as bigint) as cents,
    cast(floor(c_acctbal / 100) as integer) as balance_band,
    cast(floor(c_acctbal / 2500) as double) as stratum
  from panel p join customer on c_custkey = o_custkey
  join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey)"""


def sql_rate(source: str) -> str:
    """Rate columns over ``enrolled, evaluable, churned`` in SQL."""
    return f"""
  select *, case when churned = 0 or churned = evaluable then null
     else round_even(cast(churned as double) / cast(evaluable as double) * 100.0 * 100.0, 0)
          / 100.0 end as churn_pct,
     (churned = 0 or churned = evaluable or evaluable < 30) as low_confidence
  from {source}"""


SQL_COUNTS = """count(distinct o_custkey) as enrolled, count(churned_next) as evaluable,
    cast(coalesce(sum(churned_next), 0) as bigint) as churned"""
