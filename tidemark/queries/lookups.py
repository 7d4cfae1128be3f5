"""Lookup queries: code tables, resolution with fallback, rates, snapshots, bands."""

from pyspark.sql import functions as F

from tidemark.functions import canonical_place, pad_code
from tidemark.operators.lookup import (
    band_column, code_table, coverage, enrich_by_code, enrich_by_place, latest_rows,
    latest_totals, place_codes, quantile_cuts, rates_by_code, resolve_code, unique_places)
from tidemark.queries.cleaning import SQL_CANONICAL
from tidemark.queries.registry import query, table
from tidemark.session import settle

# Reference places: every nation under its name, and a "capital" in every nation, which is not
# unique. Customers spell places with noise; some name the wrong region.
SQL_CODES = f"""
codes as (
  select place, region, max(code) as code from (
    select {SQL_CANONICAL.format(c="n_name")} as place,
      {SQL_CANONICAL.format(c="r_name")} as region,
      lpad(cast(n_nationkey as varchar), 5, '0') as code
    from nation join region on r_regionkey = n_regionkey
    union all
    select 'CAPITAL', {SQL_CANONICAL.format(c="r_name")},
      lpad(cast(n_nationkey + 100 as varchar), 5, '0')
    from nation join region on r_regionkey = n_regionkey)
  group by place, region),
only_places as (
  select place, max(code) as only_code from codes group by place
  having count(distinct code) = 1),
noisy as (
  select c_custkey, {SQL_CANONICAL.format(c='''case when c_custkey % 7 = 0 then 'Capital'
      when c_custkey % 3 = 0 then lower(n_name) || ' (D.C.)'
      when c_custkey % 11 = 0 then 'nowhere' else n_name end''')} as place,
    {SQL_CANONICAL.format(c='''case when c_custkey % 5 = 0 then 'wrong' else r_name end''')}
      as region
  from customer join nation on n_nationkey = c_nationkey
  join region on r_regionkey = n_regionkey)"""


def _nations(spark, sf):
    return table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))


def _codes(spark, sf):
    nations = _nations(spark, sf)
    named = nations.select("n_name", "r_name", F.col("n_nationkey").cast("string").alias("raw"))
    capitals = nations.select(F.lit("Capital").alias("n_name"), "r_name",
                              (F.col("n_nationkey") + 100).cast("string").alias("raw"))
    return code_table(named.unionByName(capitals), "n_name", "r_name", pad_code(F.col("raw")))


def _noisy_customers(spark, sf):
    return _spelled_customers(spark, sf).select(
        "c_custkey", canonical_place(F.col("raw_place")).alias("place"),
        canonical_place(F.col("raw_region")).alias("region"))


@query("code_table", f"with {SQL_CODES} select place, region, code from codes")
def code_table_query(spark, sf):
    return _codes(spark, sf)


@query("unique_places", f"with {SQL_CODES} select place, only_code from only_places")
def unique_places_query(spark, sf):
    return unique_places(_codes(spark, sf))


SQL_RESOLVED = SQL_CODES + """,
resolved as (
  select c_custkey, n.place, n.region, coalesce(c.code, u.only_code) as code
  from noisy n left join codes c on c.place = n.place and c.region = n.region
  left join only_places u on u.place = n.place)"""


@query("code_resolve", f"with {SQL_RESOLVED} select c_custkey, place, region, code from resolved")
def code_resolve(spark, sf):
    return resolve_code(_noisy_customers(spark, sf), settle(_codes(spark, sf), "codes"),
                        "place", "region")


def _spelled_customers(spark, sf):
    """As :func:`_noisy_customers`, with the raw spellings."""
    place = (F.when(F.col("c_custkey") % 7 == 0, "Capital")
             .when(F.col("c_custkey") % 3 == 0, F.concat(F.lower("n_name"), F.lit(" (D.C.)")))
             .when(F.col("c_custkey") % 11 == 0, "nowhere").otherwise(F.col("n_name")))
    region = F.when(F.col("c_custkey") % 5 == 0, "wrong").otherwise(F.col("r_name"))
    return (table(spark, sf, "customer")
            .join(_nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", place.alias("raw_place"), region.alias("raw_region")))


@query("place_codes", f"with {SQL_RESOLVED} select c_custkey, place, region, code from resolved")
def place_codes_query(spark, sf):
    """The same answer as code_resolve, worked out once per distinct spelling."""
    people = _spelled_customers(spark, sf)
    places = place_codes(people, "raw_place", "raw_region", settle(_codes(spark, sf), "codes"),
                         ("place", "region"))
    return enrich_by_place(people, places, "raw_place", "raw_region").select(
        "c_custkey", "place", "region", "code")


@query("code_coverage", f"""with {SQL_RESOLVED}
select count(*) as n_rows, count(code) as matched,
  round(avg(case when code is not null then 1.0 else 0.0 end), 9) as coverage from resolved""")
def code_coverage(spark, sf):
    resolved = code_resolve(spark, sf)
    return resolved.agg(F.count("*").alias("n_rows"), F.count("code").alias("matched"),
                        F.round(coverage(resolved, "code"), 9).alias("coverage"))


SQL_RATES = """
rates as (
  select lpad(cast(l_suppkey as varchar), 5, '0') as code,
    avg(try_cast(case when l_linenumber = 3 then 'x' else cast(l_quantity as varchar) end
      as double)) as mean_quantity,
    avg(round(l_discount * 100)) as mean_discount, count(*) as n_lines
  from lineitem group by 1)"""


def _supplier_rates(spark, sf):
    """Mean quantity (one line number holds no number) and discount per supplier code."""
    text = F.when(F.col("l_linenumber") == 3, "x").otherwise(F.col("l_quantity").cast("string"))
    lines = table(spark, sf, "lineitem").select("l_suppkey", text.alias("quantity_text"),
                                                F.round(F.col("l_discount") * 100).alias("percent"))
    return rates_by_code(lines, pad_code(F.col("l_suppkey").cast("string")),
                         {"mean_quantity": "quantity_text", "mean_discount": "percent"},
                         "n_lines")


@query("code_rates", f"""with {SQL_RATES}
select code, round(mean_quantity, 9) as mean_quantity, round(mean_discount, 9) as mean_discount,
  n_lines from rates""")
def code_rates(spark, sf):
    return _supplier_rates(spark, sf).select(
        "code", F.round("mean_quantity", 9).alias("mean_quantity"),
        F.round("mean_discount", 9).alias("mean_discount"), "n_lines")


@query("code_metrics", f"""with {SQL_RATES}
select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(mean_quantity, 9) as mean_quantity,
  n_lines
from lineitem left join rates r
  on case when r.mean_discount >= 5 then r.code else 'x' || r.code end
    = lpad(cast(l_suppkey as varchar), 5, '0')""")
def code_metrics(spark, sf):
    """Rates joined back on every line; suppliers of low discounts are known by another code."""
    other = F.when(F.col("mean_discount") >= 5, F.col("code")).otherwise(
        F.concat(F.lit("x"), "code"))
    rates = settle(_supplier_rates(spark, sf).withColumn("code", other), "rates")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        pad_code(F.col("l_suppkey").cast("string")).alias("supp_code"))
    return enrich_by_code(lines, rates, "supp_code").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round("mean_quantity", 9).alias("mean_quantity"), "n_lines")


SQL_SNAPSHOTS = """
snaps as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey,
    cast(nullif(year(l_shipdate), 2001) as integer) as y,
    cast(quarter(l_shipdate) as integer) as q, cast(l_quantity as bigint) as amount
  from lineitem where contains(l_returnflag, 'N')),
newest as (
  select * from snaps
  qualify dense_rank() over (partition by l_suppkey
    order by y desc nulls last, q desc nulls last) = 1)"""


def _snapshots(spark, sf):
    return (table(spark, sf, "lineitem").filter(F.col("l_returnflag").contains("N"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.nullif(F.year("l_shipdate"), F.lit(2001)).alias("y"),
                    F.quarter("l_shipdate").alias("q"),
                    F.col("l_quantity").cast("bigint").alias("amount")))


@query("latest_snapshot", f"""with {SQL_SNAPSHOTS}
select l_orderkey, l_linenumber, l_partkey, l_suppkey, y, q, amount from newest""")
def latest_snapshot(spark, sf):
    return latest_rows(_snapshots(spark, sf), "l_suppkey", ["y", "q"])


@query("latest_totals", f"""with {SQL_SNAPSHOTS}
select l_suppkey, cast(sum(amount) as bigint) as latest_total, max(y) as latest_y
from newest group by l_suppkey""")
def latest_totals_query(spark, sf):
    return latest_totals(_snapshots(spark, sf), "l_suppkey", ["y", "q"], "amount")


SQL_TOTALS = """
totals as (
  select case when o_custkey % 10 = 0 then -o_custkey else o_custkey end as o_custkey,
    cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents
  from orders group by 1),
cuts as (select quantile_disc(cents, 0.33) as c1, quantile_disc(cents, 0.66) as c2
         from totals where cents > 0)"""


def _totals(spark, sf):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    key = F.when(F.col("o_custkey") % 10 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    return (table(spark, sf, "orders").groupBy(key.alias("o_custkey"))
            .agg(F.sum(cents).alias("cents")))


@query("tercile_bands", f"""with {SQL_TOTALS}
select c_custkey, coalesce(cents, 0) as cents,
  cast(case when coalesce(cents, 0) = 0 then 0 when cents < c1 then 1 when cents < c2 then 2
  else 3 end as integer) as band
from customer left join totals on o_custkey = c_custkey, cuts""")
def tercile_bands(spark, sf):
    totals = settle(_totals(spark, sf), "totals")
    facts = enrich_by_code(table(spark, sf, "customer").select("c_custkey"), totals,
                           "c_custkey", "o_custkey")
    return band_column(facts, "cents", quantile_cuts(totals, "cents"))
