"""Profile and report queries over whole tables."""

from pyspark.sql import functions as F

from tidemark.functions import to_double
from tidemark.operators import profiles as P
from tidemark.queries.registry import (
    SQL_CUSTOMER_PANEL, SQL_PANEL, customer_panel, orders_panel, query, table)


@query("prevalence_by_period", f"""with {SQL_PANEL}
select t, count(*) as n, round(avg(cast(churned_next as double)), 9) as prevalence
from panel group by t""")
def prevalence_by_period(spark, sf):
    out = P.period_prevalence(orders_panel(spark, sf), "t", "churned_next")
    return out.withColumn("prevalence", F.round("prevalence", 9))


@query("period_profile", f"""with {SQL_PANEL}
select t, count(o_custkey) as n, count(distinct o_custkey) as entities,
  round(avg(cast(churned_next as double)), 9) as prevalence,
  avg(case when churned_next is null then 1.0 else 0.0 end) as censored
from panel group by t""")
def period_profile(spark, sf):
    out = P.period_profile(orders_panel(spark, sf), "t", "o_custkey", "churned_next")
    return out.withColumn("prevalence", F.round("prevalence", 9))


def _sql_null_rows(source: str, columns: dict[str, str]) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", '{kind}' as type, count(*) - count({c}) as nulls,
        round((count(*) - count({c})) * 100.0::double / count(*), 9) as null_pct from {source}"""
        for c, kind in columns.items())


@query("null_profile", """with holes as (
  select o_orderkey, nullif(o_orderstatus, 'F') as o_orderstatus,
    case when o_orderkey % 9 = 0 then null else o_totalprice end as o_totalprice, o_orderdate
  from orders) """ + _sql_null_rows("holes", {
      "o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
      "o_orderdate": "timestamp_ntz"}))
def null_profile(spark, sf):
    holes = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate")
    return P.null_profile(holes).withColumn("null_pct", F.round("null_pct", 9))


@query("value_counts", """select event_type, count(*) as n from events group by event_type""")
def value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "events"), "event_type")


@query("class_balance", f"""with {SQL_PANEL}
select churned_next, count(*) as n from panel group by churned_next""")
def class_balance(spark, sf):
    return P.value_counts(orders_panel(spark, sf), "churned_next")


@query("group_mean", """select lang, count(quality) as n, round(avg(quality), 9) as mean
from labels join documents using (doc_id) group by lang""")
def group_mean(spark, sf):
    rows = table(spark, sf, "labels").join(
        table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return P.group_mean(rows, "lang", "quality").withColumn("mean", F.round("mean", 9))


@query("histogram", """
with r as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi,
  (max(l_extendedprice) - min(l_extendedprice)) / 40.0::double as width from lineitem)
select bin, round(lo + bin * width, 6) as bin_from, n from (
  select cast(least(floor((l_extendedprice - lo) / width), 39) as integer) as bin,
    count(*) as n from lineitem, r group by 1), r""")
def histogram(spark, sf):
    out = P.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 40)
    return out.withColumn("bin_from", F.round("bin_from", 6))


@query("density_grid", """
with s as (select count(l_extendedprice) as n, stddev_samp(l_extendedprice) as sd,
  min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem),
k as (select *, (hi - lo) / 512.0::double as width, sd * pow(n, -0.2::double) as bw from s),
bins as (
  select cast(least(floor((l_extendedprice - lo) / width), 511) as integer) as bin,
    count(*) as c from lineitem, k group by 1),
grid as (
  select cast(i as integer) as point, lo - bw * 3.0 + i * ((hi - lo + bw * 6.0) / 199.0) as x
  from range(200) g(i), k)
select point, round(x, 4) as x, round(sum(c * exp(-0.5 * pow((x - (lo + (bin + 0.5) * width))
  / bw, 2)) / (n * bw * sqrt(2.0 * pi()))), 12) as density
from grid, bins, k group by point, x""")
def density_grid(spark, sf):
    out = P.density(table(spark, sf, "lineitem"), "l_extendedprice", 512, 200)
    return out.select("point", F.round("x", 4).alias("x"),
                      F.round("density", 12).alias("density"))


@query("box_summary", """
with q as (
  select l_returnflag, quantile_cont(l_extendedprice, 0.25) as q1,
    quantile_cont(l_extendedprice, 0.5) as median, quantile_cont(l_extendedprice, 0.75) as q3
  from lineitem group by l_returnflag)
select l_returnflag, count(*) as n_rows, round(max(q1), 6) as q1,
  round(max(median), 6) as median, round(max(q3), 6) as q3,
  min(l_extendedprice) filter (where l_extendedprice >= q1 - 1.5 * (q3 - q1)) as whisker_low,
  max(l_extendedprice) filter (where l_extendedprice <= q3 + 1.5 * (q3 - q1)) as whisker_high,
  count(*) filter (where l_extendedprice < q1 - 1.5 * (q3 - q1)
                      or l_extendedprice > q3 + 1.5 * (q3 - q1)) as outliers
from lineitem join q using (l_returnflag) group by l_returnflag""")
def box_summary(spark, sf):
    out = P.box_summary(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_matrix", " union all ".join(
    f"select '{a}' as col_a, '{b}' as col_b, round(corr({a}, {b}), 9) as r from lineitem"
    for a in NUMERIC for b in NUMERIC))
def corr_matrix(spark, sf):
    out = P.correlation_matrix(table(spark, sf, "lineitem"), NUMERIC)
    return out.withColumn("r", F.round("r", 9))


@query("top_categories", " union all ".join(
    f"""(select '{c}' as "column", cast({c} as varchar) as value, count(*) as n,
      cast(row_number() over (order by count(*) desc, cast({c} as varchar)) as integer)
        as position
    from part where {c} is not null group by {c}
    qualify position <= 7)""" for c in ("p_brand", "p_type", "p_name", "p_size")))
def top_categories(spark, sf):
    return P.top_categories(table(spark, sf, "part"), ["p_brand", "p_type", "p_name", "p_size"], 7)


@query("dataset_summary", f"""with {SQL_PANEL}
select count(*) as rows_total, count(churned_next) as rows_labelled,
  round(avg(cast(churned_next as double)), 9) as prevalence,
  count(distinct o_custkey) filter (where churned_next is not null) as n_entities from panel""")
def dataset_summary(spark, sf):
    out = P.dataset_summary(orders_panel(spark, sf), "o_custkey", "churned_next")
    return out.withColumn("prevalence", F.round("prevalence", 9))


@query("report_region", f"""with {SQL_CUSTOMER_PANEL}
select n_name, count(*) as entities, round(avg(cents), 9) as mean_balance,
  round(avg(stratum), 9) as mean_stratum, cast(sum(churned_next) as bigint) as churned
from cpanel where churned_next is not null group by n_name
order by entities desc, n_name limit 20""")
def report_region(spark, sf):
    rows = customer_panel(spark, sf)
    out = P.region_report(rows, "n_name", {
        "mean_balance": to_double(F.col("cents").cast("string")),
        "mean_stratum": F.col("stratum")}, "churned_next", 20)
    return out.withColumns({c: F.round(c, 9) for c in ("mean_balance", "mean_stratum")})


@query("report_coverage", f"""with {SQL_CUSTOMER_PANEL}
select t, count(o_custkey) as entities, count(nullif(stratum, 0.0)) as with_context,
  cast(round(cast(avg(cents) as decimal(18, 9)), 2) as double) as mean_context, count(churned_next) as labelled
from cpanel group by t""")
def report_coverage(spark, sf):
    rows = customer_panel(spark, sf).withColumn("stratum",
                                                F.nullif(F.col("stratum"), F.lit(0.0)))
    return P.coverage_report(rows, "t", "o_custkey", "stratum", "cents", "churned_next")


@query("report_top5", f"""with {SQL_CUSTOMER_PANEL}
select n_name, count(o_custkey) as entities, cast(round(cast(avg(cents) as decimal(18, 9)), 4) as double) as mean_value
from cpanel where stratum >= 1 group by n_name order by entities desc, n_name limit 5""")
def report_top5(spark, sf):
    rows = customer_panel(spark, sf).withColumn(
        "code", F.when(F.col("stratum") >= 1, F.col("stratum")))
    return P.top_places(rows, "n_name", "o_custkey", "code", "cents", 5)


@query("ranking", """select p_partkey, p_retailprice,
  row_number() over (order by p_retailprice desc, p_partkey) as ranking from part""")
def ranking(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return P.ranking(parts, "p_retailprice", "p_partkey")


@query("thinned", """
with r as (select event_id, value, row_number() over (order by value, event_id) as k,
  count(*) over () as n from events)
select event_id, value from r where (k - 1) % greatest(1, n // 200) = 0""")
def thinned(spark, sf):
    return P.thin(table(spark, sf, "events").select("event_id", "value"), ["value", "event_id"])


@query("seeded_sample", """select event_id, event_type, value from events
order by md5('42|' || cast(event_id as varchar)), event_id limit 5000""")
def seeded_sample(spark, sf):
    """A top-k by hash: the sample size is the feature."""
    return P.seeded_sample(table(spark, sf, "events").select("event_id", "event_type", "value"),
                           "event_id", 5000)


@query("display_sort", """
select p_partkey, nullif(p_size, 5) as size from part
order by size desc nulls last, p_partkey""")
def display_sort(spark, sf):
    return (table(spark, sf, "part")
            .select("p_partkey", F.nullif(F.col("p_size"), F.lit(5)).alias("size"))
            .orderBy(F.desc_nulls_last("size"), "p_partkey"))
