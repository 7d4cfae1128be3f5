"""Publication queries: trend, suppression, demographics, context, risk, indicators."""

from pyspark.sql import functions as F

from tidemark.functions import risk_band
from tidemark.operators.privacy import (
    current_risk, demographic_table, kpi_rows, period_trend, rate_gap, regional_context,
    suppress, suppressed_rates, churn_counts)
from tidemark.queries.registry import (
    SQL_COUNTS, SQL_CUSTOMER_PANEL, SQL_PANEL, customer_panel, orders_panel, query, sql_rate)
from tidemark.session import settle

ARGS = ("o_custkey", "churned_next")


@query("churn_rate_by_period", f"""with {SQL_PANEL},
g as (select t, {SQL_COUNTS} from panel group by t) {sql_rate("g")}""")
def churn_rate_by_period(spark, sf):
    return period_trend(orders_panel(spark, sf), ["t"], *ARGS)


@query("churn_counts", f"""with {SQL_CUSTOMER_PANEL}
select n_name, t, {SQL_COUNTS} from cpanel group by n_name, t""")
def churn_counts_query(spark, sf):
    return churn_counts(customer_panel(spark, sf), ["n_name", "t"], *ARGS)


def sql_suppressed(cells: str, child: str, parent: str | None, k: int = 10,
                   rates: bool = True) -> str:
    """The ordered-prefix form of the rule, as a check of the aggregate form in the library."""
    over = f"partition by {parent}" if parent else ""
    head = f"{parent}, " if parent else ""
    body = f"""
ranked as (
  select *, row_number() over (w order by enrolled, {child} nulls first) as i,
    count(*) filter (where enrolled < {k}) over w as n_small,
    coalesce(sum(enrolled) over (w order by enrolled, {child} nulls first
      rows between unbounded preceding and 1 preceding), 0) as before
  from {cells} window w as ({over})),
placed as (
  select *, n_small > 0 and (i <= n_small or i <= 2 or before < {k}) as moved from ranked),
merged as (
  select {head}case when moved then 'OTROS' else {child} end as {child},
    cast(sum(enrolled) as bigint) as enrolled, cast(sum(evaluable) as bigint) as evaluable,
    cast(sum(churned) as bigint) as churned
  from placed group by {head}moved, case when moved then 'OTROS' else {child} end)"""
    return body + (sql_rate("merged") if rates else " select * from merged")


@query("suppress_flat", f"""with {SQL_CUSTOMER_PANEL},
cells as (select cast(balance_band as varchar) as band, {SQL_COUNTS} from cpanel group by 1),
{sql_suppressed("cells", "band", None)}""")
def suppress_flat(spark, sf):
    rows = customer_panel(spark, sf).withColumn("band", F.col("balance_band").cast("string"))
    return suppressed_rates(rows, ["band"], *ARGS)


@query("suppress_nested", f"""with {SQL_CUSTOMER_PANEL},
cells as (select n_name, c_mktsegment, {SQL_COUNTS} from cpanel group by 1, 2),
{sql_suppressed("cells", "c_mktsegment", "n_name")}""")
def suppress_nested(spark, sf):
    return suppressed_rates(customer_panel(spark, sf), ["n_name", "c_mktsegment"], *ARGS)


@query("suppress_null_child", f"""with {SQL_CUSTOMER_PANEL},
cells as (select nullif(r_name, 'ASIA') as region, nullif(c_mktsegment, 'BUILDING') as segment,
    {SQL_COUNTS} from cpanel where r_name <> 'ASIA' group by 1, 2),
{sql_suppressed("cells", "segment", "region", 60, False)}""")
def suppress_null_child(spark, sf):
    """A higher threshold, null children kept, null parents dropped."""
    rows = customer_panel(spark, sf).select(
        *ARGS, F.nullif(F.col("r_name"), F.lit("ASIA")).alias("region"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    cells = churn_counts(rows, ["region", "segment"], *ARGS)
    return suppress(cells, "segment", ["region"], min_cell=60)


@query("suppress_numeric_child", f"""with {SQL_CUSTOMER_PANEL},
cells as (select n_name, cast(balance_band as varchar) as band, {SQL_COUNTS} from cpanel
          group by 1, 2),
{sql_suppressed("cells", "band", "n_name")}""")
def suppress_numeric_child(spark, sf):
    """A child of numbers: it is published as text, beside the merged label."""
    rows = customer_panel(spark, sf).select(*ARGS, "n_name", F.col("balance_band").alias("band"))
    return suppressed_rates(rows, ["n_name", "band"], *ARGS)


SQL_TIDY = """
tidy as (
  select 'c_mktsegment' as dimension, coalesce(nullif(c_mktsegment, 'BUILDING'), 'SIN DATO')
    as category, o_custkey, churned_next from cpanel
  union all select 'stratum', cast(stratum as varchar), o_custkey, churned_next from cpanel
  union all select 'r_name', r_name, o_custkey, churned_next from cpanel),
tcells as (select dimension, category, """ + SQL_COUNTS + """ from tidy group by 1, 2),
"""
SQL_DEMOGRAPHICS = SQL_TIDY + sql_suppressed("tcells", "category", "dimension", rates=False
                                             ).replace(" select * from merged", "")


def _demographics(panel):
    rows = panel.withColumn(
        "c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return demographic_table(rows, ["c_mktsegment", "stratum", "r_name"], *ARGS)


@query("demographics_tidy",
       f"with {SQL_CUSTOMER_PANEL}, {SQL_DEMOGRAPHICS} {sql_rate('merged')}")
def demographics_tidy(spark, sf):
    return _demographics(customer_panel(spark, sf))


@query("region_context", f"""with {SQL_CUSTOMER_PANEL},
ctx as (
  select n_name, {SQL_COUNTS}, avg(cents) as cents, avg(stratum) as stratum,
    avg(case when code is not null then 1.0 else 0.0 end) as coverage
  from (select *, case when length(n_name) > 8 or o_custkey % 3 = 0 then o_custkey end as code
        from cpanel) group by n_name having count(distinct o_custkey) >= 10),
rated as ({sql_rate("ctx")})
select n_name, enrolled, evaluable, churned, churn_pct, low_confidence,
  case when coverage >= 0.5 then round_even(cents * 10000.0::double, 0) / 10000.0 end as cents,
  case when coverage >= 0.5 then round_even(stratum * 10000.0::double, 0) / 10000.0 end as stratum from rated""")
def region_context(spark, sf):
    rows = customer_panel(spark, sf).withColumn(
        "code", F.when((F.length("n_name") > 8) | (F.col("o_custkey") % 3 == 0),
                       F.col("o_custkey")))
    return regional_context(rows, "n_name", *ARGS, "code", ["cents", "stratum"])


SQL_SCORED = """
scored as (
  select *, (o_custkey * 37 + t * 11) % 1024 / 1024.0::double as score, 'H' || t as label,
    case when (o_custkey * 37 + t * 11) % 1024 / 1024.0::double >= 0.7 then 'alto'
         when (o_custkey * 37 + t * 11) % 1024 / 1024.0::double >= 0.35 then 'medio'
         else 'bajo' end as band from cpanel)"""


def _scored(panel):
    score = ((F.col("o_custkey") * 37 + F.col("t") * 11) % 1024) / F.lit(1024.0)
    return panel.withColumns({
        "score": score, "label": F.concat(F.lit("H"), F.col("t").cast("string"))}).withColumn(
        "band", risk_band(F.col("score"), 0.7))


SQL_RISK = SQL_SCORED + """,
risk as (
  select r_name, c_mktsegment, count(distinct o_custkey) as n_entities,
    count(*) filter (where band = 'alto') as n_high, round_even(avg(score) * 10000.0::double, 0) / 10000.0 as mean_score,
    max(label) as label
  from scored where t = (select max(t) from scored) group by 1, 2
  having count(distinct o_custkey) >= 10)"""


def _risk(panel):
    scored = settle(_scored(panel).select("o_custkey", "t", "band", "score", "label", "r_name",
                                              "c_mktsegment"), "scored")
    return current_risk(scored.select("o_custkey", "t", "band", "score", "label"),
                        scored.select("o_custkey", "t", "r_name", "c_mktsegment"),
                        "o_custkey", "t", ["r_name", "c_mktsegment"], "label")


@query("risk_by_group", f"""with {SQL_CUSTOMER_PANEL}, {SQL_RISK}
select *, case when n_high = 0 or n_high = n_entities then null
    else round_even(cast(n_high as double) / n_entities * 100.0 * 100.0, 0) / 100.0 end
    as high_pct, (n_high = 0 or n_high = n_entities) as low_confidence from risk""")
def risk_by_group(spark, sf):
    return _risk(customer_panel(spark, sf))


@query("band_counts", f"""with {SQL_CUSTOMER_PANEL}, {SQL_SCORED}
select band, count(*) as n from scored group by band""")
def band_counts(spark, sf):
    return _scored(customer_panel(spark, sf)).groupBy("band").agg(F.count("*").alias("n"))


SQL_GAP = """
gap as (select round_even((
    cast(sum(churned) filter (where category in ('0.0', '1.0')) as double)
      / sum(evaluable) filter (where category in ('0.0', '1.0')) * 100.0
    - cast(sum(churned) filter (where category in ('3.0', '4.0')) as double)
      / sum(evaluable) filter (where category in ('3.0', '4.0')) * 100.0) * 100.0, 0) / 100.0
    as gap from merged where dimension = 'stratum')"""


@query("rate_gap", f"with {SQL_CUSTOMER_PANEL}, {SQL_DEMOGRAPHICS}, {SQL_GAP} select gap from gap")
def rate_gap_query(spark, sf):
    tidy = settle(_demographics(customer_panel(spark, sf)), "tidy")
    gap = rate_gap(tidy, "stratum", ["0.0", "1.0"], ["3.0", "4.0"])
    return tidy.agg(F.max(gap).alias("gap"))


@query("kpi_list", f"""with {SQL_CUSTOMER_PANEL}, {SQL_DEMOGRAPHICS}, {SQL_GAP}, {SQL_RISK},
base as (select cast(sum(churned_next) as double) / count(churned_next) * 100.0 as pct
         from panel)
select 'tasa_desercion' as id, round_even(pct * 100.0, 0) / 100.0 as value from base
union all select 'tasa_retencion', round_even((100.0 - pct) * 100.0, 0) / 100.0 from base
union all select 'matricula_ultimo_semestre', cast(count(distinct o_custkey) as double)
  from panel where t = (select max(t) from panel)
union all select 'brecha_estrato', gap from gap
union all select 'riesgo_alto', cast(sum(n_high) as double) from risk""")
def kpi_list(spark, sf):
    panel = settle(customer_panel(spark, sf), "panel")  # stored once, as the gold table is
    trend = settle(period_trend(panel, ["t"], *ARGS), "trend")
    tidy = settle(_demographics(panel), "tidy")
    gap = rate_gap(tidy, "stratum", ["0.0", "1.0"], ["3.0", "4.0"])
    high = _risk(panel).agg(F.sum("n_high")).scalar()
    return kpi_rows(trend, "t", {"brecha_estrato": gap}, {"riesgo_alto": high})
