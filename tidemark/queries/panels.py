"""Panel queries: target, history, de-duplication, priority pick, calendar."""

from pyspark.sql import functions as F

from tidemark.operators.panel import (
    attach_calendar, attach_panel, dedup_by_key, pick_per_period, rank_of, unknown_periods,
    with_entity_history, with_panel_columns)
from tidemark.queries.registry import (
    SQL_ORDERS_T, SQL_PANEL, orders_panel, orders_t, query, table)
from tidemark.sources.tables import literal_rows


@query("churn_target", f"with {SQL_PANEL} select o_custkey, t, next_t, churned_next from panel")
def churn_target(spark, sf):
    return orders_panel(spark, sf).select("o_custkey", "t", "next_t", "churned_next")


@query("panel_history", f"""with {SQL_PANEL}
select o_custkey, t, periods_so_far, gap_since_previous, is_first_period from panel""")
def panel_history(spark, sf):
    return orders_panel(spark, sf).select("o_custkey", "t", "periods_so_far",
                                          "gap_since_previous", "is_first_period")


@query("panel_attach", f"""with {SQL_PANEL}
select o_orderkey, o.o_custkey, o.t, churned_next, periods_so_far
from orders_t o left join panel p on p.o_custkey = o.o_custkey and p.t = o.t""")
def panel_attach(spark, sf):
    facts = orders_t(spark, sf).select("o_orderkey", "o_custkey", "t")
    panel = orders_panel(spark, sf).select("o_custkey", "t", "churned_next", "periods_so_far")
    return attach_panel(facts, panel, "o_custkey", "t")


def _monthly(spark, sf):
    """Orders folded to one row per customer and month (ordinal from January 1995)."""
    month = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")
    rows = orders_t(spark, sf).select("o_custkey", "t", month.alias("m"), "o_orderkey",
                                      "o_totalprice")
    return dedup_by_key(rows, ["o_custkey", "m"], [F.col("o_orderkey")])


SQL_MONTHLY = SQL_ORDERS_T + """,
monthly as (
  select o_custkey, t, m, o_orderkey, o_totalprice from (
    select o_custkey, t, o_orderkey, o_totalprice,
      cast((year(o_orderdate) - 1995) * 12 + month(o_orderdate) as integer) as m
    from orders_t)
  qualify row_number() over (partition by o_custkey, m order by o_orderkey) = 1)"""


@query("panel_columns_on_fact", f"""with {SQL_PANEL}, x as (
  select o_custkey, t, o_orderkey,
    cast((year(o_orderdate) - 1995) * 12 + month(o_orderdate) as integer) as m from orders_t
  qualify row_number() over (partition by o_custkey, m order by o_orderkey) = 1)
select x.o_custkey, m, x.t, o_orderkey, next_t, churned_next, periods_so_far,
  gap_since_previous, is_first_period
from x join panel p on p.o_custkey = x.o_custkey and p.t = x.t""")
def panel_columns_on_fact(spark, sf):
    fact = _monthly(spark, sf).drop("o_totalprice")
    last = orders_t(spark, sf).agg(F.max("t")).scalar()
    return with_panel_columns(fact, "o_custkey", "t", last)


@query("entity_history", f"""with {SQL_MONTHLY}
select o_custkey, m, t, o_orderkey, count(o_custkey) over w as total_periods,
  min(m) over w as first_t, max(m) over w as last_t,
  cast(count(o_custkey) over w as double) / (max(m) over w - min(m) over w + 1)
    as presence_ratio
from monthly window w as (partition by o_custkey)""")
def entity_history(spark, sf):
    return with_entity_history(_monthly(spark, sf).drop("o_totalprice"), "o_custkey", "m")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


@query("period_pick", f"""with {SQL_ORDERS_T}
select o_custkey, t, o_orderkey, o_orderpriority, o_orderdate,
  count(*) over (partition by o_custkey, t) as n_in_period
from orders_t
qualify row_number() over (partition by o_custkey, t order by
  case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3
  else 4 end, o_orderdate, o_orderkey) = 1""")
def period_pick(spark, sf):
    rows = orders_t(spark, sf).select("o_custkey", "t", "o_orderkey", "o_orderpriority",
                                      "o_orderdate")
    return pick_per_period(rows, "o_custkey", "t",
                           [rank_of(F.col("o_orderpriority"), PRIORITIES), F.col("o_orderdate"),
                            F.col("o_orderkey")])


@query("dedup_rows", """
select user_id, event_type, event_id, ts, value, props from events
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""")
def dedup_rows(spark, sf):
    """The newest event per user and type."""
    return dedup_by_key(table(spark, sf, "events"), ["user_id", "event_type"],
                        [F.col("ts"), F.col("event_id")], keep="last")


@query("distinct_pairs", "select distinct o_custkey, o_orderstatus from orders")
def distinct_pairs(spark, sf):
    return table(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()


CALENDAR = [(f"H{1 + i % 2}-{1996 + i // 2}", 1996 + i // 2, i + 1) for i in range(10)]
SQL_CALENDAR = ("calendar(code, year_no, half_no) as (values "
                + ", ".join(f"('{c}', {y}, {o})" for c, y, o in CALENDAR) + ")")
SQL_CODED = """coded as (
  select o_orderkey, o_custkey,
    'H' || case when month(o_orderdate) > 6 then '2' else '1' end || '-'
    || cast(year(o_orderdate) as varchar) as code from orders)"""


def _coded(spark, sf):
    half = F.when(F.month("o_orderdate") > 6, "2").otherwise("1")
    code = F.concat(F.lit("H"), half, F.lit("-"), F.year("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", code.alias("code"))


def _calendar(spark):
    return literal_rows(spark, CALENDAR, "code string, year_no int, half_no int")


@query("calendar_join", f"""with {SQL_CALENDAR}, {SQL_CODED}
select code, o_orderkey, o_custkey, year_no, half_no from coded join calendar using (code)""")
def calendar_join(spark, sf):
    return attach_calendar(_coded(spark, sf), _calendar(spark), "code")


@query("unknown_periods", f"""with {SQL_CALENDAR}, {SQL_CODED}
select code, count(*) as n_rows from coded
where code not in (select code from calendar) group by code""")
def dropped_periods(spark, sf):
    return unknown_periods(_coded(spark, sf), _calendar(spark), "code")
