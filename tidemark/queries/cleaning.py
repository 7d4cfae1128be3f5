"""Cleaning queries: names, codes, categories, numbers, nulls, reshaping."""

from pyspark.sql import functions as F

from tidemark.functions import (
    band_by_cuts, canonical_place, clean_category, half_even, half_up, homologate,
    keep_categories, label_or_missing, normalize_columns, null_unless, pad_code, rename_map,
    risk_band, to_double, to_long)
from tidemark.operators.reshape import melt
from tidemark.queries.registry import query, table
from tidemark.sources.reports import split_lines
from tidemark.sources.tables import with_gold_audit, with_silver_audit

# the sharp s has a two-letter capital, which DuckDB's upper() leaves out
SQL_CANONICAL = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  translate(upper(replace(trim({c}, ' '), 'ß', 'SS')),
            'ÁÉÍÓÚÜÑÀÈÌÒÙÂÊÎÔÛ', 'AEIOUUNAEIOUAEIOU'),
  '\([^)]*\)', ' ', 'g'), '[^A-Z0-9 ]', ' ', 'g'),
  '\b(D C|DC|DISTRITO)\b', ' ', 'g'), '\s+', ' ', 'g'))"""


@query("geo_normalize", f"""
select doc_id, {SQL_CANONICAL.format(c="text")} as canonical from documents""")
def geo_normalize(spark, sf):
    """Canonical spelling of whole texts in four languages."""
    return table(spark, sf, "documents").select("doc_id",
                                                canonical_place(F.col("text")).alias("canonical"))


@query("geo_normalize_names", f"""
select s_suppkey, {SQL_CANONICAL.format(c='''case s_suppkey % 4
    when 0 then ' bogotá, d.c. ' || s_name when 1 then 'Güicán (antiguo) ' || s_name
    when 2 then s_name || '  DISTRITO nuevo' else 'Öpera-' || s_name end''')} as canonical
from supplier""")
def geo_normalize_names(spark, sf):
    s = F.col("s_name")
    noisy = (F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit(" bogotá, d.c. "), s))
             .when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("Güicán (antiguo) "), s))
             .when(F.col("s_suppkey") % 4 == 2, F.concat(s, F.lit("  DISTRITO nuevo")))
             .otherwise(F.concat(F.lit("Öpera-"), s)))
    return table(spark, sf, "supplier").select("s_suppkey",
                                               canonical_place(noisy).alias("canonical"))


@query("code_pad", """select p_partkey, lpad(trim(cast(p_partkey * 97 as varchar)), 5, '0') as code
from part""")
def code_pad(spark, sf):
    raw = (F.col("p_partkey") * 97).cast("string")
    return table(spark, sf, "part").select("p_partkey", pad_code(raw).alias("code"))


@query("numeric_coerce", r"""
select event_id, try_cast(regexp_extract(props, '(\d+)', 1) as double) as k,
  try_cast(event_type as double) as bad,
  try_cast(case when event_id % 3 = 0 then 'x' else cast(event_id as varchar) end as bigint)
    as maybe from events""")
def numeric_coerce(spark, sf):
    mixed = F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("event_id").cast("string"))
    return table(spark, sf, "events").select(
        "event_id", to_double(F.regexp_extract("props", r"(\d+)", 1)).alias("k"),
        to_double(F.col("event_type")).alias("bad"), to_long(mixed).alias("maybe"))


@query("substring_filter", "select doc_id, n_chars from documents where contains(text, 'tion')")
def substring_filter(spark, sf):
    return (table(spark, sf, "documents").filter(F.col("text").contains("tion"))
            .select("doc_id", "n_chars"))


@query("homologate", """
select o_orderkey, case when o_orderpriority like '%URG%' then 'top'
  when o_orderpriority like '%HIGH%' then 'top' when o_orderpriority like '4-%' then 'none'
  else o_orderpriority end as priority from orders""")
def homologate_priority(spark, sf):
    rules = [("%URG%", "top"), ("%HIGH%", "top"), ("4-%", "none")]
    return table(spark, sf, "orders").select(
        "o_orderkey", homologate(F.col("o_orderpriority"), rules).alias("priority"))


@query("category_clean", """
with c as (select p_partkey, upper(trim(coalesce(nullif(' ' || lower(p_type) || ' ', ' promo '),
  'DESCONOCIDO'))) as category from part)
select p_partkey, category, case when category in ('ECONOMY', 'SMALL', 'DESCONOCIDO')
  then category else 'OTRO' end as kept from c""")
def category_clean(spark, sf):
    raw = F.nullif(F.concat(F.lit(" "), F.lower("p_type"), F.lit(" ")), F.lit(" promo "))
    cleaned = table(spark, sf, "part").select("p_partkey", clean_category(raw).alias("category"))
    return cleaned.withColumn("kept", keep_categories(F.col("category"),
                                                      ["ECONOMY", "SMALL", "DESCONOCIDO"]))


@query("rounding", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round_even(l_extendedprice * l_discount * 100.0, 0) / 100.0 as even2,
  round_even(l_quantity / 8.0 * 10.0, 0) / 10.0 as even1,
  cast(round(cast(l_extendedprice as decimal(18, 2)) * cast(l_discount as decimal(4, 2)), 2)
    as double) as up2
from lineitem""")
def rounding(spark, sf):
    price, share = F.col("l_extendedprice"), F.col("l_discount")
    exact = price.cast("decimal(18,2)") * share.cast("decimal(4,2)")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        half_even(price * share, 2).alias("even2"),
        half_even(F.col("l_quantity") / 8, 1).alias("even1"),
        half_up(exact, 2).cast("double").alias("up2"))


@query("null_rules", """
with n as (select o_orderkey, nullif(o_orderstatus, 'P') as status,
  nullif(o_orderpriority, '5-LOW') as priority,
  case when o_orderkey % 7 = 0 then null else o_totalprice end as price from orders)
select o_orderkey, coalesce(status, priority) as first_known, coalesce(price, 0.0) as filled,
  case when status = 'O' then price end as only_open,
  coalesce(status, 'SIN DATO') as status_label
from n where priority is not null""")
def null_rules(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"))
    kept = rows.dropna(subset=["priority"])
    return kept.withColumns({
        "first_known": F.coalesce("status", "priority"),
        "only_open": null_unless(F.col("status") == "O", F.col("price")),
        "status_label": label_or_missing(F.col("status"))}).withColumnRenamed(
        "price", "filled").fillna(0, subset=["filled"]).select(
        "o_orderkey", "first_known", "filled", "only_open", "status_label")


@query("membership_filters", """
select o_orderkey, o_orderstatus, o_orderpriority from orders
where o_orderstatus is not null and o_orderstatus <> 'P'
  and o_orderpriority in ('1-URGENT', '5-LOW')""")
def membership_filters(spark, sf):
    return (table(spark, sf, "orders")
            .filter(F.col("o_orderstatus").isNotNull() & (F.col("o_orderstatus") != "P"))
            .filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
            .select("o_orderkey", "o_orderstatus", "o_orderpriority"))


@query("column_names", """
select r_regionkey as ano_academico_1, r_name as region_n from region""")
def column_names(spark, sf):
    raw = table(spark, sf, "region").toDF("  Año Académico (1)", "_Región  Nº_")
    return normalize_columns(raw)


@query("dictionary_rename", """
select l_orderkey as order_code, l_linenumber as line_no, l_partkey, l_quantity as amount
from lineitem""")
def dictionary_rename(spark, sf):
    names = {"l_orderkey": "order_code", "l_linenumber": "line_no", "l_quantity": "amount",
             "absent_column": "never"}
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                               "l_quantity")
    return rename_map(rows, names)


@query("audit_columns", """
select n_nationkey, 'nations' as silver_source, 'run-1' as silver_run_id, 'run-2' as gold_run_id,
  true as stamped from nation""")
def audit_columns(spark, sf):
    rows = with_gold_audit(with_silver_audit(table(spark, sf, "nation"), "nations", "run-1"),
                           "run-2")
    return normalize_columns(rows).select(
        "n_nationkey", "silver_source", "silver_run_id", "gold_run_id",
        (F.col("silver_processed_at").isNotNull() & F.col("gold_processed_at").isNotNull())
        .alias("stamped"))


@query("log_transform", """
select event_id, round(ln(1 + value), 9) as log_value,
  round(ln(1 + nullif(user_id, 0)), 9) as log_user from events""")
def log_transform(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.round(F.log1p("value"), 9).alias("log_value"),
        F.round(F.log1p(F.nullif(F.col("user_id"), F.lit(0))), 9).alias("log_user"))


@query("banding", """
select event_id, cast(case when floor(value) = 0 then 0 when floor(value) < 5 then 1
  when floor(value) < 20 then 2 else 3 end as integer) as band,
  case when value >= 30 then 'alto' when value >= 15 then 'medio' else 'bajo' end as risk
from events""")
def banding(spark, sf):
    cuts = F.array(F.lit(5), F.lit(20))
    return table(spark, sf, "events").select(
        "event_id", band_by_cuts(F.floor("value"), cuts).alias("band"),
        risk_band(F.col("value"), 30.0).alias("risk"))


@query("melt_wide", """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, measure, amount from (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount,
    nullif(l_tax, 0.0) as l_tax from lineitem)
unpivot include nulls (amount for measure in (l_quantity, l_discount, l_tax))""")
def melt_wide(spark, sf):
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    wide = table(spark, sf, "lineitem").select(
        *ids, "l_quantity", "l_discount", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"))
    return melt(wide, ids, "measure", "amount")


@query("text_lines", r"""
select doc_id, cast(unnest(range(len(lines))) as integer) as line_no, unnest(lines) as line
from (select doc_id, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) as lines
      from documents)""")
def text_lines(spark, sf):
    return split_lines(table(spark, sf, "documents"), "doc_id", "text")
