"""Source and sink queries: a table is written in a raw form, read back and compared."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.privacy import period_trend
from tidemark.operators.reshape import melt
from tidemark.functions import homologate
from tidemark.queries.registry import (
    SQL_COUNTS, SQL_PANEL, orders_panel, query, sql_rate, table)
from tidemark.session import fresh_path, settle
from tidemark.sources import (
    clean_export, ensure_database, existing_table, export_audit, mirror, page_audit, publish,
    read_delimited, read_json_array, read_pages, read_partitioned, read_published, read_report,
    read_wide_csv, register_table, route_datasets, sql_sample, with_file_key, write_gold,
    write_scores, write_silver)
from tidemark.streaming import pick_up_new_files


@query("csv_roundtrip", """select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus,
  o_orderpriority, o_totalprice, cast(year(o_orderdate) as varchar) as file_year from orders""")
def csv_roundtrip(spark, sf):
    path = fresh_path(spark, "csv")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.year("o_orderdate").alias("y"))
    (rows.write.option("header", True).option("sep", ";").partitionBy("y").csv(path))
    back = with_file_key(read_delimited(spark, f"{path}/*/*.csv", file_column="file"),
                         r"/y=(\d+)/", "file_year", "file")
    return back.select("o_orderkey", "o_orderstatus", "o_orderpriority",
                       F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
                       "file_year")


@query("csv_layouts", """select cast(o_orderkey as varchar) as o_orderkey,
  o_orderstatus, case when o_orderstatus <> 'O' then cast(o_custkey as varchar) end as o_custkey,
  case when o_orderstatus = 'P' then 'extra' end as note from orders""")
def csv_layouts(spark, sf):
    """Files whose columns differ in order and number are united by name."""
    path, orders = fresh_path(spark, "layouts"), table(spark, sf, "orders")
    layouts = {"F": ["o_orderkey", "o_orderstatus", "o_custkey"],
               "O": ["o_orderstatus", "o_orderkey"],
               "P": ["note", "o_custkey", "o_orderkey", "o_orderstatus"]}
    for status, columns in layouts.items():
        (orders.filter(F.col("o_orderstatus") == status).withColumn("note", F.lit("extra"))
         .select(*columns).write.option("sep", ";").option("header", True)
         .csv(f"{path}/{status}"))
    return read_delimited(spark, f"{path}/*/*.csv").select(
        "o_orderkey", "o_orderstatus", "o_custkey", "note")


@query("csv_quoted_header", """select cast(o_orderkey as varchar) as o_orderkey,
  o_orderstatus as "status; short", cast(o_custkey as varchar) as o_custkey from orders
union all select 'o_orderkey', 'status; short', 'o_custkey'""")
def csv_quoted_header(spark, sf):
    """A separator inside a quoted header cell; a row that equals the header stays a row."""
    path, orders = fresh_path(spark, "quoted"), table(spark, sf, "orders")
    names = ["o_orderkey", "status; short", "o_custkey"]
    rows = orders.select(*[F.col(c).cast("string").alias(n) for c, n in zip(
        ("o_orderkey", "o_orderstatus", "o_custkey"), names)])
    echo = orders.limit(1).select(*[F.lit(n).alias(n) for n in names])
    rows.unionByName(echo).write.option("sep", ";").option("header", True).option(
        "quoteAll", True).csv(path)
    return read_delimited(spark, path).select(*[F.col(f"`{n}`") for n in names])


PAGE_KEYS = 2_000  # order keys per page, which bounds a page file
FILE_KEYS = 50_000  # keys per report or export file
ORDER_SCHEMA = "o_orderkey string, o_custkey string, o_totalprice double"


def _write_pages(spark, sf, path):
    """Orders as page files, each with one JSON array; the page after the last is empty."""
    record = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                                F.col("o_custkey").cast("string").alias("o_custkey"),
                                "o_totalprice"))
    orders = table(spark, sf, "orders").withColumn(
        "block", F.floor(F.col("o_orderkey") / PAGE_KEYS))
    cut = F.floor((F.row_number().over(Window.partitionBy("block").orderBy("o_orderkey")) - 1)
                  / PAGE_KEYS)  # keys may repeat: a page ends after so many rows
    pages = (orders.withColumn("page", F.concat_ws("-", "block", cut)).groupBy("page")
             .agg(F.concat(F.lit("["), F.concat_ws(",\n", F.collect_list(record)), F.lit("]"))
                  .alias("value")))
    empty = spark.range(1).select(F.lit("[]").alias("value"))
    # a file per row, all in one folder: tasks name and move their files themselves, while a folder
    # per page would be made, moved and listed one by one on the driver
    (pages.select("value").unionByName(empty).write.option("maxRecordsPerFile", 1)
     .option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path))


@query("json_roundtrip", """select cast(o_orderkey as varchar) as o_orderkey,
  cast(o_custkey as varchar) as o_custkey, o_totalprice from orders""")
def json_roundtrip(spark, sf):
    path = fresh_path(spark, "json")
    _write_pages(spark, sf, path)
    return read_json_array(spark, path, ORDER_SCHEMA)


@query("pages_union", """select cast(o_orderkey as varchar) as o_orderkey, o_totalprice
from orders""")
def pages_union(spark, sf):
    path = fresh_path(spark, "pages")
    _write_pages(spark, sf, path)
    return read_pages(spark, path, ORDER_SCHEMA).select("o_orderkey", "o_totalprice")


@query("pages_audit", f"""select count(*) as n_records from orders
group by o_orderkey // {PAGE_KEYS}""")
def pages_audit(spark, sf):
    """Records per page file; the empty page has none."""
    path = fresh_path(spark, "pages")
    _write_pages(spark, sf, path)
    pages = read_pages(spark, path, ORDER_SCHEMA)
    return page_audit(pages).select("n_records")


@query("dataset_routing", """
select 'gobierno_internet_fijo' as routed, cast(o_orderkey as varchar) as o_orderkey from orders
where o_orderstatus = 'F'
union all select 'gobierno_sisben_iv', cast(o_orderkey as varchar) from orders
where o_orderstatus = 'O'""")
def dataset_routing(spark, sf):
    """A dataset folder per order status at different depths, of which one has an id outside the
    map and is skipped."""
    root = fresh_path(spark, "routing")
    orders = table(spark, sf, "orders")
    record = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("o_orderkey")))
    for status, key in (("F", "2025-01/n48w-gutb"), ("O", "hq2v-5umk"), ("P", "a/b/zzzz-0000")):
        (orders.filter(F.col("o_orderstatus") == status)
         .groupBy(F.floor(F.col("o_orderkey") / PAGE_KEYS).alias("page"))
         .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(record)), F.lit("]"))
              .alias("value")).select("value")
         .write.option("maxRecordsPerFile", 1).text(f"{root}/{key}.json"))
    routed = route_datasets(spark, root, {
        "gobierno_internet_fijo": "o_orderkey string", "gobierno_sisben_iv": "o_orderkey string"})
    parts = [df.select(F.lit(name).alias("routed"), "o_orderkey") for name, df in routed.items()]
    return parts[0].unionByName(parts[1])


def _write_exports(spark, sf, path):
    """Portal exports by month and block of keys (which bounds a file): preamble, label, header,
    rows. Odd months are Latin-1."""
    orders = table(spark, sf, "orders").withColumns({
        "m": (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate"),
        "part": F.floor(F.col("o_orderkey") / FILE_KEYS)})
    person = F.when(F.col("o_custkey") % 2 == 0, "Niña").otherwise("Año;uno")
    rows = orders.select("m", "part", F.lit(4).alias("seq"), F.col("o_orderkey").alias("k"), F.concat(
        F.col("o_orderkey").cast("string"), F.lit(";"), (F.col("o_custkey") % 60).cast("string"),
        F.lit(';"'), person, F.lit('";'), "o_orderstatus").alias("line"))
    head = orders.select("m", "part").distinct().select("m", "part", F.inline(F.array(*[
        F.struct(F.lit(i).alias("seq"), F.lit(0).cast("bigint").alias("k"), text.alias("line"))
        for i, text in enumerate([
            F.rpad(F.lit("Informe de matrícula; generado por el portal"), 300, "."),
            F.concat(F.lit("Estudiantes del periodo MES Ñ "), F.col("m").cast("string"),
                     F.lit(" (corte)")),
            F.lit(""),
            F.lit('"ID"; "Edad";"Sexo";estado')])])))
    lines = head.unionByName(rows)
    encoded = F.when(F.col("m") % 2 == 1, F.encode("line", "ISO-8859-1").cast("string")).otherwise(
        F.col("line"))
    (lines.repartition("m", "part").sortWithinPartitions("m", "part", "seq", "k")
     .select("m", "part", encoded.alias("value")).write.partitionBy("m", "part").text(path))


SQL_MONTH = "cast((year(o_orderdate) - 1995) * 12 + month(o_orderdate) as varchar)"


@query("export_clean", f"""
select 'MES Ñ ' || {SQL_MONTH} as periodo, cast(o_orderkey as varchar) as "ID",
  cast(o_custkey % 60 as varchar) as "Edad",
  case when o_custkey % 2 = 0 then 'Niña' else 'Año;uno' end as "Sexo",
  o_orderstatus as estado from orders""")
def export_clean(spark, sf):
    path = fresh_path(spark, "exports")
    _write_exports(spark, sf, path)
    return clean_export(spark, path)


@query("export_audit", f"""
select distinct 'MES Ñ ' || {SQL_MONTH} as label, 'ok' as status,
  (month(o_orderdate) + (year(o_orderdate) - 1995) * 12) % 2 = 0 as utf8 from orders""")
def export_audit_query(spark, sf):
    path = fresh_path(spark, "exports")
    _write_exports(spark, sf, path)
    return (export_audit(spark, path).select("label", "status", "utf8")
            .distinct())


@query("report_read", """
select cast(event_id as varchar) as event_id, event_type,
  case when event_id % 10 = 0 then '' else cast(value as varchar) end as valor from events""")
def report_read(spark, sf):
    """Daily reports: five lines before the header, some rows without any value."""
    path = fresh_path(spark, "report")
    events = table(spark, sf, "events").withColumns({
        "day": F.dayofmonth("ts"), "part": F.floor(F.col("event_id") / FILE_KEYS)})
    value = F.when(F.col("event_id") % 10 == 0, "").otherwise(F.col("value").cast("string"))
    rows = events.select("day", "part", F.lit(6).alias("seq"), F.col("event_id").alias("k"), F.concat(
        F.col("event_id").cast("string"), F.lit(";"), "event_type", F.lit(";"), value)
        .alias("line"))
    blank = events.filter(F.col("event_id") % 17 == 0).select(
        "day", "part", F.lit(6).alias("seq"), F.col("event_id").alias("k"),
        F.lit(";;").alias("line"))
    head = events.select("day", "part").distinct().select("day", "part", F.inline(F.array(*[
        F.struct(F.lit(i).alias("seq"), F.lit(0).cast("bigint").alias("k"),
                 F.lit(text).alias("line"))
        for i, text in enumerate(["Ministerio", "", "Graduados", "Corte", "",
                                  "Event ID;Event Type;Valor"])])))
    (head.unionByName(rows).unionByName(blank).repartition("day", "part")
     .sortWithinPartitions("day", "part", "seq", "k")
     .select("day", "part", F.col("line").alias("value"))
     .write.partitionBy("day", "part").text(path))
    return read_report(spark, path, 5)


@query("wide_pivot_melt", """
with years as (select distinct year(o_orderdate) as y from orders),
wide as (select distinct o_orderpriority as p from orders)
select case when p like '%URG%' then 'Largo plazo' else p end as categoria,
  cast(y as varchar) as periodo_academico,
  (select cast(nullif(count(*), 0) as varchar) from orders
   where o_orderpriority = p and year(o_orderdate) = y) as valor_str
from wide, years""")
def wide_pivot_melt(spark, sf):
    path = fresh_path(spark, "wide")
    wide = (table(spark, sf, "orders")
            .select(F.col("o_orderpriority").alias("Categoría"),
                    F.year("o_orderdate").cast("string").alias("y"))
            .groupBy("Categoría").pivot("y").count())
    wide.write.option("header", True).option("sep", ";").csv(path)
    back = read_wide_csv(spark, path).withColumnRenamed("Categoría", "categoria")
    long = melt(back, ["categoria"], "periodo_academico", "valor_str")
    return long.withColumn("categoria",
                           homologate(F.col("categoria"), [("%URG%", "Largo plazo")]))


@query("parquet_partitioned", """select o_orderkey, o_totalprice,
  cast(year(o_orderdate) as integer) as anio from orders
where year(o_orderdate) = 1997 and o_totalprice > 100000""")
def parquet_partitioned(spark, sf):
    path = fresh_path(spark, "gold")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice",
                                             F.year("o_orderdate").alias("anio"))
    write_gold(rows, path, "run-1", ["anio"])
    return (read_partitioned(spark, path)
            .filter((F.col("anio") == 1997) & (F.col("o_totalprice") > 100000))
            .select("o_orderkey", "o_totalprice", "anio"))


@query("score_sink", """select cast(event_id as varchar) as id, value as score_riesgo,
  cast(2024 + event_id % 2 as integer) as anio from events""")
def score_sink(spark, sf):
    path = fresh_path(spark, "scores")
    write_scores(table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("value").alias("score_riesgo"),
        (F.col("event_id") % 2 + 2024).cast("int").alias("anio")), path)
    return read_partitioned(spark, path)


@query("silver_sink", """select l_orderkey as orden_n, l_quantity as cantidad from lineitem""")
def silver_sink(spark, sf):
    path = fresh_path(spark, "silver")
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias(" Orden Nº"),
                                               F.col("l_quantity").alias("CANTIDAD "))
    write_silver(rows, path)
    return spark.read.parquet(path)


@query("mirror_tables", """select n_nationkey, n_name, n_regionkey, 'run-9' as gold_run_id
from nation""")
def mirror_tables(spark, sf):
    """Silver tables registered, mirrored to gold where they exist, sampled with SQL."""
    root, db = fresh_path(spark, "mirror"), f"tm_{uuid.uuid4().hex}"
    ensure_database(spark, db, f"{root}/db")
    write_silver(table(spark, sf, "nation"), f"{root}/silver/nations")
    register_table(spark, f"{db}.nations", f"{root}/silver/nations")
    copied = mirror(spark, {"nations": "dim_nations", "absent": "dim_absent"}, db, root, "run-9")
    assert copied == ["dim_nations"] and existing_table(spark, f"{db}.absent") is None
    assert len(sql_sample(spark, f"{db}.nations", 3).collect()) == 3
    spark.sql(f"DROP DATABASE {db} CASCADE")  # external table: its files stay
    return read_partitioned(spark, f"{root}/dim_nations").select(
        "n_nationkey", "n_name", "n_regionkey", F.col("_gold_run_id").alias("gold_run_id"))


@query("registered_partitions", """select o_orderstatus, count(*) as n from orders
where o_orderstatus <> 'P' group by o_orderstatus""")
def registered_partitions(spark, sf):
    """A partitioned table registered in the catalogue and queried by name."""
    root, name = fresh_path(spark, "registered"), f"orders_{uuid.uuid4().hex}"
    write_gold(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), root, "run-1",
               ["o_orderstatus"])
    register_table(spark, name, root, ["o_orderstatus"])
    counts = settle(spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {name} "
                              "WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus"), "counts")
    spark.sql(f"DROP TABLE {name}")  # external: its files stay
    return counts


@query("publication_roundtrip", f"""with {SQL_PANEL},
g as (select t, {SQL_COUNTS} from panel group by t) {sql_rate("g")}""")
def publication_roundtrip(spark, sf):
    root = fresh_path(spark, "web")
    trend = period_trend(orders_panel(spark, sf), ["t"], "o_custkey", "churned_next")
    publish(spark, root, {"trend.csv": trend}, {"note.json": {"k": 10}}, {"min_cell": 10},
            forbidden=("o_custkey",))
    manifest, tables, documents = read_published(spark, root)
    assert documents["note.json"] == {"k": 10} and manifest["min_cell"] == 10
    back = tables["trend.csv"]
    kinds = {"enrolled": "bigint", "evaluable": "bigint", "churned": "bigint",
             "churn_pct": "double"}
    return back.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


@query("incremental_files", """select event_id, user_id, event_type, value from events""")
def incremental_files(spark, sf):
    """Two pick-ups: files of two thirds of the events, then those of the rest."""
    root = fresh_path(spark, "stream")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    for third in (F.col("event_id") % 3 != 2, F.col("event_id") % 3 == 2):
        events.filter(third).write.mode("append").option("sep", ";").csv(f"{root}/in")
        out = pick_up_new_files(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", schema,
                                options={"sep": ";"})
    return out.drop("batch")
