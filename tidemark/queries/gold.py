"""The core gold facts on raw tables that are derived from the test tables."""

from pyspark.sql import functions as F

from tidemark.plans.fixed import CALENDAR, CALENDAR_SCHEMA
from tidemark.plans.gold import (
    connectivity_by_code, municipality_codes, period_fact, poverty_by_code, semester_fact,
    silver_to_gold)
from tidemark.plans.incremental import raw_files, refresh, start_ledger
from tidemark.plans.silver import raw_to_silver
from tidemark.queries.cleaning import SQL_CANONICAL
from tidemark.queries.registry import query, table
from tidemark.session import fresh_path, settle
from tidemark.sources.tables import literal_rows, write_silver

CODES = [row[0] for row in CALENDAR] + ["periodo_9998", "periodo_9999"]


def nations(spark, sf):
    """Few rows. Large tables are joined to their own key table first, whose size is known from its
    file; that of a join is not, and the large table would be shuffled for it."""
    return table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))


def students(spark, sf):
    """Enrolments from orders: some unknown periods, bad ages, missing strata, odd spellings."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"),
                                           F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    code = F.get(F.array(*[F.lit(x) for x in CODES]), (k % len(CODES)).cast("int"))
    return rows.select(
        c.cast("string").alias("id"),
        F.when(k % 50 != 0, (k % 40 + 18).cast("string")).otherwise("x").alias("edad"),
        F.when(c % 2 == 0, "F").otherwise("M").alias("sexo"),
        F.when(c % 7 != 6, (c % 7).cast("string")).alias("estrato_social"),
        F.when(c % 3 == 0, "rural").otherwise("urbana").alias("zona_de_residencia"),
        F.col("o_orderstatus").alias("escuela"), F.col("o_orderpriority").alias("programa"),
        F.col("r_name").alias("zona"), F.col("n_name").alias("centro"),
        F.when(c % 5 == 0, "otra").otherwise(F.lower("r_name")).alias("departamento_residencia"),
        F.when(c % 11 == 0, "Lejos").otherwise(F.concat(F.initcap("n_name"), F.lit(" (D.C.)")))
        .alias("municipio_residencia"), code.alias("periodo_codigo"))


def internet(spark, sf):
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"),
                                              F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(nations(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
    segment = (F.when(F.col("l_returnflag") == "N", "CORPORATIVO")
               .when(F.col("l_returnflag") == "A", "RESIDENCIAL - ESTRATO 1")
               .otherwise("RESIDENCIAL"))
    return lines.select(
        F.col("n_name").alias("municipio"), F.col("r_name").alias("departamento"),
        (F.col("n_nationkey") * 137).cast("string").alias("cod_municipio"),
        segment.alias("segmento"), F.year("l_shipdate").cast("string").alias("anno"),
        F.quarter("l_shipdate").cast("string").alias("trimestre"),
        F.col("l_quantity").cast("bigint").cast("string").alias("no_de_accesos"))


def poverty(spark, sf):
    places = table(spark, sf, "supplier")
    lines = table(spark, sf, "lineitem").join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    # the register knows some places by another code, so the fact finds no figures for them
    other = F.when(F.col("s_nationkey") < 6, 1).otherwise(0)
    return lines.select(
        (F.col("s_nationkey") * 137 + other).cast("string").alias("municipio_codigo"),
        F.when(F.col("l_discount") > 0.05, "1").otherwise("0").alias("priv_trabajo_informal"),
        F.when(F.col("l_linenumber") == 2, "s/d").otherwise(
            (F.col("l_quantity") % 2).cast("int").cast("string"))
        .alias("priv_hacinamiento_critico"),
        F.round(F.col("l_tax") * 100).cast("string").alias("indicador_pobreza_ipm"))


def gold_fact(spark, sf):
    calendar = literal_rows(spark, CALENDAR, CALENDAR_SCHEMA)
    net = internet(spark, sf)
    return period_fact(
        students(spark, sf), calendar, settle(municipality_codes(net), "codes"),
        settle(poverty_by_code(poverty(spark, sf)), "poverty"),
        settle(connectivity_by_code(net), "connectivity"))


_VALUES = ", ".join(f"('{p}', {a}, '{s}', {o}, '{k}', {n})" for p, a, s, o, k, n in CALENDAR)
_CODE_LIST = ", ".join(f"'{c}'" for c in CODES)

SQL_FACT = f"""
calendar(periodo_codigo, anio, semestre_academico, semestre_orden, cohorte_tipo, periodo_orden)
  as (values {_VALUES}),
students as (
  select cast(o_custkey as varchar) as id,
    case when o_orderkey % 50 <> 0 then cast(o_orderkey % 40 + 18 as varchar) else 'x' end as edad,
    case when o_custkey % 2 = 0 then 'F' else 'M' end as sexo,
    case when o_custkey % 7 <> 6 then cast(o_custkey % 7 as varchar) end as estrato_social,
    case when o_custkey % 3 = 0 then 'rural' else 'urbana' end as zona_de_residencia,
    o_orderstatus as escuela, o_orderpriority as programa, r_name as zona, n_name as centro,
    case when o_custkey % 5 = 0 then 'otra' else lower(r_name) end as departamento_residencia,
    case when o_custkey % 11 = 0 then 'Lejos'
      else upper(n_name[1]) || lower(n_name[2:]) || ' (D.C.)' end as municipio_residencia,
    ([{_CODE_LIST}])[(o_orderkey % {len(CODES)}) + 1] as periodo_codigo
  from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
  join region on r_regionkey = n_regionkey),
internet as (
  select n_name as municipio, r_name as departamento,
    lpad(trim(cast(n_nationkey * 137 as varchar)), 5, '0') as code, l_returnflag <> 'N' as home,
    year(l_shipdate) as y, quarter(l_shipdate) as q, cast(l_quantity as bigint) as accesos
  from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
  join region on r_regionkey = n_regionkey),
poverty as (
  select lpad(trim(cast(s_nationkey * 137
      + case when s_nationkey < 6 then 1 else 0 end as varchar)), 5, '0') as code,
    avg(case when l_discount > 0.05 then 1.0 else 0.0 end) as tasa_informalidad_mpio,
    avg(case when l_linenumber <> 2 then cast(l_quantity as bigint) % 2 end)
      as tasa_hacinamiento_mpio,
    avg(round(l_tax * 100)) as promedio_ipm_mpio, count(*) as poblacion_sisben_mpio
  from lineitem join supplier on s_suppkey = l_suppkey group by 1),
codes as (
  select {SQL_CANONICAL.format(c="municipio")} as place,
    {SQL_CANONICAL.format(c="departamento")} as region, max(code) as code
  from internet group by 1, 2),
only_places as (select place, max(code) as only_code from codes group by place
                having count(distinct code) = 1),
connectivity as (
  select code, cast(sum(accesos) as bigint) as total_accesos_res,
    cast(max(y) as integer) as anio_corte_conectividad
  from (select * from internet where home
        qualify dense_rank() over (partition by code order by y desc, q desc) = 1)
  group by code),
cuts as (select quantile_disc(total_accesos_res, 0.33) as c1,
                quantile_disc(total_accesos_res, 0.66) as c2
         from connectivity where total_accesos_res > 0),
enrolled as (
  select * from students join calendar using (periodo_codigo)
  qualify row_number() over (partition by id, periodo_codigo
    order by edad, escuela, programa) = 1),
spans as (
  select id, semestre_orden, lead(semestre_orden) over w as next_semestre_orden,
    cast(case when semestre_orden >= (select max(semestre_orden) from enrolled) then null
      when lead(semestre_orden) over w is null then 1
      when lead(semestre_orden) over w = semestre_orden + 1 then 0 else 1 end as integer)
      as desertion_t1,
    row_number() over w as semestres_cursados_acum,
    semestre_orden - lag(semestre_orden) over w as gap_desde_semestre_anterior,
    cast(case when lag(semestre_orden) over w is null then 1 else 0 end as integer)
      as es_primer_semestre
  from (select distinct id, semestre_orden from enrolled)
  window w as (partition by id order by semestre_orden)),
fact as (
  select e.*, s.next_semestre_orden, s.desertion_t1, s.semestres_cursados_acum,
    s.gap_desde_semestre_anterior, s.es_primer_semestre,
    count(e.id) over h as total_periodos_matriculados, min(periodo_orden) over h as primer_periodo,
    max(periodo_orden) over h as ultimo_periodo,
    cast(count(e.id) over h as double)
      / (max(periodo_orden) over h - min(periodo_orden) over h + 1) as tasa_permanencia,
    e.mpio_norm_ as mpio_norm, e.depto_norm_ as depto_norm,
    coalesce(c.code, u.only_code) as codigo_divipola, p.tasa_informalidad_mpio,
    p.tasa_hacinamiento_mpio, p.promedio_ipm_mpio, p.poblacion_sisben_mpio,
    coalesce(k.total_accesos_res, 0) as total_accesos_res, k.anio_corte_conectividad,
    cast(case when coalesce(k.total_accesos_res, 0) = 0 then 0
      when k.total_accesos_res < c1 then 1 when k.total_accesos_res < c2 then 2 else 3 end
      as integer) as nivel_conectividad
  from (select *, {SQL_CANONICAL.format(c="municipio_residencia")} as mpio_norm_,
          {SQL_CANONICAL.format(c="departamento_residencia")} as depto_norm_ from enrolled) e
  join spans s on s.id = e.id and s.semestre_orden = e.semestre_orden
  left join codes c on c.place = mpio_norm_ and c.region = depto_norm_
  left join only_places u on u.place = mpio_norm_
  left join poverty p on p.code = coalesce(c.code, u.only_code)
  left join connectivity k on k.code = coalesce(c.code, u.only_code), cuts
  window h as (partition by e.id))"""

_RATES = ("tasa_informalidad_mpio", "tasa_hacinamiento_mpio", "promedio_ipm_mpio")
_ROUNDED = ", ".join(f"round({c}, 9) as {c}" for c in _RATES)


def _rounded(df):
    return df.withColumns({c: F.round(c, 9) for c in _RATES})


@query("gold_period_fact", f"""with {SQL_FACT}
select * exclude (mpio_norm_, depto_norm_) replace ({_ROUNDED}) from fact""")
def gold_period_fact(spark, sf):
    return _rounded(gold_fact(spark, sf))


@query("gold_semester_fact", f"""with {SQL_FACT}
select id, anio, semestre_academico, semestre_orden, cohorte_tipo,
  count(*) over (partition by id, semestre_orden) as n_periodos_en_semestre, edad, sexo,
  estrato_social, zona_de_residencia, escuela, programa, zona, centro, departamento_residencia,
  municipio_residencia, codigo_divipola, {_ROUNDED}, poblacion_sisben_mpio, total_accesos_res,
  nivel_conectividad, anio_corte_conectividad, semestres_cursados_acum,
  gap_desde_semestre_anterior, es_primer_semestre, desertion_t1
from fact
qualify row_number() over (partition by id, semestre_orden order by
  case cohorte_tipo when 'principal' then 1 when 'secundaria' then 2 else 3 end,
  periodo_orden) = 1""")
def gold_semester_fact(spark, sf):
    return _rounded(semester_fact(gold_fact(spark, sf)))


_LANDINGS = 3  # period files land in as many steps


def landed_facts(spark, sf):
    """A full run on the files of the first periods, then the others by landings; the lake."""
    lake = fresh_path(spark, "lake")
    people = fresh_path(spark, "students")
    students(spark, sf).write.partitionBy("periodo_codigo").parquet(people)
    people = spark.read.parquet(people)
    write_silver(internet(spark, sf), f"{lake}/silver/gobierno_internet_fijo")
    write_silver(poverty(spark, sf), f"{lake}/silver/gobierno_sisben_iv")
    for step in range(_LANDINGS):
        for code in CODES[step * len(CODES) // _LANDINGS:(step + 1) * len(CODES) // _LANDINGS]:
            (people.filter(F.col("periodo_codigo") == code).drop("periodo_codigo").write
             .option("sep", ";").option("header", True)
             .csv(f"{lake}/raw/estudiantes/estudiantes_{code}.csv"))
        if step == 0:
            files = settle(raw_files(spark, f"{lake}/raw"), "files")
            raw_to_silver(spark, f"{lake}/raw", f"{lake}/silver", "r0", {})
            silver_to_gold(spark, f"{lake}/silver", f"{lake}/gold", "r0")
            start_ledger(spark, lake, files)
        else:
            refresh(spark, lake, f"r{step}")
    return lake


def _plain(df):
    """Without what names the run."""
    return _rounded(df.drop("source_file", *[
        c for c in df.columns if c.startswith(("_gold_", "silver_"))]))


@query("gold_landed_periods", f"""with {SQL_FACT}
select * exclude (mpio_norm_, depto_norm_) replace ({_ROUNDED}) from fact""")
def gold_landed_periods(spark, sf):
    """Facts that grew by landings of period files equal those of all files at once."""
    lake = landed_facts(spark, sf)
    return _plain(spark.read.parquet(f"{lake}/gold/fact_estudiante_periodo"))
