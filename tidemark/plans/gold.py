"""Silver tables to gold dimensions and facts."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import pad_code
from tidemark.operators.lookup import (
    band_column, code_table, coverage, enrich_by_code, enrich_by_place, latest_totals, place_codes,
    quantile_cuts, rates_by_code)
from tidemark.operators.panel import (
    attach_calendar, dedup_by_key, pick_per_period, rank_of, unknown_periods,
    with_panel_columns)
from tidemark.operators.profiles import period_prevalence
from tidemark.plans.fixed import (
    CALENDAR, CALENDAR_SCHEMA, COHORT_PRIORITY, RESIDENTIAL, SEMESTER_COLUMNS)
from tidemark.sources.artifacts import artifacts_exist
from tidemark.sources.tables import literal_rows, read_partitioned, write_gold


def municipality_codes(internet: DataFrame) -> DataFrame:
    return code_table(internet, "municipio", "departamento", pad_code(F.col("cod_municipio")))


def poverty_by_code(poverty: DataFrame) -> DataFrame:
    return rates_by_code(poverty, pad_code(F.col("municipio_codigo")), {
        "tasa_informalidad_mpio": "priv_trabajo_informal",
        "tasa_hacinamiento_mpio": "priv_hacinamiento_critico",
        "promedio_ipm_mpio": "indicador_pobreza_ipm"}, "poblacion_sisben_mpio")


def connectivity_by_code(internet: DataFrame) -> DataFrame:
    """Residential accesses of the latest reported quarter per municipality."""
    rows = internet.filter(F.col("segmento").contains(RESIDENTIAL)).select(
        pad_code(F.col("cod_municipio")).alias("code"),
        F.col("anno").try_cast("int").alias("anno"),
        F.col("trimestre").try_cast("int").alias("trimestre"),
        F.col("no_de_accesos").try_cast("bigint").alias("accesos"))
    return latest_totals(rows, "code", ["anno", "trimestre"], "accesos").withColumnsRenamed(
        {"latest_total": "total_accesos_res", "latest_anno": "anio_corte_conectividad"})


def period_fact(students: DataFrame, calendar: DataFrame, codes: DataFrame, poverty: DataFrame,
                connectivity: DataFrame,
                last: Column | None = None, spelled: DataFrame | None = None) -> DataFrame:
    """Fact at grain (id, period).

    ``codes``, ``poverty`` and ``connectivity`` are stored tables, so their joins broadcast by
    size. The facts move twice: once to fold duplicates, once by id for all windows. ``last``, the
    last semester, has to be given where ``students`` are not all there are; ``spelled`` may name
    a table with the places of all ``students`` that is cheaper to read.

    Of duplicates the first by their own columns stays; from which file and run a row came decides
    last, so the result does not depend on how a period is cut into files. The calendar comes after
    the fold, which then moves no columns that follow from the period.
    """
    known = students.join(calendar.select("periodo_codigo"), "periodo_codigo", "left_semi")
    origin = [c for c in known.columns if c == "source_file" or c.startswith("_silver_")]
    known = known.select(*[c for c in known.columns if c not in origin], *origin)
    fact = attach_calendar(dedup_by_key(known, ["id", "periodo_codigo"]), calendar,
                           "periodo_codigo")
    # the last semester from the narrow input, not from the folded fact
    if last is None:
        last = (attach_calendar(students.select("periodo_codigo"), calendar, "periodo_codigo")
                .agg(F.max("semestre_orden")).scalar())
    fact = with_panel_columns(fact, "id", "semestre_orden", last).withColumnsRenamed({
        "next_t": "next_semestre_orden", "churned_next": "desertion_t1",
        "periods_so_far": "semestres_cursados_acum",
        "gap_since_previous": "gap_desde_semestre_anterior",
        "is_first_period": "es_primer_semestre"})
    whole = Window.partitionBy("id")
    fact = fact.withColumns({
        "total_periodos_matriculados": F.count("id").over(whole),
        "primer_periodo": F.min("periodo_orden").over(whole),
        "ultimo_periodo": F.max("periodo_orden").over(whole)})
    span = F.col("ultimo_periodo") - F.col("primer_periodo") + 1
    fact = fact.withColumn("tasa_permanencia", F.col("total_periodos_matriculados") / span)
    home = ("municipio_residencia", "departamento_residencia")
    places = place_codes(students if spelled is None else spelled, *home, codes,
                         ("mpio_norm", "depto_norm"), "codigo_divipola")
    fact = enrich_by_place(fact, places, *home)
    fact = enrich_by_code(fact, poverty, "codigo_divipola")
    fact = enrich_by_code(fact, connectivity, "codigo_divipola")
    return band_column(fact, "total_accesos_res",
                       quantile_cuts(connectivity, "total_accesos_res"),
                       "nivel_conectividad")


def semester_fact(fact: DataFrame) -> DataFrame:
    """Modelling table at grain (id, semester): the row of the main cohort wins.

    Columns counted over all periods of the semester come along.
    """
    wanted = [c for c in SEMESTER_COLUMNS if c != "n_periodos_en_semestre"]
    rows = fact.select(*wanted, "periodo_orden")
    picked = pick_per_period(rows, "id", "semestre_orden",
                             [rank_of(F.col("cohorte_tipo"), COHORT_PRIORITY),
                              F.col("periodo_orden")], "n_periodos_en_semestre")
    return picked.select(*SEMESTER_COLUMNS)


#: Silver tables without which no fact can be built.
NEEDED = ("estudiantes", "gobierno_sisben_iv", "gobierno_internet_fijo")


def missing_silver(spark: SparkSession, silver: str) -> list[str]:
    return [name for name in NEEDED if not artifacts_exist(spark, f"{silver}/{name}")]


def stored_dimension(spark: SparkSession, path: str) -> DataFrame:
    """A written dimension without its audit columns."""
    return spark.read.parquet(path).drop("_gold_processed_at", "_gold_run_id")


def silver_to_gold(spark: SparkSession, silver: str, gold: str, run_id: str) -> dict[str, str]:
    """Write the gold dimensions and both facts; returns table name -> path.

    Each dimension is written once and read back: its size is then known. The second fact is
    built from the first as written, so the joins run once.
    """
    students = spark.read.parquet(f"{silver}/estudiantes")
    poverty_raw = spark.read.parquet(f"{silver}/gobierno_sisben_iv")
    internet = spark.read.parquet(f"{silver}/gobierno_internet_fijo")

    paths = {name: f"{gold}/{name}" for name in (
        "dim_divipola", "dim_pobreza_mpio", "dim_conectividad_mpio",
        "fact_estudiante_periodo", "fact_estudiante_semestre")}
    write_gold(municipality_codes(internet), paths["dim_divipola"], run_id)
    write_gold(poverty_by_code(poverty_raw), paths["dim_pobreza_mpio"], run_id)
    write_gold(connectivity_by_code(internet), paths["dim_conectividad_mpio"], run_id)

    calendar = literal_rows(spark, CALENDAR, CALENDAR_SCHEMA)
    fact = period_fact(students, calendar, *[stored_dimension(spark, paths[name]) for name in (
        "dim_divipola", "dim_pobreza_mpio", "dim_conectividad_mpio")])
    write_gold(fact, paths["fact_estudiante_periodo"], run_id, ["anio"])
    written = read_partitioned(spark, paths["fact_estudiante_periodo"])
    write_gold(semester_fact(written), paths["fact_estudiante_semestre"], run_id, ["anio"])
    return paths


def gold_checks(spark: SparkSession, students: DataFrame,
                paths: dict[str, str]) -> dict[str, Any]:
    """Figures to look at after a run: coverage of the code lookup, prevalence by semester (null
    where censored) and rows of periods the calendar does not know. All are a few rows."""
    fact = read_partitioned(spark, paths["fact_estudiante_periodo"])
    semester = read_partitioned(spark, paths["fact_estudiante_semestre"])
    calendar = literal_rows(spark, CALENDAR, CALENDAR_SCHEMA)
    unknown = unknown_periods(students, calendar, "periodo_codigo").agg(F.coalesce(F.sum("n_rows"), F.lit(0)))
    by_semester = period_prevalence(semester, "semestre_orden", "desertion_t1")
    return {
        "coverage": fact.agg(coverage(fact, "codigo_divipola")).first()[0],
        "rows_of_unknown_periods": unknown.first()[0],
        "prevalence": {r["semestre_orden"]: (r["n"], r["prevalence"])
                       for r in by_semester.orderBy("semestre_orden").collect()},
    }
