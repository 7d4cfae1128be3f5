"""Raw files to silver tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import normalize_columns, normalize_name, rename_map
from tidemark.functions.text import homologate
from tidemark.operators.profiles import union_all
from tidemark.operators.reshape import melt
from tidemark.plans.fixed import CREDIT_RULES, PERIOD_FROM_FILE, POVERTY_NAMES
from tidemark.sources.artifacts import artifacts_exist
from tidemark.sources.delimited import (
    files_by_stem, read_delimited, read_wide_csv, with_file_key)
from tidemark.sources.json_arrays import DATASET_TABLES, route_datasets
from tidemark.sources.reports import clean_export, read_report
from tidemark.sources.tables import with_silver_audit, write_silver


def students_table(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned period files, with the period code from the file name."""
    return with_file_key(read_delimited(spark, path, file_column="source_file"),
                         PERIOD_FROM_FILE, "periodo_codigo", "source_file")


def students_from_exports(spark: SparkSession, path: str) -> DataFrame:
    """The same table straight from portal exports; an unusable export is an error."""
    return with_file_key(clean_export(spark, path, file_column="source_file"),
                         PERIOD_FROM_FILE, "periodo_codigo", "source_file")


def credit_table(spark: SparkSession, path: str) -> DataFrame:
    """Wide credit report to long form with homologated categories."""
    wide = read_wide_csv(spark, path)
    category = normalize_name(wide.columns[0])
    wide = wide.withColumnRenamed(wide.columns[0], category)
    long = melt(wide, [category], "periodo_academico", "valor_str")
    return long.withColumn(category, homologate(F.col(category), CREDIT_RULES))


def government_tables(spark: SparkSession, path: str,
                      schemas: Mapping[str, str | T.StructType]) -> dict[str, DataFrame]:
    """Mapped open-data sets; the poverty register gets its business names."""
    tables = route_datasets(spark, path, dict(schemas), DATASET_TABLES)
    return {name: rename_map(df, POVERTY_NAMES) if name == "gobierno_sisben_iv" else df
            for name, df in tables.items()}


def has_files(spark: SparkSession, folder: str, pattern: str = "*") -> bool:
    """Whether the folder is there with a file of that name in it; no content is read."""
    return artifacts_exist(spark, folder) and not (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).load(folder).select("path").isEmpty())


def raw_to_silver(spark: SparkSession, raw: str, silver: str, run_id: str,
                  schemas: Mapping[str, str | T.StructType]) -> list[str]:
    """Write the silver tables of the sources that are there; returns their names."""
    students = []
    if has_files(spark, f"{raw}/estudiantes", "*.csv"):
        students.append(normalize_columns(students_table(spark, f"{raw}/estudiantes/*.csv")))
    if has_files(spark, f"{raw}/exports"):
        students.append(normalize_columns(students_from_exports(spark, f"{raw}/exports")))
    tables: dict[str, tuple[DataFrame, str]] = {}
    if students:
        tables["estudiantes"] = (union_all(students, allow_missing=True), "estudiantes")
    if has_files(spark, f"{raw}/gobierno"):
        for name, df in government_tables(spark, f"{raw}/gobierno", schemas).items():
            tables[name] = (df, "gobierno")
    if has_files(spark, f"{raw}/spadies", "*.csv"):
        for stem, path in files_by_stem(spark, f"{raw}/spadies").items():
            name = f"spadies_{normalize_name(stem)}"
            tables[name] = (credit_table(spark, path), name)
    if has_files(spark, f"{raw}/snies", "*.csv"):
        tables["snies_graduados"] = (read_report(spark, f"{raw}/snies/*.csv"), "snies")
    for name, (df, source) in tables.items():
        write_silver(with_silver_audit(df, source, run_id), f"{silver}/{name}")
    return list(tables)
