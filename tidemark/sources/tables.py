"""Silver and gold sinks, catalogue registration and table readers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.functions.names import normalize_columns


def with_silver_audit(df: DataFrame, source: str, run_id: str) -> DataFrame:
    return df.withColumns({"_silver_source": F.lit(source),
                           "_silver_processed_at": F.current_timestamp(),
                           "_silver_run_id": F.lit(run_id)})


def with_gold_audit(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumns({"_gold_processed_at": F.current_timestamp(),
                           "_gold_run_id": F.lit(run_id)})


def _save(df: DataFrame, path: str, partition_cols: Sequence[str] = (),
          target_files: int | None = None) -> None:
    if target_files:
        df = df.repartition(target_files)
    elif partition_cols:
        # AQE sizes the output files and splits a partition value that holds most rows
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def write_silver(df: DataFrame, path: str, target_files: int | None = None) -> None:
    """Overwrite a silver table with normalised column names."""
    _save(normalize_columns(df), path, target_files=target_files)


def write_gold(df: DataFrame, path: str, run_id: str, partition_cols: Sequence[str] = ()) -> None:
    """Overwrite a gold table, with audit columns and optional partition columns."""
    _save(with_gold_audit(df, run_id), path, partition_cols)


def write_scores(df: DataFrame, path: str, year_column: str = "anio") -> None:
    """Overwrite the score table, partitioned by year."""
    _save(df, path, [year_column])


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table with its partition columns restored from the paths."""
    return spark.read.parquet(path)


def existing_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None when the catalogue has none of that name."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def mirror(spark: SparkSession, tables: dict[str, str], source_db: str, gold_root: str,
           run_id: str) -> list[str]:
    """Copy silver tables to gold dimensions; missing ones are skipped. Returns what was copied."""
    copied = []
    for silver_name, gold_name in tables.items():
        df = existing_table(spark, f"{source_db}.{silver_name}")
        if df is not None:
            write_gold(df, f"{gold_root}/{gold_name}", run_id)
            copied.append(gold_name)
    return copied


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def register_table(spark: SparkSession, name: str, path: str,
                   partition_cols: Sequence[str] = ()) -> None:
    """(Re-)register written parquet under a name, with its partitions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if partition_cols:
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{c}`" for c in partition_cols)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({by}) "
                  f"LOCATION '{path}'")
        spark.catalog.recoverPartitions(name)
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small inline dimension.

    Sent as an Arrow table it becomes a local relation of known size, which Catalyst broadcasts;
    a list of Python rows would be an RDD of unknown size, and the facts would be shuffled.
    """
    fields = StructType.fromDDL(schema)
    columns = [list(c) for c in zip(*rows)] or [[] for _ in fields]
    arrow = pa.table(columns, schema=to_arrow_schema(fields))
    return spark.createDataFrame(arrow, fields)


def sql_sample(spark: SparkSession, table: str, n: int, columns: str = "*") -> DataFrame:
    """``SELECT … LIMIT n``, the profiling look at a table."""
    return spark.sql(f"SELECT {columns} FROM {table} LIMIT {int(n)}")
