"""Sources whose files hold one JSON array each (pages of a paged interface)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.delimited import file_pattern

# Dataset ids of the open-data portal and the tables they become.
DATASET_TABLES = {
    "hq2v-5umk": "gobierno_sisben_iv",
    "n48w-gutb": "gobierno_internet_fijo",
    "ji8i-4anb": "gobierno_cobertura_educativa",
}


def read_json_array(spark: SparkSession, path: str | Sequence[str],
                    schema: str | T.StructType | None = None) -> DataFrame:
    """One row per array element. Declare the schema: inference reads the data twice.

    A file is one task here, which the page limit of the extract bounds.
    """
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def dataset_id(path: Column) -> Column:
    """``…/dataset_<id>.json``, ``…/<id>.json`` and ``…/<id>_part-0000001.json`` give the id, and
    so does a folder of that name with Spark part files inside."""
    # the last two names hold all of it; over a whole path the search tries every start
    return F.regexp_extract(F.substring_index(path, "/", -2),
                            r"(?:dataset_)?([^/]+?)(?:_part-\d+)?\.json(?:/part-[^/]+)?$", 1)


def route_datasets(spark: SparkSession, path: str | Sequence[str],
                   schemas: dict[str, str | T.StructType],
                   tables: dict[str, str] = DATASET_TABLES) -> dict[str, DataFrame]:
    """One DataFrame per mapped dataset id; files with other ids are skipped.

    ``schemas`` maps a table name to its declared schema. The files of an id are found at any depth
    below ``path`` by a filter on the file's path, which Spark applies when it lists the files: no
    file outside the map is ever opened, and only the ids that occur reach the driver.
    """
    roots = [path] if isinstance(path, str) else list(path)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
              .select(dataset_id(F.col("path")).alias("id"))
              .filter(F.col("id").isin(sorted(tables))).distinct())
    routed = {}
    for key in sorted(r["id"] for r in listed.toLocalIterator()):
        own = dataset_id(F.col("_metadata.file_path")) == key
        schema = schemas.get(tables[key])
        if schema is None:  # inference opens the files, so it has to be given its own
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
            mine = files.select("path").filter(dataset_id(F.col("path")) == key)
            routed[tables[key]] = read_json_array(
                spark, [file_pattern(r["path"]) for r in mine.toLocalIterator()])
        else:
            routed[tables[key]] = (
                spark.read.option("multiLine", True).option("recursiveFileLookup", True)
                .schema(schema).json(roots).filter(own))
    return routed


def read_pages(spark: SparkSession, path: str | Sequence[str],
               schema: str | T.StructType) -> DataFrame:
    """Union of all page files of a directory; empty pages add nothing."""
    return read_json_array(spark, path, schema).select("*", "_metadata.file_path")


def page_audit(pages: DataFrame) -> DataFrame:
    """Records per dataset and page file; the id is read off a path once per file."""
    return (pages.groupBy(F.col("file_path").alias("page_file"))
            .agg(F.count("*").alias("n_records"))
            .select(dataset_id(F.col("page_file")).alias("dataset"), "page_file", "n_records"))
