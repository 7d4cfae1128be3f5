"""Delimited text sources; every column is read as a string."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import settle


def read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str = ";",
                   schema: str | None = None, file_column: str | None = None) -> DataFrame:
    """Header CSV, no inference. ``path`` may be a glob or a list of paths.

    Files may differ in the order and in the set of their columns: they are united by name, and a
    column that a file lacks is null there. Files of one header are one scan, so there are as many
    scans as different headers. A row with more cells than its header is an error; a row that
    equals the header is a row. ``file_column`` names a column for the file's path.

    With a declared ``schema`` all files have that layout: no file is opened to plan the query, and
    ``enforceSchema=false`` makes Spark check the header's names against it.
    """
    if schema:
        rows = (spark.read.option("sep", sep).option("header", True).schema(schema)
                .option("enforceSchema", False).csv(path))
        return rows if file_column is None else rows.select(
            F.col("_metadata.file_path").alias(file_column), "*")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    # the first block of a file is read in order by one task, so the smallest number is its top line
    tops = settle(
        lines.filter((F.col("block") == 0) & F.col("line").rlike(r"[^\x00-\x20]"))
        .withColumn("n", F.monotonically_increasing_id()).groupBy("file")
        .agg(F.min_by("line", "n").alias("top"))
        .withColumn("header", header_cells(F.col("top"), sep)), "headers")
    layouts = header_layouts(tops)
    names = header_names(layouts)
    parts = []
    for header in layouts:
        files = path if len(layouts) == 1 else [
            file_pattern(r["file"]) for r in
            tops.filter(F.col("header") == F.array(*map(F.lit, header))).select("file")
            .toLocalIterator()]
        parts.append(_one_layout(spark, files, sep, header, names, file_column))
    return reduce(DataFrame.union, parts)


def _one_layout(spark: SparkSession, files: str | Sequence[str], sep: str, header: Sequence[str],
                names: Sequence[str], file_column: str | None) -> DataFrame:
    """Files of one header by Spark's own scan, which drops a file's first line by its place and
    reads only the columns that are asked for."""
    beyond = f"c{len(header)}"
    rows = (spark.read.option("sep", sep).option("header", True)
            .schema(", ".join(f"c{i} string" for i in range(len(header) + 1))).csv(files))
    path = F.col("_metadata.file_path")
    rows = rows.select("*", path.alias("file")).filter(
        F.when(F.col(beyond).isNotNull(), F.raise_error(F.concat(
            F.lit("a row has more cells than its header in "), "file"))).otherwise(F.lit(True)))
    place = {name: F.col(f"c{i}") for i, name in enumerate(header)}
    return rows.select(
        *([F.col("file").alias(file_column)] if file_column else []),
        *[place.get(n, F.lit(None).cast("string")).alias(n) for n in names])


def file_pattern(path: str) -> str:
    """A path as a file listing shows it, as a pattern that matches this file only."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(path))


def header_cells(line: Column, sep: str) -> Column:
    """The names in a header line, without blanks and quotes around them; a separator inside
    quotes belongs to the name."""
    bare = F.regexp_replace(line, "[\\r\\n\\ufeff]", "")
    cell = rf'\Q{sep}\E(\s*+"(?:[^"\\]|\\.|"")*+"(?:(?!\Q{sep}\E).)*|(?:(?!\Q{sep}\E).)*)'
    cells = F.regexp_extract_all(F.concat(F.lit(sep), bare), F.lit(cell), F.lit(1))
    return F.transform(cells, lambda c: F.regexp_replace(F.regexp_replace(
        F.trim(c), '^"|"$', ""), r'""|\\"', '"'))


def header_layouts(headers: DataFrame) -> list[list[str]]:
    """The different arrays ``header``; only they reach the driver. A name twice in a header is an
    error that names the file."""
    layouts = sorted(list(r["header"]) for r in headers.select("header").distinct().collect())
    for header in layouts:
        if len(set(header)) < len(header):
            file = headers.filter(F.col("header") == F.array(*map(F.lit, header))).first()["file"]
            raise ValueError(f"a column name occurs twice in {file}: {header}")
    if not any(layouts):
        raise ValueError("no file has a header")
    return layouts


def header_names(layouts: Sequence[Sequence[str]]) -> list[str]:
    """The distinct names by their first place, then by name."""
    first: dict[str, int] = {}
    for header in layouts:
        for at, name in enumerate(header):
            first[name] = min(at, first.get(name, at))
    return sorted(first, key=lambda name: (first[name], name))


def by_header(body: DataFrame, headers: DataFrame, sep: str, keep: dict[str, Column]) -> DataFrame:
    """Columns by name out of ``line``, each row by the array ``header`` of its ``file``.

    One scan for all layouts: a line is split once to the widest layout and every column is picked
    by its place in the row's own header. ``headers`` has one row per file; only the distinct column
    names reach the driver. A name that occurs twice in a header, and a cell beyond the header, are
    errors that name the file.
    """
    layouts = header_layouts(headers)
    names, width = header_names(layouts), max(map(len, layouts))
    fields = ", ".join(f"c{i} string" for i in range(width + 1))
    line = F.regexp_replace("line", r"\r$", "")
    split = body.withColumn("_p", F.from_csv(line, F.lit(fields), {"sep": sep})).withColumn(
        "_cells", F.array(*[F.col(f"_p.c{i}") for i in range(width + 1)]))
    beyond = F.exists(F.slice("_cells", F.size("header") + 1, width + 1), lambda c: c.isNotNull())
    checked = F.when(beyond, F.raise_error(F.concat(
        F.lit("a row has more cells than its header in "), F.col("file")))).otherwise(
        F.col("_cells"))
    cells = split.withColumn("_cells", checked)
    return cells.select(
        *[c.alias(name) for name, c in keep.items()],
        *[F.get("_cells", F.array_position("header", F.lit(n)).cast("int") - 1).alias(n)
          for n in names])


def read_wide_csv(spark: SparkSession, path: str | Sequence[str], sep: str = ";") -> DataFrame:
    """A wide pivot file. Invalid UTF-8 turns into U+FFFD while decoding."""
    return read_delimited(spark, path, sep)


def files_by_stem(spark: SparkSession, path: str, suffix: str = ".csv") -> dict[str, str]:
    """``{name without suffix: path}`` of the files under ``path``; only names are listed."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
               .load(path).select("path"))
    return {p.rsplit("/", 1)[1].removesuffix(suffix): p
            for p in sorted(r["path"] for r in listing.toLocalIterator())}


def with_file_key(df: DataFrame, pattern: str, out: str, path: str) -> DataFrame:
    """Add the part of the file path in column ``path`` that ``pattern`` captures."""
    return df.withColumn(out, F.regexp_extract(F.col(path), pattern, 1))
