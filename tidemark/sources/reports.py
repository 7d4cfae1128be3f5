"""Text reports and exports that put a preamble in front of the header.

Files are read line by line with the text source, so a large file is split over many tasks.
A line is placed by the start of its file block and its order inside the block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import normalize_name
from tidemark.functions.text import cp1252_text
from tidemark.session import settle
from tidemark.sources.delimited import by_header, header_cells

# What a usable export looks like.
HEADER_WORDS = ("id", "edad", "sexo", ";")
REFUSAL_TEXT = "No es posible iniciar el sistema"
MIN_BYTES = 256
PERIOD_PREFIX = "Estudiantes del periodo"
PERIOD_PATTERN = r"Estudiantes del periodo\s+(.*?)\s*\("


def number_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of all files below ``path`` as ``file, size, pos, raw``, ``pos`` increasing along each.

    The result is settled: the counter depends on how files are packed into tasks, so it
    must be drawn once, not again in every branch that compares positions.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("n")).alias("pos"),
        F.col("value").alias("raw"))
    return settle(lines, "lines")


def _header_hit(line: Column, words: Sequence[str]) -> Column:
    low = F.lower(line)
    hit = F.lit(True)
    for word in words:
        hit = hit & low.contains(word)
    return hit


def _describe_exports(lines: DataFrame, header_words: Sequence[str]) -> DataFrame:
    """One row per file: status, encoding, header position and text, period label."""
    raw = F.col("raw")
    heads = settle(lines.groupBy("file").agg(
        F.max("size").alias("size"),
        F.bool_and(F.is_valid_utf8(raw)).alias("utf8"),
        F.bool_or(raw.contains(REFUSAL_TEXT)).alias("refused"),
        F.min(F.when(_header_hit(raw, header_words), F.struct("pos", raw.cast("binary").alias("raw"))))
        .alias("header")), "heads")
    # the last label line in front of the header counts
    label_lines = lines.filter(raw.startswith(PERIOD_PREFIX)).select("file", "pos", "raw")
    labels = (label_lines.join(heads.select("file", "utf8", F.col("header.pos").alias("head")),
                               "file")
              .filter(F.col("pos") < F.col("head"))
              .withColumn("line", _decoded(raw)).filter(F.col("line").rlike(PERIOD_PATTERN))
              .groupBy("file")
              .agg(F.max_by(F.trim(F.regexp_extract("line", PERIOD_PATTERN, 1)), "pos")
                   .alias("found")))
    status = (F.when(F.col("refused"), "refused")
              .when(F.col("size") < MIN_BYTES, "too_short")
              .when(F.col("header").isNull(), "no_header").otherwise("ok"))
    return heads.join(labels, "file", "left").select(
        "file", "size", "utf8", F.col("header.pos").alias("header_pos"),
        _decoded(F.col("header.raw").cast("string")).alias("header_text"),
        F.coalesce("found", _file_label()).alias("label"), status.alias("status"))


def _decoded(text: Column) -> Column:
    """The line as text, by the encoding found for its file (column ``utf8``)."""
    return F.when(F.col("utf8"), text).otherwise(cp1252_text(text.cast("binary")))


def _file_label() -> Column:
    return F.regexp_extract(F.col("file"), r"([^/]+?)(?:\.[^./]*)?$", 1)


def export_audit(spark: SparkSession, path: str | Sequence[str],
                 header_words: Sequence[str] = HEADER_WORDS) -> DataFrame:
    """One row per file with ``status`` ok, refused, too_short or no_header."""
    return _describe_exports(number_lines(spark, path), header_words).select(
        "file", "size", "utf8", "label", "status")


def clean_export(spark: SparkSession, path: str | Sequence[str], label_column: str = "periodo",
                 sep: str = ";", header_words: Sequence[str] = HEADER_WORDS,
                 file_column: str | None = None) -> DataFrame:
    """Rows of all exports under ``path``, all columns as strings, label first, then the file path
    if ``file_column`` names a column for it.

    UTF-8 files stay as they are, others are decoded as Windows-1252. Preamble and blank lines
    go; the header cells lose blanks and quotes. A file without a period label takes its own
    name. A file that is refused, too short or without a header is an error that names it
    (:func:`usable_exports` gives the rest, with the rejects beside it), and so is a row with more
    cells than its header. Quoted fields that contain a line break are not supported.
    """
    rows, rejects = usable_exports(spark, path, label_column, sep, header_words, file_column)
    bad = [f"{r['file']} ({r['status']})" for r in rejects.orderBy("file").limit(5).collect()]
    if bad:
        raise ValueError(f"unusable export: {', '.join(bad)}")
    if rows is None:
        raise ValueError(f"no usable export under {path}")
    return rows


def usable_exports(spark: SparkSession, path: str | Sequence[str], label_column: str = "periodo",
                   sep: str = ";", header_words: Sequence[str] = HEADER_WORDS,
                   file_column: str | None = None) -> tuple[DataFrame | None, DataFrame]:
    """The rows of the usable exports (None without any) and the rejected files with ``status``."""
    lines = number_lines(spark, path)
    files = settle(_describe_exports(lines, header_words)
                   .withColumn("header", header_cells(F.col("header_text"), sep)), "exports")
    rejects = files.filter(F.col("status") != "ok").select("file", "size", "status")
    usable = files.filter(F.col("status") == "ok")
    if usable.isEmpty():
        return None, rejects
    # the table of files is settled: Catalyst broadcasts it only when it is small
    body = lines.join(usable, "file").filter(F.col("pos") > F.col("header_pos"))
    body = body.withColumn("line", _decoded(F.col("raw"))).filter(
        F.length(F.regexp_replace("line", r"\r$", "")) > 0)
    keep = {label_column: F.col("label")}
    if file_column:
        keep[file_column] = F.col("file")
    return by_header(body, usable, sep, keep), rejects


def read_report(spark: SparkSession, path: str | Sequence[str], header_row: int = 5,
                sep: str = ";") -> DataFrame:
    """A text report with the header on line ``header_row`` (0-based) of every file.

    Rows without any value are dropped and nulls become ``''``. All files form one table, united by
    normalised column names. A file with too few lines for a header, and a row with more cells than
    its header, are errors that name the file.
    Lines of a block are numbered without gaps, so the header is the first number of the file
    plus ``header_row``.
    """
    lines = number_lines(spark, path)
    starts = settle(lines.groupBy("file").agg(
        F.min(F.when(F.col("pos.block") == 0, F.col("pos"))).alias("start")), "starts")
    at_header = ((F.col("pos.block") == 0)
                 & (F.col("pos.n") == F.col("start.n") + header_row))
    found = settle(lines.join(starts, "file").filter(at_header)
                   .select("file", F.col("pos").alias("header_pos"),
                           header_cells(F.col("raw"), sep).alias("cells")), "found")
    short = [r["file"] for r in starts.join(found, "file", "left_anti").orderBy("file").limit(5)
             .collect()]
    if short or found.isEmpty():
        raise ValueError(f"no header on line {header_row} in {', '.join(short) or path}")
    # distinct names only; an empty one is named by its place
    raw = [r[0] for r in found.select(F.explode("cells")).distinct().toLocalIterator()]
    plain = F.create_map(*[F.lit(x) for cell in raw for x in (cell, normalize_name(cell))])
    heads = found.withColumn("header", F.transform("cells", lambda c, i: F.when(
        plain[c] == "", F.concat(F.lit("c"), i.cast("string"))).otherwise(plain[c])))
    body = (lines.join(heads, "file").filter(F.col("pos") > F.col("header_pos"))
            .withColumn("line", F.col("raw")))
    return by_header(body, heads, sep, {}).dropna("all").fillna("")


def split_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, line_no, line`` of text values, numbered from 0."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\r?\n")).alias("line_no", "line"))
