"""New period files into the facts that are already there.

A ledger keeps which raw files (by path, time and size) went into which batch. A landing of new or
changed period files is folded for the entities it touches alone: those with rows in the files, now
or before, and, when the last semester moves, those whose target was open. Only partitions in which
they have or had rows are written again.

A batch is prepared aside and then put in place: ``pending/batch-n`` holds the new partitions and,
written last, their values. A run that finds such a batch finishes it first. The ledger entry is
the last step, so a batch that stopped anywhere is either done again from the files or put in place
to the end from the prepared partitions, with the same result.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import normalize_columns
from tidemark.operators.panel import attach_calendar
from tidemark.operators.profiles import union_all
from tidemark.plans.fixed import CALENDAR, CALENDAR_SCHEMA
from tidemark.plans.gold import period_fact, semester_fact, stored_dimension
from tidemark.plans.silver import students_from_exports, students_table
from tidemark.session import delete_path, settle
from tidemark.sources.artifacts import artifacts_exist
from tidemark.sources.delimited import file_pattern
from tidemark.sources.partitions import (
    apply_replacement, same_entity, stage_kept, stage_rows)
from tidemark.sources.tables import literal_rows, with_gold_audit, with_silver_audit

FACTS = ("fact_estudiante_periodo", "fact_estudiante_semestre")
#: Raw folders whose files can be added; a change elsewhere needs a full run.
GROWING = {"estudiantes": students_table, "exports": students_from_exports}
STAMP = ["file", "modified", "size"]


def raw_files(spark: SparkSession, raw: str) -> DataFrame:
    """``source, file, modified, size`` of the raw files; no content is read."""
    folder = raw.rstrip("/").rsplit("/", 1)[-1]
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("size")))
    found = found.select(F.regexp_extract("file", rf"/\Q{folder}\E/([^/]+)/", 1).alias("source"),
                         *STAMP)
    return found.filter((F.col("source") != "estudiantes")
                        | F.col("file").rlike(r"/estudiantes/[^/]+\.csv(/part-[^/]+)?$"))


def start_ledger(spark: SparkSession, lake: str, files: DataFrame) -> None:
    """After a full run: its files are batch 0, and no landing is left over."""
    delete_path(spark, f"{lake}/silver/estudiantes_landings")
    delete_path(spark, f"{lake}/pending")
    (files.withColumn("batch", F.lit(0)).write.mode("overwrite").partitionBy("batch")
     .parquet(f"{lake}/ledger"))


def _ledger(spark: SparkSession, lake: str) -> DataFrame:
    return spark.read.parquet(f"{lake}/ledger")


def _students(spark: SparkSession, lake: str, landed: DataFrame) -> DataFrame:
    """Silver students: every file's rows from the batch that ``landed`` (``file, batch``) names,
    those of other files from the full run."""
    whole = spark.read.parquet(f"{lake}/silver/estudiantes")
    path = f"{lake}/silver/estudiantes_landings"
    if not artifacts_exist(spark, path):
        return whole
    added = spark.read.option("mergeSchema", True).parquet(path)
    added = added.join(landed, (added["source_file"] == landed["file"])
                       & (added["batch"] == landed["batch"]), "left_semi").drop("batch")
    rest = whole.join(landed, whole["source_file"] == landed["file"], "left_anti")
    return union_all([rest, added], allow_missing=True)


def silver_students(spark: SparkSession, lake: str) -> DataFrame:
    """The students of the full run and of all landings since."""
    return _students(spark, lake, settle(
        _ledger(spark, lake).filter("batch > 0").groupBy("file").agg(F.max("batch").alias("batch")),
        "landed"))


def _last_semester(spark: SparkSession, students: DataFrame) -> int | None:
    calendar = literal_rows(spark, CALENDAR, CALENDAR_SCHEMA)
    return (attach_calendar(students.select("periodo_codigo"), calendar, "periodo_codigo")
            .agg(F.max("semestre_orden")).first()[0])


def _changes(spark: SparkSession, lake: str, files: DataFrame) -> DataFrame:
    """``source, file, modified, size, gone, known`` of files that are new, changed or gone; a known
    one was there before."""
    entries = _ledger(spark, lake)
    known = entries.groupBy("file").agg(F.max_by(F.struct("source", *STAMP), "batch").alias("was"))
    both = files.join(known.withColumnRenamed("file", "key"), F.col("file") == F.col("key"), "full")
    same = (F.col("was.modified") == F.col("modified")) & (F.col("was.size") == F.col("size"))
    return both.filter(~F.coalesce(same, F.lit(False))).select(
        F.coalesce("source", "was.source").alias("source"), F.coalesce("file", "key").alias("file"),
        "modified", "size", F.col("file").isNull().alias("gone"),
        F.col("key").isNotNull().alias("known"))


def refresh(spark: SparkSession, lake: str, run_id: str) -> dict[str, Any] | None:
    """Bring the facts up to date with new and changed period files.

    Returns ``files`` (how many went in; 0 writes nothing), ``batch`` and ``partitions`` (the years
    written). None says that a full run is needed: no ledger or facts yet, a file of another source
    changed, a file is gone, or the new files bring columns that the facts lack.
    """
    gold = f"{lake}/gold"
    if not all(artifacts_exist(spark, p) for p in
               (f"{lake}/ledger", *[f"{gold}/{name}" for name in FACTS])):
        return None
    batch = _ledger(spark, lake).agg(F.max("batch")).first()[0] + 1
    if artifacts_exist(spark, f"{lake}/pending/batch-{batch}/values"):
        done = _put_in_place(spark, lake, batch)
        further = refresh(spark, lake, run_id)
        return done if further is not None and further["files"] == 0 else further
    changes = settle(_changes(spark, lake, raw_files(spark, f"{lake}/raw")), "changes")
    kinds = {(r["source"], r["gone"], r["known"]) for r in
             changes.select("source", "gone", "known").distinct().toLocalIterator()}
    if not kinds:
        return {"files": 0, "batch": batch - 1, "partitions": []}
    if any(gone or source not in GROWING for source, gone, _ in kinds):
        return None
    if not _prepare(spark, lake, run_id, batch, changes.drop("gone", "known"),
                    any(known for *_, known in kinds)):
        return None
    return _put_in_place(spark, lake, batch)


def _prepare(spark: SparkSession, lake: str, run_id: str, batch: int, changes: DataFrame,
             replaces: bool) -> bool:
    """Land the files and write the new partitions aside; False if the facts lack a column.

    Only where a file replaces rows (``replaces``) are the students before and after compared: what
    is just added says itself whom it touches, and no period goes.
    """
    gold, pending = f"{lake}/gold", f"{lake}/pending/batch-{batch}"
    before = settle(_ledger(spark, lake).filter("batch > 0").groupBy("file")
                    .agg(F.max("batch").alias("batch")), "landed-before")
    new = changes.select("file").withColumn("batch", F.lit(batch))
    landed = settle(new.unionByName(before.join(new, "file", "left_anti")), "landed")
    old_students = _students(spark, lake, before) if replaces else None
    parts = []
    for source, read in GROWING.items():
        paths = [file_pattern(r["file"]) for r in changes.filter(F.col("source") == source)
                 .select("file").orderBy("file").toLocalIterator()]
        if paths:
            parts.append(normalize_columns(read(spark, paths)))
    rows = normalize_columns(with_silver_audit(union_all(parts, allow_missing=True),
                                               "estudiantes", run_id))
    rows = rows.withColumn("batch", F.lit(batch))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
     .parquet(f"{lake}/silver/estudiantes_landings"))

    students = _students(spark, lake, landed)
    fact = spark.read.parquet(f"{gold}/{FACTS[0]}")
    if set(students.columns) - set(fact.columns):
        return False
    last_before = fact.agg(F.max("semestre_orden")).first()[0]
    if replaces:
        last = _last_semester(spark, students)
        mine = [s.join(new, s["source_file"] == new["file"], "left_semi").select("id")
                for s in (students, old_students)]
    else:
        added = (spark.read.schema(rows.schema).parquet(f"{lake}/silver/estudiantes_landings")
                 .filter(F.col("batch") == batch))
        last = max((x for x in (last_before, _last_semester(spark, added)) if x is not None),
                   default=None)
        mine = [added.select("id")]
    if last != last_before:  # targets that were open, or are again
        since = min(x for x in (last, last_before) if x is not None)
        mine.append(fact.filter(F.col("semestre_orden") >= since).select("id"))
    touched = settle(union_all(mine).distinct(), "touched")
    again = students.join(touched, same_entity(students, touched, "id"), "left_semi")
    calendar = literal_rows(spark, CALENDAR, CALENDAR_SCHEMA)
    part = period_fact(
        again, calendar, *[stored_dimension(spark, f"{gold}/{name}") for name in (
            "dim_divipola", "dim_pobreza_mpio", "dim_conectividad_mpio")],
        last=F.lit(last), spelled=students)
    for name in FACTS:
        shape = spark.read.parquet(f"{gold}/{name}")
        part = with_gold_audit(part, run_id)
        stage_rows(part.select(*[F.col(c) if c in part.columns
                                 else F.lit(None).cast(shape.schema[c].dataType).alias(c)
                                 for c in shape.columns]), "anio", f"{pending}/{name}")
        if name == FACTS[0]:  # the second fact is built from the first as written
            part = semester_fact(spark.read.schema(shape.schema).parquet(f"{pending}/{name}"))
    years = set()
    for name in FACTS:
        years |= set(stage_kept(spark, f"{gold}/{name}", touched, "id", "anio",
                                f"{pending}/{name}"))
    changes.write.mode("overwrite").parquet(f"{pending}/files")
    literal_rows(spark, [(y,) for y in sorted(years)], "anio int").write.mode(
        "overwrite").parquet(f"{pending}/values")
    return True


def _put_in_place(spark: SparkSession, lake: str, batch: int) -> dict[str, Any]:
    pending = f"{lake}/pending/batch-{batch}"
    years = sorted(r["anio"] for r in spark.read.parquet(f"{pending}/values").collect())
    for name in FACTS:
        apply_replacement(spark, f"{lake}/gold/{name}", f"{pending}/{name}", "anio", years)
    files = spark.read.parquet(f"{pending}/files")
    n = files.count()
    (files.withColumn("batch", F.lit(batch)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{lake}/ledger"))
    delete_path(spark, pending)
    return {"files": n, "batch": batch, "partitions": years}
