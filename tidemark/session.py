"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders of the scratch scopes that are open, innermost last.
_open_scopes: list[str] = []


def local_session(app: str = "tidemark", cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A local session for tests and trials; a cluster brings its own.

    ``shared`` becomes ``spark.checkpoint.dir``, the folder of intermediate tables.
    """
    builder = SparkSession.builder
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = (
        builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local trial that names none gets a folder under ``spark.local.dir``; on a cluster a
    folder of the driver would be out of reach for the executors, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{spark.conf.get('spark.local.dir', '/tmp').rstrip('/')}/tidemark-shared"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses.

    All paths of an application share one sub-folder, which may be dropped when it has ended;
    those of an open :func:`scratch` are dropped with it.
    """
    app = spark.sparkContext.applicationId
    scope = f"/{_open_scopes[-1]}" if _open_scopes else ""
    return f"{shared_dir(spark)}/tidemark-{app}{scope}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables of the block are deleted when it ends; what it returns must not read
    them any more."""
    name = f"scope-{uuid.uuid4().hex}"
    folder = f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}/{name}"
    _open_scopes.append(name)
    try:
        yield
    finally:
        _open_scopes.remove(name)
        delete_path(spark, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system, if it is there."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """A folder of any file system; nothing happens if it is there."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(there)


def replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """Move folder ``new`` to the place of ``old``; if ``new`` has no files, ``old`` is removed.

    Without a folder ``new`` nothing happens. Both are on one file system.
    """
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (new, old))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(source):
        return
    files.delete(target, True)
    if not len(files.listStatus(source)):
        files.delete(source, True)
    elif not files.rename(source, target):
        raise OSError(f"could not move {new} to {old}")


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Used for aggregated tables that several branches read. It cuts the lineage
    (the branches do not scan the facts again, and a lost executor loses nothing)
    and gives Catalyst the true size of the table, so a later join broadcasts it
    only when it is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
    sort-merges, where AQE splits hot keys.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
