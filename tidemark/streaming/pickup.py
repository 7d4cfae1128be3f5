"""Incremental pick-up of new raw files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.artifacts import artifacts_exist


def pick_up_new_files(spark: SparkSession, source: str, target: str, checkpoint: str,
                      schema: str | T.StructType, file_format: str = "csv",
                      options: dict[str, str] | None = None,
                      transform: Callable[[DataFrame], DataFrame] | None = None,
                      max_files: int | None = None) -> DataFrame:
    """Process the files that arrived since the last call, then stop; returns the target table.

    Files seen before are remembered by the checkpoint. A batch overwrites its own ``batch``
    partition, so a batch that is repeated after a failure leaves no duplicates. As long as no file
    has arrived the table is empty.
    """
    reader = spark.readStream.schema(schema).format(file_format).options(**(options or {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(source)
    if transform:
        stream = transform(stream)

    def write_batch(rows: DataFrame, batch: int) -> None:
        (rows.withColumn("batch", F.lit(batch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target))

    query = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if not artifacts_exist(spark, target):
        return spark.createDataFrame([], stream.schema).withColumn("batch", F.lit(0))
    return spark.read.parquet(target)
