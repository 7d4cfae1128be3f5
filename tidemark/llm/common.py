"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space; ``bytes.split()`` cuts at the same places.
WORD = r"[^\x20\x09-\x0D]+"


def crc_fold(key: Column, folds: int) -> Column:
    """Fold number from 0: crc32 of the key as text, null for a null key."""
    return F.crc32(key.cast("string")) % folds


def word_count(text: Column) -> Column:
    """Number of words as a long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
                schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; the rows stay where they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)
    return df.mapInArrow(run, schema)


def utf8_values(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column one by one, empty for null."""
    for value in column.cast(pa.binary()) if not pa.types.is_binary(column.type) else column:
        yield value.as_py() or b""


def labelled(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """``key, label`` (0 or 1) of the keys that occur in ``docs``; one row per key.

    Keys or labels that are null take no part; contradicting labels of one key count as 1.
    """
    marks = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(key).agg(F.max((F.col(label) > 0).cast("int")).alias("label")))
    return marks.join(docs.select(key), key, "left_semi")
