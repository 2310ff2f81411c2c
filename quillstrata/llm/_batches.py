"""Arrow batches of texts, taken in slices of bounded size."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 8 << 20
#: Bytes of an Arrow batch between Spark and its Python workers: both sides hold a few of them for each core.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's bound on Arrow batches (64 MB if it wasn't set) to BATCH_BYTES; rows longer than that have a batch of their own."""
    size, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)b?\s*", spark.conf.get(BATCH_SETTING, "64m").lower()).groups()
    if not 0 < int(size) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit] <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of batch whose column holds about limit bytes each; one long value is a part of its own."""
    start, held = 0, 0
    for i, value in enumerate(batch.column(column)):
        size = value.as_buffer().size if value.is_valid else 0
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's values; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def encoded(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's values in UTF-8; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Free memory goes back to the system: a worker lives on after its task, beside those of other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc
        pass


def map_texts(df: DataFrame, column: str, schema: T.StructType, build: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], limit: int = SLICE_BYTES) -> DataFrame:
    """df in slices through build()(slice); build runs once a task, on the executor."""

    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = build()
        for batch in batches:
            for part in slices(batch, column, limit):
                yield apply(part)
        apply = batch = part = None
        give_back()

    return df.mapInArrow(run, schema)


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and text alone: other columns, and clashes with their names, play no part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def crc_of_id(column: str = "doc_id") -> F.Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))
