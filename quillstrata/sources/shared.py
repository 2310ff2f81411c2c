"""Folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is named (local tests)."""
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_SETTING, None) or spark.conf.get(CHECKPOINT_SETTING, None)
    if context._jsc.sc().getCheckpointDir().isDefined():
        return context._jsc.sc().getCheckpointDir().get()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quillstrata-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read back: later jobs neither recompute it nor lose it with an executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: as safe as cut(), in less space."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by stored(), once what was made of them is stored itself."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go when it ends: what is kept is stored in tables, not in them."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)
