"""Append-only logs as file streams (STR1, STR3, STR4, STR7, STR9). One file is one append: a stream takes whole files."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.catalog import Store
from ..sources.shared import shared_dir


def replay(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """STR1: the log's files as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", "*").format(fmt).load(path)


def run_once(stream: DataFrame, mode: str = "append", place: str | None = None) -> DataFrame:
    """All that is there now and that a run at the same place hasn't seen, through the stream with a checkpoint, into a table in the shared folder."""
    spark = stream.sparkSession
    out = place or f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def replayed(spark: SparkSession, path: str, schema: T.StructType, place: str) -> DataFrame:
    """STR1: all events of a log so far. What earlier runs at `place` have read is not read again, unless a file that they
    read is gone or has become shorter: then the whole log is replayed at a new place."""
    store = Store(spark)
    files = {f.name: f.size for f in store.listed(path)}
    seen = json.loads(store.text(f"{place}/seen.json") or '{"run": 0, "files": {}}')
    run = seen["run"] + any(files.get(name, -1) < size for name, size in seen["files"].items())
    out = run_once(replay(spark, path, schema), place=f"{place}/run{run}")
    store.write_text(f"{place}/seen.json", json.dumps({"run": run, "files": files}))
    return out


def latest(events: DataFrame, keys: list[str], at: str) -> DataFrame:
    """STR7: the last event of each key, in append order."""
    rest = [c for c in events.columns if c not in (*keys, at)]
    return events.groupBy(*keys).agg(F.max(F.struct(at, *rest)).alias("_e")).select(*keys, *[F.col(f"_e.{c}").alias(c) for c in (at, *rest)])


def without_repeats(events: DataFrame, keys: list[str], at: str, decision: list[str]) -> DataFrame:
    """STR7: events that change the decision before them; saying the same again is no event."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*keys).orderBy(at)
    before = F.lag(F.struct(*decision)).over(w)
    return events.withColumn("_b", before).where(F.col("_b").isNull() | ~F.struct(*decision).eqNullSafe(F.col("_b"))).drop("_b")


def unseen(texts: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """STR4, JON9: work that a permanent store lacks."""
    return texts.join(store, key, "left_anti").dropDuplicates([key])


def windowed(events: DataFrame, ts: str, length: str, late: str, keys: list[str]) -> DataFrame:
    """An extension: counts in tumbling windows, late rows dropped past the watermark."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, length), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")
