"""Bounded training samples, the same rows at every run and for any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batches import texts_of


def sample_texts(keys: DataFrame, docs: DataFrame, by: str, slots: int, chars: int) -> list[tuple]:
    """(by, doc_id, text) of at most `slots` documents for each value of `by`, in an order by hash of the id.

    Of a longer text a stretch of `chars` characters is taken, which starts at a place that the id's hash tells.

    keys: doc_id and by. Each doc_id falls into one of `slots` slots by its hash, and the least hash of a slot is taken:
    two sums of longs with map-side combine, then a join with at most slots * values rows, a proven bound for the broadcast.
    """
    slotted = keys.where(F.col(by).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), by).withColumn("_hash", F.xxhash64("doc_id"))
    least = slotted.groupBy(by, F.pmod("_hash", F.lit(slots)).alias("_slot")).agg(F.min("_hash").alias("_hash"))
    chosen = slotted.join(F.broadcast(least.select(by, "_hash")), [by, "_hash"]).groupBy("doc_id").agg(F.min(by).alias(by))
    start = F.lit(1) + F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.lit(1), F.length("text") - chars + 1)).cast("int")
    texts = texts_of(docs).join(F.broadcast(chosen), "doc_id").select(by, "doc_id", F.substr("text", start, F.lit(chars)).alias("text"))
    found = texts.groupBy("doc_id").agg(F.min(by).alias(by), F.min("text").alias("text")).withColumn("_order", F.xxhash64("doc_id", F.lit("order")))
    rows = sorted((tuple(r) for r in found.select(by, "_order", "doc_id", "text").collect() if r["text"]), key=lambda r: r[:3])
    return [(value, doc_id, text) for value, _, doc_id, text in rows]
