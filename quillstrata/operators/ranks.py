"""Ranks, quantiles and spreads from counts of distinct values, without a task that holds a group (WIN3, WIN4, AGG10, AGG11).

Counts of distinct values are dealt out by ranges of group and value, so that a group of any size lies in several tasks.
Sums of whole ranges, a row for each range and group in it, give every range its offset; within a range a running sum does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import stored


def beside(rows: DataFrame, of_group: DataFrame, group: list[str], *columns: str) -> DataFrame:
    """rows with columns of their group's row, nulls being a group; without a group that is one row for all."""
    if not group:
        return rows.join(F.broadcast(of_group.select(*columns)), how="left")
    there = of_group.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], *columns)
    return rows.join(there, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)], "left").select(*rows.columns, *columns)


def cumulated(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """group, value, _c (rows with the value), _before (rows with lesser values) and _total (rows of the group); nulls are left out."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_c"))
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(counts.repartitionByRange(ranges, *group, value).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy(*group, "_range").agg(F.sum("_c").alias("_in"))
    of_group = W.partitionBy(*group)
    offsets = sums.select(*group, "_range", (F.sum("_in").over(of_group.orderBy("_range")) - F.col("_in")).alias("_offset"), F.sum("_in").over(of_group).alias("_total"))
    both = beside(ranged, offsets, [*group, "_range"], "_offset", "_total")
    running = F.sum("_c").over(W.partitionBy(*group, "_range").orderBy(value)) - F.col("_c")
    return both.select(*group, value, "_c", (F.col("_offset") + running).alias("_before"), "_total")


def percentile_rank(rows: DataFrame, group: list[str], value: str, name: str = "pct") -> DataFrame:
    """WIN3: mean rank of ties over the number of rows, null for null."""
    ranked = cumulated(rows, group, value).select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col(value).alias("_v"), ((F.col("_before") + (F.col("_c") + 1) / 2) / F.col("_total")).alias(name))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    return rows.join(ranked, [*same, F.col(value) == F.col("_v")], "left").select(*rows.columns, name)


def quantiles(rows: DataFrame, group: list[str], value: str, shares: list[float], name: str = "q") -> DataFrame:
    """AGG10: group and an array of quantiles, interpolated linearly between the two nearest rows."""
    c = cumulated(rows, group, value)

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_before") <= place) & (place < F.col("_before") + F.col("_c")), F.col(value).cast("double")))

    places = [(F.col("_total") - 1) * F.lit(float(q)) for q in shares]
    sides = [e for i, p in enumerate(places) for e in (at(F.floor(p)).alias(f"_l{i}"), at(F.ceil(p)).alias(f"_h{i}"), F.max(p - F.floor(p)).alias(f"_s{i}"))]
    found = c.groupBy(*group).agg(*sides)
    return found.select(*group, F.array(*[F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * F.col(f"_s{i}") for i in range(len(shares))]).alias(name))


def medians(rows: DataFrame, group: list[str], value: str, name: str = "med") -> DataFrame:
    return quantiles(rows, group, value, [0.5], "_q").select(*group, F.col("_q")[0].alias(name))


def robust_spread(rows: DataFrame, group: list[str], value: str, factor: float = 1.4826) -> DataFrame:
    """AGG11: group, median and `factor` times the median absolute deviation."""
    med = medians(rows, group, value, "_med")
    apart = beside(rows, med, group, "_med").select(*group, "_med", F.abs(F.col(value) - F.col("_med")).alias("_d"))
    spread = medians(apart, [*group, "_med"], "_d", "spread")
    return spread.select(*group, F.col("_med").alias("med"), (F.col("spread") * factor).alias("spread"))


def robust_z(rows: DataFrame, group: list[str], value: str, name: str = "z") -> DataFrame:
    """SCO5, SCO6: distance from the group's median in spreads; null where the spread is 0."""
    s = robust_spread(rows, group, value)
    return beside(rows, s, group, "med", "spread").withColumn(name, F.try_divide(F.col(value) - F.col("med"), F.col("spread"))).drop("spread")
