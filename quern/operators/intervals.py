"""Interval work as sweeps over start and end events: no pair is ever formed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.ordered import Ordered, position, running, shift, total


def cover_counts(intervals: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """How many closed intervals [start, end] hold each point ``at`` of its key."""
    step = lambda df, at, kind, n: df.groupBy(*keys, F.col(at).alias("at")).agg(
        F.sum(F.lit(n)).cast("bigint").alias("_d")).withColumn("_kind", F.lit(kind))
    asked = points.select(*keys, "at").distinct().withColumn("_d", F.lit(0).cast("bigint")).withColumn(
        "_kind", F.lit(1))
    events = step(intervals, "start", 0, 1).unionByName(asked).unionByName(step(intervals, "end", 2, -1))
    o = Ordered(events, keys, ["at", "_kind"], settle=True).scan(n=running("sum", "_d"))
    return o.rows().filter(F.col("_kind") == 1).select(*keys, "at", "n")


def merge(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Union of overlapping or touching intervals per key."""
    distinct = intervals.groupBy(*keys, "start").agg(F.max("end").alias("end"))
    o = Ordered(distinct, keys, ["start"], settle=True).scan(_reach=running("max", "end", before=True))
    island = F.when(F.col("_reach").isNull() | (F.col("start") > F.col("_reach")), 1).otherwise(0)
    o = o.scan(_island=running("sum", island.cast("bigint")))
    return o.rows().groupBy(*keys, "_island").agg(
        F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def max_concurrent(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Most intervals [start, end) open at one time; an end frees its place first."""
    deltas = intervals.select(*keys, F.col("start").alias("at"), F.lit(1).alias("_d")).unionByName(
        intervals.select(*keys, F.col("end").alias("at"), F.lit(-1).alias("_d")))
    net = deltas.groupBy(*keys, "at").agg(F.sum("_d").alias("_d"))
    o = Ordered(net, keys, ["at"], settle=True).scan(_open=running("sum", "_d"))
    return o.rows().groupBy(*keys).agg(F.max("_open").alias("rooms"))


def nearest_item(df: DataFrame, keys: list[str], order: list[str], item: str, wanted: str) -> DataFrame:
    """Rows to the nearest row holding ``wanted``, before or after; -1 if none."""
    o = Ordered(df, keys, order).scan(_at=position())
    here = F.when(F.col(item) == wanted, F.col("_at"))
    o = o.scan(_back=running("max", here), _ahead=running("min", here, reverse=True))
    gap = F.least(F.col("_at") - F.col("_back"), F.col("_ahead") - F.col("_at"))
    return o.rows().withColumn("distance", F.coalesce(gap, F.lit(-1).cast("bigint"))).drop("_at", "_back", "_ahead")


def closest_pairs(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Neighbouring distinct values at the smallest distance of their key."""
    o = Ordered(df.select(*keys, value).distinct(), keys, [value]).scan(low=shift(value))
    gaps = o.rows().filter(F.col("low").isNotNull()).select(
        *keys, "low", F.col(value).alias("high"), (F.col(value) - F.col("low")).alias("gap"))
    o = Ordered(gaps, keys, ["high"], settle=True)
    best = o.scan(_best=total("min", "gap")).rows()
    return best.filter(F.col("gap") == F.col("_best")).drop("_best")
