"""Interval joins inside a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contained(points: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, carry: list[str]) -> DataFrame:
    """Points inside a span, with the span's columns carried along. Spans of a key must not overlap.

    One sort per key: the last span that starts at or before a point is the only one that can hold it.
    """
    struct = F.struct(F.col(start).alias("_start"), F.col(end).alias("_end"), *(F.col(c).alias(c) for c in carry))
    span_type = spans.select(struct.alias("s")).schema["s"].dataType
    point_type = points.select(F.struct("*").alias("p")).schema["p"].dataType
    left = spans.select(*keys, F.col(start).cast("double").alias("_at"), struct.alias("_span"), F.lit(None).cast(point_type).alias("_point"))
    right = points.select(*keys, F.col(at).cast("double").alias("_at"), F.lit(None).cast(span_type).alias("_span"), F.struct("*").alias("_point"))
    w = Window.partitionBy(*keys).orderBy("_at", F.col("_point").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = left.unionByName(right).withColumn("_held", F.last("_span", ignorenulls=True).over(w))
    inside = both.filter(F.col("_point").isNotNull() & (F.col(f"_point.{at}") <= F.col("_held._end")))
    return inside.select("_point.*", *(F.col(f"_held.{c}").alias(c) for c in carry))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, right_start: str, right_end: str) -> DataFrame:
    """Pairs of spans of a key that share a point. right's columns must have other names than left's, but for the keys."""
    return left.join(right, keys).filter((F.col(start) <= F.col(right_end)) & (F.col(end) >= F.col(right_start)))


def clamped(df: DataFrame, start: str, end: str, low: str, high: str) -> DataFrame:
    """Spans cut to a range; empty ones go."""
    cut = df.withColumn(start, F.greatest(start, low)).withColumn(end, F.least(end, high))
    return cut.filter(F.col(end) >= F.col(start))
