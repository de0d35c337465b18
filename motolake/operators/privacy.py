"""Text regions found by recognition, and how long they stay covered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motolake.operators import windows as win
from motolake.settings import DEFAULT, Settings


def tier(confidence: Column, s: Settings = DEFAULT) -> Column:
    """ignore, blur_and_flag or blur."""
    return F.when(confidence < s.ocr_min, "ignore").when(confidence < s.ocr_blur, "blur_and_flag").when(confidence.isNotNull(), "blur")


def tier_counts(detections: DataFrame, keys: list[str], confidence: str, s: Settings = DEFAULT) -> DataFrame:
    named = ("ignore", "blur_and_flag", "blur")
    return detections.withColumn("_tier", tier(F.col(confidence), s)).groupBy(*keys).agg(*(F.count_if(F.col("_tier") == t).alias(t) for t in named))


def active_regions(frames: DataFrame, keys: list[str], frame: str, seen: str, s: Settings = DEFAULT) -> DataFrame:
    """Whether a region is covered on a frame: it was seen at most the grace period ago. keys name the region."""
    last = F.last(F.when(F.col(seen), F.col(frame)), ignorenulls=True).over(win.upto(keys, [frame]))
    return frames.withColumn("last_seen", last).withColumn("active", F.coalesce(F.col(frame) - F.col("last_seen") <= s.ocr_grace, F.lit(False)))


def polygon_box(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: F.get(p, 0)), F.transform(points, lambda p: F.get(p, 1))
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def histogram_similarity(crops: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Correlation of two histograms given as rows of bins; 0 without a reference."""
    return crops.groupBy(*keys).agg(F.coalesce(F.corr(a, b), F.lit(0.0)).alias("similarity"))
