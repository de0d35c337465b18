"""Certificates in which what wasn't measured neither helps nor hurts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.functions.geometry import clip
from motolake.operators.stats import exact_mean, renormalised
from motolake.settings import DEFAULT, Settings


def sync_integrity(drift_ms: Column, fps: Column) -> Column:
    """One less the drift in frame periods, at least 0; null if it wasn't measured."""
    return F.when(drift_ms.isNotNull(), F.greatest(1 - drift_ms / (1000 / F.coalesce(fps, F.lit(30.0))), F.lit(0.0)))


def calibration_completeness(frames: DataFrame, keys: list[str], pose: str, measured: bool = False) -> DataFrame:
    cap = 1.0 if measured else 0.3
    return frames.groupBy(*keys).agg((cap * (0.5 + 0.5 * F.avg(F.col(pose).isNotNull().cast("double")))).alias("calibration_completeness"))


def frame_confidence(confidence: str) -> Column:
    """Mean of a frame's map of confidences; null if it is empty."""
    values = F.map_values(confidence)
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values))


def perception_confidence(frames: DataFrame, keys: list[str], confidence: str) -> DataFrame:
    """Mean over frames of their means."""
    return frames.groupBy(*keys).agg(F.avg(frame_confidence(confidence)).alias("perception_confidence"))


def contact_consistency(frames: DataFrame, keys: list[str], contact: str, grasped: str, rig: str, rigs: DataFrame) -> DataFrame:
    """Share of frames on which any contact over one half agrees with the grasp; null on rigs that don't measure contact. rigs: rig, channel."""
    measures = rigs.filter("channel = 'contact'").select("rig").distinct()
    readings = F.flatten(F.transform(F.map_values(contact), lambda m: F.map_values(m)))
    agree = F.when(F.col(contact).isNotNull() & F.col(grasped).isNotNull(), (F.exists(readings, lambda x: x > 0.5) == F.col(grasped)).cast("double"))
    checked = frames.join(F.broadcast(measures), frames[rig] == measures["rig"], "left_semi").groupBy(*keys).agg(F.avg(agree).alias("contact_consistency"))
    return frames.select(*keys).distinct().join(checked, keys, "left")


def quality(s: Settings = DEFAULT) -> Column:
    """1 to 5 from the components that are known; 1 if none is."""
    return F.coalesce(clip(F.bround(renormalised(s.certificate_weights, (1.0, 5.0))).cast("int"), 1, 5), F.lit(1))


def notes(s: Settings = DEFAULT) -> Column:
    return F.filter(F.array(*(F.when(F.col(c).isNull(), F.lit(f"{c} not measured")) for c in s.certificate_weights)), lambda x: x.isNotNull())


def speed(frames: DataFrame, keys: list[str], t: str, s: Settings = DEFAULT) -> DataFrame:
    """1 fast, 2 normal, 3 slow by the span of time; null for fewer than two frames."""
    span = F.max(t) - F.min(t)
    return frames.groupBy(*keys).agg(F.when(F.count(t) >= 2, F.when(span < s.speed_fast_s, 1).when(span > s.speed_slow_s, 3).otherwise(2)).alias("speed"))


def mistakes(frames: DataFrame, keys: list[str], t: str, confidence: str, s: Settings = DEFAULT) -> DataFrame:
    """Windows from the first time on whose mean confidence is under the floor: window, start and end second, mean, flag."""
    known = frames.filter(F.col(confidence).isNotNull()).withColumn("_t0", F.min(t).over(Window.partitionBy(*keys)))
    w = s.mistake_window_s
    grouped = known.withColumn("window", F.floor((F.col(t) - F.col("_t0")) / w)).groupBy(*keys, "window").agg(exact_mean(confidence).alias("mean"))
    text = F.format_string("low_confidence@%.0fs-%.0fs(mean %.2f)", F.col("window") * w, (F.col("window") + 1) * w, F.col("mean"))
    return grouped.filter(F.col("mean") < s.mistake_floor).withColumn("start_s", F.col("window") * w).withColumn("flag", text)


def mistake_flags(frames: DataFrame, keys: list[str], t: str, confidence: str, s: Settings = DEFAULT) -> DataFrame:
    """flags of mistakes in order; confidence is a frame's map. Keys without a flag are missing."""
    found = mistakes(frames.withColumn("_mean", frame_confidence(confidence)), keys, t, "_mean", s)
    return found.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("window", "flag"))), lambda x: x["flag"]).alias("flags"))


def certificates(parts: list[DataFrame], keys: list[str], s: Settings = DEFAULT) -> DataFrame:
    """Components of parts, joined on keys, with quality and notes; components that no part has are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, keys, "full")
    for c in s.certificate_weights:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("double"))
    return out.withColumn("quality", quality(s)).withColumn("notes", notes(s))
