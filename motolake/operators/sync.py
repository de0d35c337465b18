"""Putting an irregular sensor stream on the video clock, with what is made up kept apart from what was measured.

samples: keys, t and channels; frames: keys, frame index and t, both in seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.operators import asof
from motolake.settings import DEFAULT, Settings


def clock_domain(t_ms: Column, s: Settings = DEFAULT) -> Column:
    return F.when(t_ms >= s.epoch_floor_ms, "epoch").when(t_ms.between(0, s.uptime_ceiling_ms), "uptime").otherwise("ambiguous")


def overlap(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """Common length of two ranges, at least 0."""
    return F.greatest(F.least(end, other_end) - F.greatest(start, other_start), F.lit(0.0))


def anchor(df: DataFrame, created: str, t0: str, t1: str, duration_s: str, now: str, s: Settings = DEFAULT) -> DataFrame:
    """Where a video starts on the sensor's clock: recording_start_ms, its source, whether it was validated, and an error.

    A creation time counts if it lies after 2000 and not after now. It is an error if clocks are of
    different kinds or the video and the stream have no time in common. Without one the stream's start
    is used, which no drift can validate.
    """
    kind, mine = clock_domain(F.col(t0), s), clock_domain(F.col(created), s)
    plausible = F.coalesce((F.col(created) >= s.epoch_floor_ms) & (F.col(created) <= F.col(now)), F.lit(False))
    common = overlap(F.col(created), F.col(created) + 1000 * F.col(duration_s), F.col(t0), F.col(t1))
    error = F.when(plausible & (kind != mine), "clock domains differ").when(plausible & (common <= 0), "no common range")
    return df.withColumn("anchor_error", error).withColumn("recording_start_ms", F.when(plausible, F.col(created)).otherwise(F.col(t0))).withColumn("anchor_source", F.when(plausible, "creation_time").otherwise("stream_start")).withColumn("anchor_validated", plausible & error.isNull())


def stream_stats(samples: DataFrame, keys: list[str], t: str) -> DataFrame:
    """Median and largest interval in ms, and about how many samples are missing, per key: two passes over the intervals."""
    gaps = samples.select(*keys, ((F.col(t) - F.lag(t).over(Window.partitionBy(*keys).orderBy(t))) * 1000).alias("dt")).filter("dt is not null")
    medians = gaps.groupBy(*keys).agg(F.percentile("dt", 0.5).alias("median_dt_ms"), F.max("dt").alias("max_gap_ms"))
    lost = F.greatest(F.bround(F.try_divide(F.col("dt"), F.col("median_dt_ms"))) - 1, F.lit(0.0))
    return gaps.join(medians, keys).groupBy(*keys, "median_dt_ms", "max_gap_ms").agg(F.sum(F.when(F.col("median_dt_ms") > 0, lost).otherwise(0.0)).cast("long").alias("missing"), F.count(F.lit(1)).alias("intervals"))


def synchronise(frames: DataFrame, samples: DataFrame, keys: list[str], t: str, channels: list[str], optional: list[str] = (), s: Settings = DEFAULT, latency: str | None = None) -> DataFrame:
    """Frames with interpolated channels, drift_ms to the nearest sample, outside_range and over_dropout.

    A frame is over a dropout if the gap around it is longer than dropout_factor medians and it isn't
    next to a sample. Optional channels use the samples in which they were measured, null without any.
    latency, a column of milliseconds, shifts the frames' clock first.
    """
    if latency:
        frames = frames.withColumn(t, F.col(t) + F.coalesce(F.col(latency), F.lit(0.0)) / 1000)
    gaps = asof.with_gaps(samples.withColumnRenamed(t, "_ts"), keys, "_ts")
    found = asof.neighbours(frames, gaps, keys, t, "_ts", [*channels, "gap"])
    x = F.col(t).cast("double")
    found = found.select("*", *(asof.lerp(x, c).alias(c) for c in channels))
    found = found.withColumn("drift_ms", asof.distance(x) * 1000).withColumn("outside_range", F.col("before").isNull() | F.col("after").isNull())
    stats = stream_stats(samples, keys, t).select(*keys, "median_dt_ms")
    found = found.join(stats, keys, "left")
    # the gap that ends at an exact hit is the one the frame closes
    around = F.when(F.col("before.t") == F.col("after.t"), F.lit(0.0)).otherwise(F.col("before.gap")) * 1000
    fabricated = ~F.col("outside_range") & (F.col("median_dt_ms") > 0) & (around > s.dropout_factor * F.col("median_dt_ms")) & (F.col("drift_ms") > s.near_sample * F.col("median_dt_ms"))
    out = found.withColumn("over_dropout", F.coalesce(fabricated, F.lit(False))).drop("before", "after", "median_dt_ms")
    for c in optional:
        out = asof.interpolate_measured(out, samples.withColumnRenamed(t, "_ts"), keys, t, "_ts", c)
    return out


def drift_stats(synced: DataFrame, keys: list[str], s: Settings = DEFAULT) -> DataFrame:
    """Largest and mean drift of all frames and of the healthy ones, which are all if none is; frames far from a sample."""
    healthy = ~F.col("over_dropout") & ~F.col("outside_range")
    good = F.when(healthy, F.col("drift_ms"))
    return synced.groupBy(*keys).agg(
        F.max("drift_ms").alias("max_drift_ms"),
        F.avg("drift_ms").alias("mean_drift_ms"),
        F.coalesce(F.max(good), F.max("drift_ms")).alias("max_drift_clean_ms"),
        F.coalesce(F.avg(good), F.avg("drift_ms")).alias("mean_drift_clean_ms"),
        F.count_if(F.col("drift_ms") > s.dropout_frame_ms).alias("dropout_frames"),
        F.count_if("over_dropout").alias("interpolated_frames"),
        F.count_if("outside_range").alias("outside_frames"),
    )


def worst(synced: DataFrame, by: str, order: list[str], k: int = 5) -> DataFrame:
    return synced.orderBy(F.desc(by), *order).limit(k)


def group_by_frame(samples: DataFrame, keys: list[str], frame: str, n_frames: str, channels: list[str]) -> DataFrame:
    """Mean of each channel per frame and whether the frame had no sample; a 1-based frame number is shifted. n_frames is a column of the number of frames.

    Numbers are 1-based if none is under 1 and one reaches n_frames. Frames without samples are filled
    by interpolation over the index.
    """
    span = samples.groupBy(*keys).agg(F.min(frame).alias("_low"), F.max(frame).alias("_high"), F.max(n_frames).alias("_n"))
    shift = F.when((F.col("_low") >= 1) & (F.col("_high") >= F.col("_n")), 1).otherwise(0)
    finite = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c))
    means = samples.join(span.select(*keys, shift.alias("_shift")), keys).withColumn("frame_idx", F.col(frame) - F.col("_shift")).groupBy(*keys, "frame_idx").agg(*(F.avg(finite(c)).alias(c) for c in channels), F.count(F.lit(1)).alias("samples"))
    grid = span.filter("_n > 0").select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n").cast("long") - 1)).alias("frame_idx"))
    out = grid.join(means, [*keys, "frame_idx"], "left").withColumn("dropout", F.col("samples").isNull()).withColumn("samples", F.coalesce("samples", F.lit(0)))
    for c in channels:
        out = asof.fill_missing(out, keys, "frame_idx", c, c)
    return out


def frame_clocks(samples: DataFrame, keys: list[str], frame: str, video_t: str, t: str) -> DataFrame:
    """Median video time of a frame's samples, and the sample nearest to it."""
    medians = samples.groupBy(*keys, frame).agg(F.percentile(video_t, 0.5).alias("video_t"))
    return samples.select(*keys, frame, t).join(medians, [*keys, frame]).groupBy(*keys, frame, "video_t").agg(F.min_by(t, F.struct(F.abs(F.col(t) - F.col("video_t")), F.col(t))).alias("sample_t"))


def on_frame_grid(samples: DataFrame, keys: list[str], t_ns: str, n_frames: str, fps: str, channels: list[str], s: Settings = DEFAULT) -> DataFrame:
    """Channels interpolated on the grid t0 + i * 1e9 / fps, with dropout and outside flags."""
    heads = samples.groupBy(*keys).agg(F.min(t_ns).alias("_t0"), F.max(n_frames).alias("_n"), F.max(fps).alias("_fps"))
    grid = heads.filter("_n > 0").select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n").cast("long") - 1)).alias("frame_idx"), "_t0", "_fps")
    grid = grid.select(*keys, "frame_idx", ((F.col("frame_idx") / F.col("_fps")) + F.lit(0.0)).alias("t"), "_t0")
    rel = samples.join(heads.select(*keys, "_t0"), keys).withColumn("t", (F.col(t_ns) - F.col("_t0")) / 1e9)
    return synchronise(grid.drop("_t0"), rel, keys, "t", channels, s=s)


def checked_pts(frames: DataFrame, keys: list[str], frame: str, pts: str, late_s: float = 0.2) -> DataFrame:
    """Presentation times from 0; late marks a gap of over 200 ms; it is an error if they don't increase."""
    w = Window.partitionBy(*keys).orderBy(frame)
    step = F.col(pts) - F.lag(pts).over(w)
    checked = frames.withColumn("_step", step)
    value = F.when(F.coalesce(F.col("_step") <= 0, F.lit(False)), F.raise_error(F.lit("presentation times must increase")).cast("double")).otherwise(F.col(pts) - F.first(pts).over(w))
    return checked.withColumn("late", F.coalesce(F.col("_step") > late_s, F.lit(False))).withColumn(pts, value).drop("_step")
