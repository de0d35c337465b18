"""Quality checks of a session and their composite."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motolake.functions.geometry import clip
from motolake.settings import DEFAULT, Settings


def fps_consistency(frames: DataFrame, keys: list[str], t: str, claimed: str | None = None, s: Settings = DEFAULT) -> DataFrame:
    """Mean, median, deviation and largest frame interval in ms, dropped frames, measured rate, and whether it fits the claimed one."""
    dt = ((F.col(t) - F.lag(t).over(Window.partitionBy(*keys).orderBy(t))) * 1000).alias("dt")
    said = F.col(claimed) if claimed else F.lit(None).cast("double")
    gaps = frames.select(*keys, said.alias("_claimed"), dt).filter("dt is not null")
    stats = gaps.groupBy(*keys).agg(F.avg("dt").alias("mean_ms"), F.percentile("dt", 0.5).alias("median_ms"), F.stddev_pop("dt").alias("std_ms"), F.max("dt").alias("max_ms"), F.max("_claimed").alias("claimed_fps"))
    drops = gaps.join(stats, keys).groupBy(*keys).agg(F.count_if((F.col("median_ms") > 0) & (F.col("dt") > 1.5 * F.col("median_ms"))).alias("dropped"))
    out = stats.join(drops, keys).withColumn("measured_fps", F.when(F.col("median_ms") > 0, 1000 / F.col("median_ms")).otherwise(0.0))
    wrong = F.coalesce((F.col("claimed_fps") > 0) & (F.col("measured_fps") > 0) & (F.abs(F.col("measured_fps") - F.col("claimed_fps")) > s.fps_rtol * F.col("measured_fps")), F.lit(False))
    return out.withColumn("mismatch", wrong).withColumn("passed", (F.col("std_ms") <= s.fps_std_ms) & ~F.col("mismatch"))


def sync_gate(stats: DataFrame, drift: str = "max_drift_clean_ms", fallback: str = "max_drift_ms", missing: str = "missing", duration_s: str = "duration_s", median_ms: str = "median_dt_ms", s: Settings = DEFAULT) -> DataFrame:
    """Whether the drift of healthy frames and the share of missing samples stay in bounds."""
    gate = F.coalesce(F.col(drift), F.col(fallback), F.lit(999.0))
    expected = F.greatest(F.col(duration_s) * 1000 / F.col(median_ms) + 1, F.lit(1.0))
    share = F.when(F.col(missing).isNotNull() & (F.col(median_ms) > 0), F.col(missing) / expected)
    return stats.withColumn("gate_ms", gate).withColumn("missing_fraction", share).withColumn("passed", (F.col("gate_ms") <= s.drift_limit_ms) & F.coalesce(F.col("missing_fraction") <= s.missing_limit, F.lit(True)))


def sampled_check(frames: DataFrame, keys: list[str], frame: str, value: str, least: float, s: Settings = DEFAULT) -> DataFrame:
    """Mean, least and number below a limit of a value on every qa_stride-th frame; no such frame fails."""
    seen = frames.filter((F.col(frame) % s.qa_stride == 0) & F.col(value).isNotNull())
    out = seen.groupBy(*keys).agg(F.avg(value).alias("score"), F.min(value).alias("lowest"), F.count_if(F.col(value) < least).alias("below"), F.count(F.lit(1)).alias("checked"))
    return out.withColumn("passed", F.col("score") >= least)


def composite(df: DataFrame, blur: str, coverage: str, fps_std: str, drift: str, passed: list[str], s: Settings = DEFAULT) -> DataFrame:
    """qa_score, 0 to 100, and whether all checks passed."""
    parts = (clip(F.col(blur) / 200, 0.0, 1.0), clip(F.col(coverage) / 2, 0.0, 1.0), clip(1 - F.col(fps_std) / 20, 0.0, 1.0), clip(1 - F.col(drift) / 10, 0.0, 1.0))
    score = sum((w * p for w, p in zip(s.qa_weights, parts, strict=True)), F.lit(0.0)) * 100
    every = F.lit(True)
    for p in passed:
        every = every & F.coalesce(F.col(p), F.lit(False))
    return df.withColumn("qa_score", score).withColumn("overall_passed", every)


def mount_plausibility(frames: DataFrame, keys: list[str], mode: str, gyro: list[str], s: Settings = DEFAULT) -> DataFrame:
    """Whether a stream moves as its declared mount would: peak, share of fast frames, plausible, reason. gyro in rad/s."""
    size = F.degrees(F.sqrt(sum((F.col(g) * F.col(g) for g in gyro), F.lit(0.0))))
    stats = frames.groupBy(*keys, mode).agg(F.max(size).alias("peak_deg_s"), F.avg((size > s.snap_deg_s).cast("double")).alias("fast_fraction"))
    head = (F.col(mode) == "head_mounted") & (F.col("fast_fraction") > s.snap_fraction)
    wrist = (F.col(mode) == "wrist_mounted") & (F.col("peak_deg_s") < s.still_peak_deg_s) & (F.col("fast_fraction") < s.still_spike_fraction)
    reason = F.when(head, "moves like a wrist").when(wrist, "as still as a head")
    return stats.withColumn("reason", reason).withColumn("plausible", reason.isNull())
