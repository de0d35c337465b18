"""How sure a threshold decision is, as column expressions in [0, 1]."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from motolake.functions.geometry import clip
from motolake.settings import DEFAULT, Settings


def margin(actual: Column, threshold: Column | float, scale: float | None = None) -> Column:
    """0 at the threshold, 1 a scale (the threshold's own size unless given) away from it."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    size = F.lit(float(scale)) if scale is not None else F.abs(threshold)
    size = F.when(size <= 1e-9, F.lit(1.0)).otherwise(size)
    return clip(F.abs(actual - threshold) / size, 0.0, 1.0)


def signal_to_noise(value: Column, w: WindowSpec, s: Settings = DEFAULT) -> Column:
    """Peak over deviation in a window, between a floor and 1; the floor for fewer than two or all-zero samples."""
    peak = F.max(F.abs(value)).over(w)
    ratio = peak / (F.stddev_pop(value).over(w) + 1e-9) / s.snr_reference
    return F.when((F.count(value).over(w) < 2) | (peak <= 1e-9), F.lit(s.snr_floor)).otherwise(clip(ratio, s.snr_floor, 1.0))


def landmark(hands_detected: Column, dominant_confidence: Column) -> Column:
    """The dominant hand's own confidence, one half where no hand says."""
    return F.when(F.coalesce(hands_detected, F.lit(False)), F.coalesce(dominant_confidence, F.lit(0.5))).otherwise(F.lit(0.5))


def windowed(value: Column, extreme: Column, threshold: float, w: WindowSpec, s: Settings = DEFAULT, least: int = 1) -> Column:
    """Margin of a window's extreme times its signal to noise; 0 for too few samples."""
    return F.when(F.count(value).over(w) >= least, margin(extreme, threshold) * signal_to_noise(value, w, s)).otherwise(F.lit(0.0))


def finger_vote(count: Column, mean_change: Column, landmark_confidence: Column) -> Column:
    """Votes away from three of five, weighed by the mean angle change of those that voted."""
    vote = margin(count.cast("double"), 3.0, 2.0)
    return vote * F.coalesce(clip(mean_change / 0.3, 0.0, 1.0), F.lit(1.0)) * landmark_confidence
