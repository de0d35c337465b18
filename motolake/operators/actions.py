"""Atomic actions of each hand as intervals, from geometry alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.functions import geometry as geo
from motolake.operators import windows as win
from motolake.settings import DEFAULT, Settings


def verb(has_hand: Column, grasped: Column, before: Column, speed: Column, up: Column, near: Column, approaching: Column, s: Settings = DEFAULT) -> Column:
    """Verb of a frame; before is whether the hand grasped when last seen, null if it wasn't."""
    changed = before.isNotNull() & (before != grasped)
    still = speed < s.still_mps
    vertical = F.abs(up) >= s.vertical_fraction * speed
    return (
        F.when(~has_hand, "idle")
        .when(changed, F.when(grasped, "grasp").otherwise("release"))
        .when(grasped & still, "hold")
        .when(grasped & vertical & (up > 0), "lift")
        .when(grasped & vertical, F.when(near, "place").otherwise("lower"))
        .when(grasped, "transport")
        .when(~still & approaching, "reach")
        .otherwise("idle")
    )


def frame_verbs(frames: DataFrame, keys: list[str], s: Settings = DEFAULT, fps: float = 30.0) -> DataFrame:
    """frames: keys (with the side), frame_idx, t, wrist (3 numbers or null), has_hand, grasped, object_points (array of points). Adds verb and its confidence."""
    order = ["frame_idx"]
    past = win.upto(keys, order, -1)
    seen = F.when(F.col("wrist").isNotNull(), F.struct("wrist", "t", "object_points"))
    out = frames.withColumn("_here", seen).withColumn("_last", F.last("_here", ignorenulls=True).over(past))
    out = out.withColumn("_was", F.last(F.when(F.col("has_hand"), F.col("grasped")), ignorenulls=True).over(past))
    out = out.withColumn("_previous_objects", F.lag("object_points").over(win.over(keys, order)))
    both = F.col("_here").isNotNull() & F.col("_last").isNotNull()
    dt = F.greatest(F.coalesce(F.col("t") - F.col("_last.t"), F.lit(1 / fps)), F.lit(1e-3))
    velocity = geo.scale(geo.minus(F.col("wrist"), F.col("_last.wrist")), 1 / dt)
    far = F.lit(float("inf"))
    gap = lambda objects, at: F.coalesce(F.array_min(F.transform(objects, lambda o: geo.distance(o, at))), far)
    out = out.withColumn("_v", F.when(both, velocity)).withColumn("_near", F.when(both, gap(F.col("object_points"), F.col("wrist")))).withColumn("_was_near", F.when(both, gap(F.col("_previous_objects"), F.col("_last.wrist"))))
    speed, up = F.coalesce(geo.norm(F.col("_v")), F.lit(0.0)), F.coalesce(-geo.at(F.col("_v"), 1), F.lit(0.0))
    grasped = F.col("has_hand") & F.coalesce("grasped", F.lit(False))
    near, approaching = F.coalesce(F.col("_near") < s.near_object_m, F.lit(False)), F.coalesce(F.col("_near") < F.col("_was_near") - 1e-3, F.lit(False))
    out = out.withColumn("verb", verb(F.col("has_hand"), grasped, F.col("_was"), speed, up, near, approaching, s))
    out = out.withColumn("verb_confidence", F.when(F.col("verb").isin("idle", "hold", "grasp", "release"), 0.8).otherwise(0.55))
    return out.drop("_here", "_last", "_was", "_previous_objects", "_v", "_near", "_was_near")


def intervals(frames: DataFrame, keys: list[str], actor: str, s: Settings = DEFAULT) -> DataFrame:
    """Runs of verbs after the least dwell: action_label, actor, start and end frame and time, confidence; short ones only if they are a grasp or release."""
    steady = win.dwell(frames, keys, ["frame_idx"], "verb", s.dwell, "action_label")
    more = [F.min("frame_idx").alias("start_frame"), F.max("frame_idx").alias("end_frame"), F.min("t").alias("start_time"), F.max("t").alias("end_time"), F.avg("verb_confidence").alias("_c")]
    out = win.runs(steady, keys, ["frame_idx"], "action_label", more).filter((F.col("n") >= s.dwell) | F.col("action_label").isin("grasp", "release"))
    return out.withColumn("confidence", F.round(F.least(F.lit(0.99), F.greatest(F.lit(0.05), F.col("_c"))), 3)).withColumn("actor", F.col(actor)).drop("_c", "run")


def label_actions(frames: DataFrame, keys: list[str], side: str, s: Settings = DEFAULT, fps: float = 30.0) -> DataFrame:
    """Intervals of all hands of each key, numbered by start and actor; those of low confidence are flagged."""
    by_hand = [*keys, side]
    out = intervals(frame_verbs(frames, by_hand, s, fps), by_hand, side, s)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("start_frame", "actor"))
    return out.withColumn("interval", place).withColumn("flagged", F.col("confidence") <= s.review_confidence)


def too_sparse(frames: DataFrame, keys: list[str], t: str, fps: str) -> DataFrame:
    """Whether a key's largest gap is more than two frames, so that actions would be made up."""
    gap = F.col(t) - F.lag(t).over(Window.partitionBy(*keys).orderBy(t))
    return frames.withColumn("_gap", gap).groupBy(*keys).agg((F.coalesce(F.max("_gap"), F.lit(0.0)) > 2 / F.max(fps)).alias("skip"))
