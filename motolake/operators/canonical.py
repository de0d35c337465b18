"""Canonical frames and episodes: streams joined on the frame, states, actions in one camera frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.functions import geometry as geo


def grasp_scale(frames: DataFrame, keys: list[str], pinch: str, closed: float = 0.03, open_: float = 0.3) -> DataFrame:
    """Pinch distance of a closed and of an open hand per key: the 5th and 95th percentile, defaults where they don't differ."""
    p = frames.groupBy(*keys).agg(F.percentile(pinch, F.array(F.lit(0.05), F.lit(0.95))).alias("p"))
    apart = F.coalesce(F.col("p")[1] - F.col("p")[0] > 1e-6, F.lit(False))
    return p.select(*keys, F.when(apart, F.col("p")[0]).otherwise(closed).alias("closed"), F.when(apart, F.col("p")[1]).otherwise(open_).alias("open"))


def grasp(distance: Column, closed: Column, open_: Column) -> Column:
    """0 open to 1 closed; null without a distance."""
    return geo.clip(F.try_divide(open_ - distance, open_ - closed), 0.0, 1.0)


def wrist_pose(points: Column) -> Column:
    """Pose of the wrist from 21 points; null where the palm has no plane."""
    q = geo.palm_quaternion(points)
    return F.when(q.isNotNull(), geo.pose(F.get(points, 0), q))


def interaction(grasping: Column, side: Column, grasp_confidence: Column, speed: Column, transport: Column, idle: Column) -> Column:
    state = F.when(grasping & (side == "left"), "GRASPED_L").when(grasping, "GRASPED_R").when(F.coalesce(speed, F.lit(0.0)) > 0.01, "MOVING").otherwise("STATIC")
    sure = F.when(grasping, geo.clip(grasp_confidence, 0.0, 1.0)).when(F.coalesce(speed, F.lit(0.0)) > 0.01, transport).otherwise(idle)
    return F.struct(state.alias("state"), F.coalesce(sure, F.lit(0.0)).alias("confidence"))


def rig_of(glove: Column, mode: Column) -> Column:
    return F.when(F.coalesce(glove, F.lit("none")) != "none", "glove").when(mode == "wrist_mounted", "umi_gripper").otherwise("head_mounted")


def build(pose_3d: DataFrame, pose_2d: DataFrame, depth: DataFrame, primitives: DataFrame, on: list[str]) -> DataFrame:
    """Frames with metric points, each with what the other streams have for it; a stream's last record of a frame counts. Streams bring columns of different names."""
    out = pose_3d
    for stream in (pose_2d, depth, primitives):
        rest = [c for c in stream.columns if c not in on]
        single = stream.groupBy(*on).agg(*(F.last(c).alias(c) for c in rest))
        out = out.join(single, on, "left")
    return out


def from_perception(hands: DataFrame, depth: DataFrame, states: DataFrame, cameras: DataFrame, on: list[str]) -> DataFrame:
    """One row per frame of the hands: hands by side as a map, depth, state and camera where there are any."""
    by_side = hands.groupBy(*on).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("side", "hand")))).alias("hands"))
    return by_side.join(depth, on, "left").join(states, on, "left").join(cameras, on, "left")


def actions(frames: DataFrame, keys: list[str], frame: str, wrist: str, camera: str) -> DataFrame:
    """action: the wrist's pose of the next frame seen from this frame's camera; valid unless it is the last or a pose is missing; ego_contaminated without cameras."""
    w = Window.partitionBy(*keys).orderBy(frame)
    nxt, cam = F.lead(wrist).over(w), F.lead(camera).over(w)
    out = frames.withColumn("_next", nxt).withColumn("_camera", cam)
    moved = F.when(F.col(camera).isNull() & F.col("_next").isNotNull(), F.col("_next")).otherwise(geo.reproject(F.col("_next"), F.col(camera), F.col("_camera")))
    return out.withColumn("action", moved).withColumn("action_valid", F.col("action").isNotNull() & F.col(wrist).isNotNull()).withColumn("ego_contaminated", geo.ego_contaminated(F.col(camera))).drop("_next", "_camera")


def relative_rotations(gyro: DataFrame, keys: list[str], t: str, axes: list[str]) -> DataFrame:
    """Rotation to the next sample as a quaternion, by the trapezoid rule; the last has none."""
    w = Window.partitionBy(*keys).orderBy(t)
    dt = F.lead(t).over(w) - F.col(t)
    v = F.array(*(0.5 * (F.col(a) + F.lead(a).over(w)) * dt for a in axes))
    return gyro.withColumn("rotation", F.when(dt.isNotNull(), geo.axis_angle_to_quaternion(v)))


def cumulated_rotation(rotations: DataFrame, keys: list[str], order: str, rotation: str) -> DataFrame:
    """Product of a key's rotations in order, made a unit quaternion at every step: products don't commute, so it is a fold."""
    item = F.array_sort(F.collect_list(F.when(F.col(rotation).isNotNull(), F.struct(F.col(order).alias("o"), F.col(rotation).alias("q")))))
    return rotations.groupBy(*keys).agg(F.aggregate(item, geo.vector(1, 0, 0, 0), lambda a, e: geo.normalise(geo.multiply(a, e["q"]))).alias("orientation"))


def depth_for_keypoints(hands: DataFrame, samples: DataFrame, keys: list[str], least: int = 3) -> DataFrame:
    """Weighted median of root depths over keypoints; null for fewer than least. samples: keys, root_depth, confidence."""
    from motolake.operators.stats import weighted_median

    enough = samples.filter((F.col("confidence") > 0) & F.col("root_depth").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = weighted_median(samples, keys, "root_depth", "confidence", "depth").join(enough, keys)
    return hands.join(found.withColumn("depth", F.when(F.col("_n") >= least, F.col("depth"))).drop("_n"), keys, "left")


def smooth_depth(df: DataFrame, keys: list[str], frame: str, z: str, half: int = 3, out: str = "z_smooth") -> DataFrame:
    """Centred mean of a linearly filled series; unknown values stay unknown, short series as they are."""
    from motolake.operators.asof import fill_missing

    filled = fill_missing(df, keys, frame, z, "_filled")
    w = Window.partitionBy(*keys).orderBy(frame).rowsBetween(-half, half)
    n = F.count(z).over(Window.partitionBy(*keys))
    mean = F.avg("_filled").over(w)
    return filled.withColumn(out, F.when(F.col(z).isNull(), F.lit(None)).when(n < 2 * half + 1, F.col(z)).otherwise(mean)).drop("_filled")


def depth_consistency(tracks: DataFrame, keys: list[str], point: str, frame: str, depth: str) -> DataFrame:
    """Relative change of tracked points from frame to frame: median and 90th percentile, and the swing of frame medians over their median. Points must be seen on all frames."""
    frames = tracks.groupBy(*keys).agg(F.count_distinct(frame).alias("_frames"))
    whole = tracks.groupBy(*keys, point).agg(F.count(depth).alias("_n")).join(frames, keys).filter("_n = _frames").select(*keys, point)
    kept = tracks.join(whole, [*keys, point])
    before = F.lag(depth).over(Window.partitionBy(*keys, point).orderBy(frame))
    change = kept.withColumn("_c", F.abs(F.col(depth) - before) / before).groupBy(*keys).agg(F.percentile("_c", 0.5).alias("median_change"), F.percentile("_c", 0.9).alias("p90_change"))
    medians = kept.groupBy(*keys, frame).agg(F.percentile(depth, 0.5).alias("_m")).groupBy(*keys).agg(((F.max("_m") - F.min("_m")) / F.percentile("_m", 0.5)).alias("swing"))
    return change.join(medians, keys)


def wrist_jitter(df: DataFrame, keys: list[str], frame: str, z: str) -> DataFrame:
    """Deviation of first differences in millimetres."""
    step = F.col(z) - F.lag(z).over(Window.partitionBy(*keys).orderBy(frame))
    return df.withColumn("_d", step).groupBy(*keys).agg((F.stddev_pop("_d") * 1000).alias("jitter_mm"))


def compare_models(scores: DataFrame, model: str, wobble: str) -> DataFrame:
    """The model of least wobble, the first of equals."""
    return scores.agg(F.min_by(model, F.struct(F.col(wobble), F.col(model))).alias("winner"))


def apply_calibration(point: Column, scale: Column, rotation: Column, shift: Column) -> Column:
    return geo.plus(geo.scale(geo.rotate(rotation, point), scale), shift)


