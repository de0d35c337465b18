"""Twelve motion primitives and their confidences per frame, from a wrist sensor, from vision or from both.

Input: one row per (keys, frame) with

- t; ax, ay, az in g; gx, gy, gz in rad/s;
- hands_detected, dominant_hand; right_hand, left_hand: struct(confidence, landmarks: 21 x 3); null where
  there is no such hand;
- derived: struct(thumb_index_dist, fingertip_dists: 5, wrist_velocity: 2, wrist_velocity_magnitude);
- objects: array of struct(centroid_norm, confidence, class_label), null where tracking has no record;
- power_grasp_dist, lateral_pinch_dist: thresholds (see grasp_thresholds).

All windows of a key share one partitioning and order, so a session is sorted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motolake.functions import confidence as sure
from motolake.functions import geometry as geo
from motolake.operators import windows as win
from motolake.settings import DEFAULT, FINGER_JOINTS, FINGERTIPS, PRIMITIVES, Settings

VOTED = ("wrist_pronate", "wrist_supinate", "wrist_flex", "contact_onset", "contact_release")


def grasp_thresholds(sessions: DataFrame, profiles: DataFrame | None = None, s: Settings = DEFAULT) -> DataFrame:
    """Sessions with power_grasp_dist, lateral_pinch_dist and their source: worker profile, then glove, then default."""
    factor = F.coalesce(F.element_at(F.create_map(*(x for k, v in s.glove_factors.items() for x in (F.lit(k), F.lit(v)))), F.coalesce("glove_type", F.lit("none"))), F.lit(1.0))
    out = sessions.withColumn("_grasp", F.round(s.grasp_dist * factor, 6)).withColumn("_pinch", F.round(s.pinch_dist * factor, 6))
    if profiles is not None:
        own = profiles.select("worker_id", F.col("power_grasp_dist").alias("_own_grasp"), F.col("lateral_pinch_dist").alias("_own_pinch"))
        out = out.join(own, "worker_id", "left")
    else:
        out = out.withColumn("_own_grasp", F.lit(None).cast("double")).withColumn("_own_pinch", F.lit(None).cast("double"))
    source = F.when(F.col("_own_grasp").isNotNull(), "worker").when(F.coalesce("glove_type", F.lit("none")) != "none", "glove").otherwise("default")
    return out.withColumn("power_grasp_dist", F.coalesce("_own_grasp", "_grasp")).withColumn("lateral_pinch_dist", F.coalesce("_own_pinch", "_pinch")).withColumn("threshold_source", source).drop("_grasp", "_pinch", "_own_grasp", "_own_pinch")


def worker_thresholds(frames: DataFrame, keys: list[str], pose: str, spread: str, pinch: str, least: int = 10) -> DataFrame:
    """Thresholds of a worker from calibration frames: half way between the closed and the open hand; null with too few frames of a kind.

    pose says open, closed or pinch; spread is the mean fingertip distance, pinch that of thumb and index.
    """
    is_ = lambda p: F.col(pose) == p
    counts = {p: F.count_if(is_(p)) >= least for p in ("open", "closed", "pinch")}
    grasp = (F.max(F.when(is_("open"), F.col(spread))) + F.min(F.when(is_("closed"), F.col(spread)))) / 2
    near = (F.max(F.when(is_("open"), F.col(pinch))) + F.min(F.when(is_("pinch"), F.col(pinch)))) / 2
    return frames.groupBy(*keys).agg(F.when(counts["open"] & counts["closed"], grasp).alias("power_grasp_dist"), F.when(counts["open"] & counts["pinch"], near).alias("lateral_pinch_dist"))


def frame_rate(df: DataFrame, keys: list[str], frame: str, t: str, s: Settings = DEFAULT) -> DataFrame:
    """fps of each frame from the time since the last; the session's mean where that isn't positive or there is none."""
    w = win.over(keys, [frame])
    dt = F.col(t) - F.lag(t).over(w)
    marked = df.withColumn("_dt", dt)
    from pyspark.sql import Window

    mean = 1 / F.avg(F.when(F.col("_dt") > 0, F.col("_dt"))).over(Window.partitionBy(*keys))
    return marked.withColumn("fps", F.coalesce(F.when(F.col("_dt") > 0, 1 / F.col("_dt")), mean, F.lit(s.fps_nominal))).drop("_dt")


def hand_of(side: Column) -> Column:
    return F.when(side == "left", F.col("left_hand")).when(side == "right", F.col("right_hand"))


def finger_angles(landmarks: Column) -> Column:
    """Array of the joint angles of index, middle, ring, pinky, thumb; null for joints that aren't there."""
    return F.array(*(F.when(F.size(landmarks) > max(j), geo.joint_angle(F.get(landmarks, j[0]), F.get(landmarks, j[1]), F.get(landmarks, j[2]))) for j in FINGER_JOINTS.values()))


def palm_angles(landmarks: Column) -> Column:
    """Rotation and elevation of the vector from the wrist to the middle knuckle."""
    body = lambda v: F.struct(F.atan2(geo.at(v, 1), geo.at(v, 0)).alias("roll"), F.atan2(geo.at(v, 2), F.hypot(geo.at(v, 0), geo.at(v, 1))).alias("pitch"))
    return geo.let(geo.minus(F.get(landmarks, 9), F.get(landmarks, 0)), body)


def wrist_velocity(df: DataFrame, keys: list[str], frame: str, x: str, y: str, dt: str) -> DataFrame:
    """Velocity of the wrist since the frame before, 0 unless both frames have a hand."""
    w = win.over(keys, [frame])
    both = F.coalesce(F.col("hands_detected") & F.lag("hands_detected").over(w), F.lit(False))
    speed = lambda c: F.when(both, F.try_divide(F.col(c) - F.lag(c).over(w), F.col(dt))).otherwise(F.lit(0.0))
    out = df.withColumn("vx", F.coalesce(speed(x), F.lit(0.0))).withColumn("vy", F.coalesce(speed(y), F.lit(0.0)))
    return out.withColumn("speed", F.hypot("vx", "vy"))


def features(df: DataFrame, keys: list[str], frame: str, s: Settings = DEFAULT) -> DataFrame:
    """Per-frame quantities that detectors and confidences share."""
    w = win.over(keys, [frame])
    out = frame_rate(df, keys, frame, "t", s)
    seen = F.coalesce(F.col("hands_detected"), F.lit(False))
    dominant = F.when(seen, hand_of(F.col("dominant_hand")))
    out = out.withColumn("_seen", seen).withColumn("_hand", dominant)
    out = out.withColumn("accel_mag", F.sqrt(F.col("ax") ** 2 + F.col("ay") ** 2 + F.col("az") ** 2)).withColumn("gyro_mag_deg", F.degrees(F.sqrt(F.col("gx") ** 2 + F.col("gy") ** 2 + F.col("gz") ** 2)))
    out = out.withColumn("gyro_x_deg", F.degrees("gx")).withColumn("gyro_z_deg", F.degrees("gz"))
    out = out.withColumn("_landmark", sure.landmark(F.col("_seen"), F.col("_hand.confidence")))
    # the hand that is dominant now, in the frame before
    before = F.struct(F.lag("_seen").over(w).alias("seen"), F.lag("left_hand").over(w).alias("left_hand"), F.lag("right_hand").over(w).alias("right_hand"))
    out = out.withColumn("_before", before)
    then = F.when(F.col("dominant_hand") == "left", F.col("_before.left_hand")).when(F.col("dominant_hand") == "right", F.col("_before.right_hand"))
    out = out.withColumn("_both", F.coalesce(F.col("_seen") & F.col("_before.seen"), F.lit(False))).withColumn("_then", F.when(F.col("_both"), then))
    change = F.zip_with(finger_angles(F.col("_hand.landmarks")), finger_angles(F.col("_then.landmarks")), lambda a, b: a - b)
    out = out.withColumn("_change", F.when(F.col("_hand.landmarks").isNotNull() & F.col("_then.landmarks").isNotNull(), change))
    enough = (F.size("_hand.landmarks") > 9) & (F.size("_then.landmarks") > 9)
    out = out.withColumn("_now_palm", palm_angles(F.col("_hand.landmarks"))).withColumn("_then_palm", palm_angles(F.col("_then.landmarks")))
    rate = lambda part: F.when(enough, F.degrees(geo.wrap_angle(F.col(f"_now_palm.{part}") - F.col(f"_then_palm.{part}"))) * F.col("fps"))
    out = out.withColumn("rotation_deg_s", rate("roll")).withColumn("flexion_deg_s", rate("pitch"))
    known = F.col("_seen") & F.col("derived").isNotNull()
    out = out.withColumn("_known", F.coalesce(known, F.lit(False))).withColumn("_speed", F.when(F.col("_known"), F.coalesce("derived.wrist_velocity_magnitude", F.lit(0.0))).otherwise(0.0))
    tips = F.filter(F.array(*(F.get(F.col("_hand.landmarks"), i) for i in FINGERTIPS)), lambda p: p.isNotNull())
    nearest = geo.let(tips, lambda p: F.when(F.size(p) > 0, geo.let(geo.mean_point(p), lambda m: geo.nearest_object(m, F.col("objects")))))
    return out.withColumn("_nearest", F.when(F.col("objects").isNotNull() & F.col("_hand").isNotNull(), nearest))


def _shared(keys: list[str], frame: str, s: Settings) -> dict[str, Column]:
    """Primitives that do not depend on the sensor mode."""
    trail = win.rows(keys, [frame], -9, 0)
    dists = F.col("derived.fingertip_dists")
    angle = F.when(F.col("_known") & (F.col("_speed") > 0.01), F.atan2(F.get(F.col("derived.wrist_velocity"), 1), F.get(F.col("derived.wrist_velocity"), 0)))
    steady = F.hypot(F.avg(F.cos(angle)).over(trail), F.avg(F.sin(angle)).over(trail))
    change = F.col("_change")
    votes = lambda sign: F.size(F.filter(change, lambda d: d * sign > 0))
    return {
        "reach_onset": F.col("_both") & F.col("_known") & (F.col("_speed") > s.reach_speed) & (F.get(F.col("derived.wrist_velocity"), 0) > 0),
        "power_grasp": F.col("_known") & (F.size(dists) >= 5) & F.forall(dists, lambda d: d < F.col("power_grasp_dist")),
        "lateral_pinch": F.col("_known") & (F.coalesce("derived.thumb_index_dist", F.lit(999.0)) < F.col("lateral_pinch_dist")),
        "finger_curl": change.isNotNull() & (votes(-1) >= 3),
        "finger_extend": change.isNotNull() & (votes(1) >= 3),
        "transport": (F.count(F.lit(1)).over(trail) >= 5) & (F.count_if(F.col("_speed") > s.reach_speed).over(trail) >= 6) & (F.count(angle).over(trail) >= 3) & F.coalesce(steady > 0.707, F.lit(False)),
    }


def peak_then_drop(window: Column, threshold: float) -> Column:
    """Whether the largest of an array is over a threshold, not the last, and the last is smaller."""
    top = F.array_max(window)
    return (F.size(window) >= 3) & (top > threshold) & (F.array_position(window, top) < F.size(window)) & (F.element_at(window, -1) < top)


def wrist_flags(df: DataFrame, keys: list[str], frame: str, s: Settings = DEFAULT) -> DataFrame:
    """Columns w_<primitive> from the wrist sensor."""
    around = win.rows(keys, [frame], -2, 2)
    two = F.least(F.lit(2), F.count(F.lit(1)).over(around))
    out = df.withColumn("w_contact_onset", peak_then_drop(F.collect_list("accel_mag").over(around), s.contact_g))
    recent = F.coalesce(F.max(F.col("w_contact_onset")).over(win.rows(keys, [frame], -10, -1)), F.lit(False))
    mean = F.avg("accel_mag").over(around)
    flags = _shared(keys, frame, s) | {
        "wrist_pronate": F.count_if(F.col("gyro_z_deg") > s.pronate_deg_s).over(around) >= two,
        "wrist_supinate": F.count_if(F.col("gyro_z_deg") < s.supinate_deg_s).over(around) >= two,
        "wrist_flex": F.count_if(F.col("gyro_x_deg") > s.flex_deg_s).over(around) >= two,
        "contact_release": recent & (mean < s.release_g),
        "idle": (mean < s.idle_accel) & (F.col("_speed") < s.idle_speed),
    }
    return out.select("*", *(F.coalesce(v, F.lit(False)).alias(f"w_{k}") for k, v in flags.items()))


def vision_flags(df: DataFrame, keys: list[str], frame: str, s: Settings = DEFAULT) -> DataFrame:
    """Columns v_<primitive> from landmarks, object tracks and, for standing still, a head sensor."""
    around = win.rows(keys, [frame], -2, 2)
    shared = _shared(keys, frame, s)
    out = df.select("*", *(F.coalesce(v, F.lit(False)).alias(f"v_{k}") for k, v in shared.items()))
    out = out.withColumn("_grasping", F.col("v_power_grasp") | F.col("v_lateral_pinch"))
    touch = F.when(F.col("objects").isNotNull(), F.col("_grasping") & F.coalesce(F.col("_nearest.distance") < s.contact_dist, F.lit(False)))
    out = out.withColumn("_touch", touch)
    out = win.edges(out, keys, [frame], "_touch").withColumnRenamed("onset", "_touch_on").withColumnRenamed("release", "_touch_off")
    # without a record of objects the grasp's own edges stand in; thresholds are the session's, so the frame before is its flag
    was = F.coalesce(F.lag("_grasping").over(win.over(keys, [frame])), F.lit(False))
    out = out.withColumn("_was", was)
    tracked = F.col("objects").isNotNull()
    flags = {
        "wrist_pronate": F.col("rotation_deg_s") > s.pronate_deg_s,
        "wrist_supinate": F.col("rotation_deg_s") < s.supinate_deg_s,
        "wrist_flex": F.abs("flexion_deg_s") > s.flex_deg_s,
        "contact_onset": F.when(tracked, F.col("_touch_on")).otherwise(F.col("_grasping") & ~F.col("_was")),
        "contact_release": F.when(tracked, F.col("_touch_off")).otherwise(~F.col("_grasping") & F.col("_was")),
        "idle": (F.avg("accel_mag").over(around) < s.head_idle_accel) & (F.avg("gyro_mag_deg").over(around) < s.head_idle_gyro),
    }
    out = out.select("*", *(F.coalesce(v, F.lit(False)).alias(f"v_{k}") for k, v in flags.items()))
    return out.drop("_touch", "_touch_on", "_touch_off", "_was")


def vote(df: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Columns f_<primitive>: weighted votes on what both modes derive on their own, the wrist's flags else; and disagreement."""
    score = lambda p: s.vision_weight * F.col(f"v_{p}").cast("int") + s.imu_weight * F.col(f"w_{p}").cast("int")
    clash = F.lit(False)
    for p in VOTED:
        clash = clash | ((F.col(f"v_{p}") != F.col(f"w_{p}")) & (F.abs(score(p) - 0.5) < s.vote_margin))
    return df.select("*", *((score(p) >= 0.5 if p in VOTED else F.col(f"w_{p}")).alias(f"f_{p}") for p in PRIMITIVES), clash.alias("disagreement"))


def _shared_confidences(keys: list[str], frame: str, s: Settings) -> dict[str, Column]:
    trail = win.rows(keys, [frame], -9, 0)
    dists, thumb = F.col("derived.fingertip_dists"), F.col("derived.thumb_index_dist")
    zero = F.lit(0.0)
    landmark = F.col("_landmark")
    angle = F.when(F.col("_known") & (F.col("_speed") > 0.01), F.atan2(F.get(F.col("derived.wrist_velocity"), 1), F.get(F.col("derived.wrist_velocity"), 0)))
    steady = F.hypot(F.avg(F.cos(angle)).over(trail), F.avg(F.sin(angle)).over(trail))
    direction = F.when(F.count(angle).over(trail) >= 3, sure.margin(steady, 0.707, 0.3)).otherwise(zero)
    count = sure.margin(F.count_if(F.col("_speed") > s.reach_speed).over(trail).cast("double"), 6.0, 4.0)
    speed = F.avg(sure.margin(F.col("_speed"), s.reach_speed)).over(trail)
    trust = F.coalesce(F.avg(F.when(F.col("_known"), landmark)).over(trail), F.lit(0.5))
    change = F.col("_change")

    def votes(sign: int) -> Column:
        moved = F.filter(change, lambda d: d * sign > 0)
        mean = F.when(F.size(moved) > 0, F.aggregate(moved, F.lit(0.0), lambda a, d: a + F.abs(d)) / F.size(moved))
        return F.when(change.isNotNull(), sure.finger_vote(F.size(moved), mean, landmark)).otherwise(zero)

    return {
        "reach_onset": F.when(F.col("_both") & F.col("_known"), sure.margin(F.col("_speed"), s.reach_speed) * landmark).otherwise(zero),
        "power_grasp": F.when(F.col("_known") & (F.size(dists) >= 5), sure.margin(F.array_max(dists), F.col("power_grasp_dist")) * landmark).otherwise(zero),
        "lateral_pinch": F.when(F.col("_known") & thumb.isNotNull(), sure.margin(thumb, F.col("lateral_pinch_dist")) * landmark).otherwise(zero),
        "finger_curl": votes(-1),
        "finger_extend": votes(1),
        "transport": F.when(F.count(F.lit(1)).over(trail) >= 5, F.least(count, direction, speed) * trust).otherwise(zero),
    }


def wrist_confidences(df: DataFrame, keys: list[str], frame: str, s: Settings = DEFAULT) -> DataFrame:
    """Columns wc_<primitive>."""
    w = win.rows(keys, [frame], -2, 2)
    z, x, a = F.col("gyro_z_deg"), F.col("gyro_x_deg"), F.col("accel_mag")
    mean = F.avg(a).over(w)
    out = _shared_confidences(keys, frame, s) | {
        "wrist_pronate": sure.windowed(z, F.max(z).over(w), s.pronate_deg_s, w, s),
        "wrist_supinate": sure.windowed(z, F.min(z).over(w), s.supinate_deg_s, w, s),
        "wrist_flex": sure.windowed(x, F.max(x).over(w), s.flex_deg_s, w, s),
        "contact_onset": sure.windowed(a, F.max(a).over(w), s.contact_g, w, s, least=3),
        "contact_release": sure.windowed(a, mean, s.release_g, w, s),
        "idle": F.least(sure.margin(mean, s.idle_accel), sure.margin(F.col("_speed"), s.idle_speed)),
    }
    return df.select("*", *(F.coalesce(v, F.lit(0.0)).alias(f"wc_{k}") for k, v in out.items()))


def vision_confidences(df: DataFrame, keys: list[str], frame: str, s: Settings = DEFAULT) -> DataFrame:
    """Columns vc_<primitive>."""
    w = win.rows(keys, [frame], -2, 2)
    zero, landmark = F.lit(0.0), F.col("_landmark")
    turn = lambda v, t: F.when(v.isNotNull(), sure.margin(v, t) * landmark).otherwise(zero)
    touched = F.coalesce(sure.margin(F.col("_nearest.distance"), s.contact_dist) * F.coalesce(F.col("_nearest.object.confidence"), zero), zero)
    contact = F.when(F.col("objects").isNotNull(), touched).otherwise(0.6 * landmark)
    still = F.least(sure.margin(F.avg("accel_mag").over(w), s.head_idle_accel), sure.margin(F.avg("gyro_mag_deg").over(w), s.head_idle_gyro))
    out = _shared_confidences(keys, frame, s) | {
        "wrist_pronate": turn(F.col("rotation_deg_s"), s.pronate_deg_s),
        "wrist_supinate": turn(F.col("rotation_deg_s"), s.supinate_deg_s),
        "wrist_flex": turn(F.abs("flexion_deg_s"), s.flex_deg_s),
        "contact_onset": contact,
        "contact_release": contact,
        "idle": still * sure.signal_to_noise(F.col("accel_mag"), w, s),
    }
    return df.select("*", *(F.coalesce(v, zero).alias(f"vc_{k}") for k, v in out.items()))


#: Sensor mode: name of the strategy.
STRATEGIES = {"head_mounted": "vision_primary", "none": "vision_primary", "wrist_mounted": "wrist_primary", "dual": "fusion"}


def detect(df: DataFrame, keys: list[str], frame: str, mode: str, s: Settings = DEFAULT) -> DataFrame:
    """keys, frame, t, twelve flags after the minimum duration, active_primitives, twelve confidences c_<primitive>, disagreement, primitive_source."""
    if mode not in STRATEGIES:
        raise ValueError(f"unknown sensor mode {mode!r}: one of {', '.join(STRATEGIES)}")
    strategy = STRATEGIES[mode]
    out = features(df, keys, frame, s)
    if strategy != "vision_primary":
        out = wrist_confidences(wrist_flags(out, keys, frame, s), keys, frame, s)
    if strategy != "wrist_primary":
        out = vision_confidences(vision_flags(out, keys, frame, s), keys, frame, s)
    if strategy == "fusion":
        out = vote(out, s)
        raw, conf = "f_", {p: (s.vision_weight * F.col(f"vc_{p}") + s.imu_weight * F.col(f"wc_{p}")) if p in VOTED else F.col(f"wc_{p}") for p in PRIMITIVES}
    else:
        raw = "w_" if strategy == "wrist_primary" else "v_"
        conf = {p: F.col(f"{raw[0]}c_{p}") for p in PRIMITIVES}
        out = out.withColumn("disagreement", F.lit(False))
    out = out.select(*keys, frame, "t", "fps", "accel_mag", "gyro_z_deg", "disagreement", *(F.col(raw + p).alias("_raw_" + p) for p in PRIMITIVES), *(F.round(c, 4).alias("c_" + p) for p, c in conf.items()))
    for p in PRIMITIVES:
        least = s.contact_min_frames if p.startswith("contact_") else s.min_frames
        out = win.min_duration(out, keys, [frame], "_raw_" + p, least, p) if least > 1 else out.withColumn(p, F.col("_raw_" + p))
    active = F.filter(F.array(*(F.when(F.col(p), F.lit(p)) for p in PRIMITIVES)), lambda x: x.isNotNull())
    return out.drop(*("_raw_" + p for p in PRIMITIVES)).withColumn("active_primitives", active).withColumn("primitive_source", F.lit(strategy))
