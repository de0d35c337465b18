"""From primitives to phases, and from phases to episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.operators import windows as win
from motolake.settings import DEFAULT, PHASE_PRIMITIVES, Settings


def phase(flag=F.col) -> Column:
    """Phase of a frame by its primitives, the first rule that holds; flag gives a primitive's column."""
    f = lambda name: F.coalesce(flag(name), F.lit(False))
    grasp, turn = f("power_grasp") | f("lateral_pinch"), f("wrist_pronate") | f("wrist_supinate") | f("wrist_flex")
    return (
        F.when(turn & grasp, "active_manipulation")
        .when(f("contact_release"), "release")
        .when(grasp & ~f("contact_onset"), "grasp")
        .when(f("reach_onset") & ~grasp & ~f("contact_onset"), "reach")
        .when(f("transport") & ~grasp, "reposition")
        .otherwise("idle")
    )


def phase_confidence(label: str) -> Column:
    """Mean confidence of the phase's primitives that fired, of all of them if none did."""
    out = F.lit(0.0)
    for name, primitives in PHASE_PRIMITIVES.items():
        fired = sum((F.col(p).cast("int") for p in primitives), F.lit(0))
        of_fired = sum((F.when(F.col(p), F.col(f"c_{p}")).otherwise(0.0) for p in primitives), F.lit(0.0))
        of_all = sum((F.col(f"c_{p}") for p in primitives), F.lit(0.0)) / len(primitives)
        out = F.when(F.col(label) == name, F.when(fired > 0, of_fired / fired).otherwise(of_all)).otherwise(out)
    return out


def smooth(df: DataFrame, keys: list[str], frame: str, label: str, s: Settings = DEFAULT, out: str = "phase") -> DataFrame:
    """Short gaps between equal labels filled, then short runs given to their left neighbour."""
    by_run = win.runs(df, keys, [frame], label)
    filled = win.fill_gaps(by_run, keys, label, s.gap_fill)
    ends = F.sum("n").over(win.upto(keys, ["run"]))
    spans = filled.withColumn("_end", ends).select(*keys, F.col(label).alias("_filled"), (F.col("_end") - F.col("n") + 1).alias("_start"), "_end")
    numbered = df.withColumn("_place", F.row_number().over(win.over(keys, [frame])))
    from motolake.operators.intervals import contained

    merged = contained(numbered, spans, keys, "_place", "_start", "_end", ["_filled"]).drop("_place")
    return win.fill_short_runs(merged, keys, [frame], "_filled", s.phase_min, out).drop("_filled")


def label(primitives: DataFrame, keys: list[str], frame: str, s: Settings = DEFAULT) -> DataFrame:
    """Primitive frames with raw_phase, phase and phase_confidence."""
    raw = primitives.withColumn("raw_phase", phase())
    return smooth(raw, keys, frame, "raw_phase", s).withColumn("phase_confidence", phase_confidence("phase"))


def phase_counts(df: DataFrame, keys: list[str], label: str, segments: DataFrame) -> DataFrame:
    """Frames and segments of every phase, zeros too."""
    from motolake.settings import PHASES

    every = df.select(*keys).distinct().withColumn("phase", F.explode(F.array(*(F.lit(p) for p in PHASES))))
    frames = df.groupBy(*keys, F.col(label).alias("phase")).agg(F.count(F.lit(1)).alias("frames"))
    segs = segments.groupBy(*keys, "phase").agg(F.count(F.lit(1)).alias("segments"))
    return every.join(frames, [*keys, "phase"], "left").join(segs, [*keys, "phase"], "left").fillna(0, ["frames", "segments"])


def episodes(segments: DataFrame, keys: list[str], name: str, s: Settings = DEFAULT) -> DataFrame:
    """Episodes of each key: spans between long idle segments, without short ones; the whole key if none is long enough.

    segments: keys, phase, start_frame, end_frame, start_sec, end_sec. Returns keys, episode_id
    (<name>_epNN), start and end frame and second, duration_sec, segments.
    """
    gap = (F.col("phase") == "idle") & (F.col("end_sec") - F.col("start_sec") > s.episode_gap_s)
    spans = [F.min("start_frame").alias("start_frame"), F.max("end_frame").alias("end_frame"), F.min("start_sec").alias("start_sec"), F.max("end_sec").alias("end_sec"), F.count(F.lit(1)).alias("segments")]
    groups = win.sessions(segments, keys, ["start_frame"], gap).groupBy(*keys, "group").agg(*spans)
    kept = groups.filter(F.col("end_sec") - F.col("start_sec") >= s.episode_min_s).drop("group")
    whole = segments.groupBy(*keys).agg(*spans).join(kept.select(*keys).distinct(), keys, "left_anti")
    found = kept.unionByName(whole)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("start_frame")) - 1
    return found.withColumn("episode_idx", number).withColumn("episode_id", F.format_string("%s_ep%02d", F.col(name).cast("string"), "episode_idx")).withColumn("duration_sec", F.round(F.col("end_sec") - F.col("start_sec"), 4))
