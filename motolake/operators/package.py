"""Training datasets: nested labels, step tables, manifests, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.operators.consent import block_reason
from motolake.operators.stats import beside
from motolake.settings import DEFAULT, TIERS, Settings

CERTIFICATE = ("sync_integrity", "calibration_completeness", "perception_confidence", "contact_consistency", "ik_convergence_rate")


def nested_labels(episodes: DataFrame, tasks: DataFrame, segments: DataFrame, primitives: DataFrame, quality: DataFrame, keys: list[str], frame: str) -> DataFrame:
    """A row per episode: task, confidence, EIS, flags and sorted arrays of overlapping segments and of frames with primitives.

    episodes: keys, episode_id, start_frame, end_frame. Missing tasks are unknown with confidence 0.
    """
    spans = episodes.select(*keys, "episode_id", "start_frame", "end_frame")
    seg = segments.select(*keys, "phase", F.col("start_frame").alias("_s"), F.col("end_frame").alias("_e"), "mean_confidence")
    in_span = spans.join(seg, keys).filter((F.col("_s") <= F.col("end_frame")) & (F.col("_e") >= F.col("start_frame")))
    l2 = in_span.groupBy(*keys, "episode_id").agg(F.array_sort(F.collect_list(F.struct(F.col("_s").alias("start_frame"), F.col("_e").alias("end_frame"), "phase", "mean_confidence"))).alias("L2_phases"))
    active = primitives.filter(F.size("active_primitives") > 0).select(*keys, frame, "active_primitives")
    from motolake.operators.intervals import contained

    l3 = contained(active, spans, keys, frame, "start_frame", "end_frame", ["episode_id"]).groupBy(*keys, "episode_id").agg(F.array_sort(F.collect_list(F.struct(frame, "active_primitives"))).alias("L3_primitives"))
    on = [*keys, "episode_id"]
    out = episodes.join(tasks.select(*on, "L1_task", F.col("confidence").alias("L1_task_confidence")), on, "left").join(quality.select(*on, "eis", "flags"), on, "left").join(l2, on, "left").join(l3, on, "left")
    out = out.withColumn("L1_task", F.coalesce("L1_task", F.lit("unknown"))).withColumn("L1_task_confidence", F.coalesce("L1_task_confidence", F.lit(0.0))).withColumn("eis", F.coalesce("eis", F.lit(0)))
    for c in ("L2_phases", "L3_primitives", "flags"):
        kind = out.schema[c].dataType.simpleString()
        out = out.withColumn(c, F.coalesce(c, F.array().cast(kind)))
    return out


def batch_manifest(episodes: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row over episodes of sessions with redacted video: counts, hours, mean EIS over episodes, tasks as a map."""
    kept = episodes.join(sessions.filter("redacted").select("session_id"), "session_id", "left_semi")
    tasks = kept.groupBy("L1_task").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("L1_task", "count")))).alias("task_distribution"))
    totals = kept.agg(F.count_distinct("session_id").alias("sessions"), F.count(F.lit(1)).alias("episode_count"), F.coalesce(F.sum("duration_sec") / 3600, F.lit(0.0)).alias("total_duration_hours"), F.avg("eis").alias("mean_eis"))
    return beside(totals, tasks)


def manifest(episodes: DataFrame) -> DataFrame:
    """One row: counts, hours, scenes and demonstrators, how many are unknown, means of measured components, tiers and tasks as maps.

    Reads scene_id, demonstrator_id, task, tier, quality, effective_hours, n_frames and components.
    """
    unknown = lambda c: F.count_if(F.col(c).isNull())
    means = [F.avg(c).alias(f"mean_{c}") for c in (*CERTIFICATE, "quality") if c in episodes.columns]
    totals = episodes.agg(
        F.count(F.lit(1)).alias("episode_count"), F.sum("n_frames").alias("total_frames"), F.sum("effective_hours").alias("effective_hours"), F.count_distinct("scene_id").alias("scene_count"), F.count_distinct("demonstrator_id").alias("demonstrator_count"),
        unknown("scene_id").alias("unknown_scene"), unknown("demonstrator_id").alias("unknown_demonstrator"), *means,
    )

    def spread(c: str, none: str, out: str) -> DataFrame:
        return episodes.groupBy(F.coalesce(c, F.lit(none)).alias("k")).count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "count")))).alias(out))

    return beside(totals, spread("task", "<untasked>", "task_distribution"), spread("tier", "<unassigned>", "tier_distribution"))


def modality_inventory(frames: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Episodes that have a field on any frame, per field."""
    has = frames.groupBy(key).agg(*(F.max(F.col(f).isNotNull()).alias(f) for f in fields))
    return has.agg(*(F.count_if(F.col(f)).alias(f) for f in fields))


def tier(col: Column) -> Column:
    return F.coalesce(col, F.lit("stage1_volume"))


def tier_filter(episodes: DataFrame, wanted: str, col: str = "tier") -> DataFrame:
    """Episodes of stage1, stage2 or all."""
    names = {"all": TIERS, "stage1": TIERS[:1], "stage2": TIERS[1:], "stage1_volume": TIERS[:1], "stage2_anchor": TIERS[1:]}
    if wanted not in names:
        raise ValueError(f"unknown tier {wanted!r}")
    return episodes.filter(tier(F.col(col)).isin(*names[wanted]))


def steps(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds reward, discount, is_first, is_last, is_terminal."""
    w = Window.partitionBy(*keys)
    first = F.row_number().over(w.orderBy(order)) == 1
    last = F.row_number().over(w.orderBy(order)) == F.count(F.lit(1)).over(w)
    return df.select("*", F.lit(0.0).alias("reward"), F.lit(1.0).alias("discount"), first.alias("is_first"), last.alias("is_last"), last.alias("is_terminal"))


def step_episodes(df: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """A row per episode with its steps as a sorted array."""
    marked = steps(df, keys, order)
    return marked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *fields, "reward", "discount", "is_first", "is_last", "is_terminal"))).alias("steps"))


def aligned_robot_actions(frames: DataFrame, trajectories: DataFrame, key: str, frame: str) -> DataFrame:
    """Kept frames with their robot action: by frame if the trajectory is as long as the episode, by place if as long as the kept frames; else an error.

    frames: key, frame, kept. trajectories: key, trajectory (array of arrays).
    """
    n = frames.groupBy(key).agg(F.count(F.lit(1)).alias("_all"), F.count_if("kept").alias("_kept"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(frame)) - 1
    every = frames.withColumn("_all_place", place).filter("kept").withColumn("_kept_place", place)
    sized = trajectories.join(n, key).withColumn("_size", F.size("trajectory"))
    mode = F.when(F.col("_size") == F.col("_all"), "frame").when(F.col("_size") == F.col("_kept"), "place").otherwise(F.raise_error(F.lit("a trajectory fits neither the episode nor its kept frames")))
    rows = sized.select(key, mode.alias("_mode"), F.posexplode("trajectory").alias("_i", "robot_action"))
    on = (every[key] == rows[key]) & (rows["_i"] == F.when(rows["_mode"] == "frame", every["_all_place"]).otherwise(every["_kept_place"]))
    return every.join(rows, on).select(every[key], frame, "robot_action")


def training_table(frames: DataFrame, episodes: DataFrame, wanted_tier: str = "all") -> DataFrame:
    """Rows of valid frames of episodes that have a task and the tier: episode, frame index from 0, time, state, action, task."""
    kept = tier_filter(episodes.filter("task is not null"), wanted_tier).select("episode_id", "task")
    rows = frames.filter("action_valid").join(kept, "episode_id")
    place = F.row_number().over(Window.partitionBy("episode_id").orderBy("frame_idx")) - 1
    return rows.select("episode_id", place.alias("frame_index"), "frame_idx", "t", "state", "action", "task")


def refusals(episodes: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Episodes that may not be delivered, with the reason. Delivery needs this to be empty."""
    return episodes.withColumn("reason", block_reason(F.col("consent"), F.col("pii_status"), F.col("quality"), s)).filter("reason is not null")


def data_card(totals: dict, tasks: list[tuple[str, int]], title: str) -> str:
    """Markdown of a batch from its small aggregates."""
    lines = [f"# {title}", "", *(f"- **{k}**: {v}" for k, v in totals.items()), "", "| Task | Episodes |", "|---|---|"]
    return "\n".join([*lines, *(f"| {t} | {n} |" for t, n in sorted(tasks, key=lambda x: (-x[1], x[0])))]) + "\n"


def dof_names(has_mano: Column) -> Column:
    """Names of a state vector: wrist pose and grasp, or wrist pose, grasp and 45 joint numbers."""
    base = [*(f"wrist_{a}" for a in ("x", "y", "z", "qw", "qx", "qy", "qz")), "grasp"]
    short, long = (F.array(*(F.lit(n) for n in names)) for names in (base, [*base, *(f"theta_{i:02d}" for i in range(45))]))
    return F.when(has_mano, long).otherwise(short)
