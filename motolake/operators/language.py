"""Instructions by template, subtasks, sampled frames and review of captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motolake.functions import strings
from motolake.operators import windows as win
from motolake.operators.stats import first_on_ties
from motolake.settings import DEFAULT, Settings

# Sentences per task.
TEMPLATES = {
    "bolt_tightening": "Pick up the bolt using {grasp_type} with the {dominant_hand} hand, position it over {target_location}, and tighten clockwise until seated. Task {outcome}. Duration: {duration}s.",
    "material_transfer": "Grasp {object_class} using {grasp_type} with the {dominant_hand} hand and transfer it to {target_location}. Task {outcome}. Duration: {duration}s.",
    "pick_and_place": "Pick up the object from the source location using {grasp_type} with the {dominant_hand} hand and place it at {target_location}. Duration: {duration}s.",
    "assembly_insert": "Insert the component into the assembly fixture using {grasp_type} with the {dominant_hand} hand. Task {outcome}. Duration: {duration}s.",
    "box_seal": "Seal the box by applying tape using {grasp_type} with the {dominant_hand} hand. Task {outcome}. Duration: {duration}s.",
    "label_apply": "Apply the label using {grasp_type} with the {dominant_hand} hand onto {target_location}. Task {outcome}. Duration: {duration}s.",
    "inspection_visual": "Visually inspect {object_class} at {target_location} using the {dominant_hand} hand. Task {outcome}. Duration: {duration}s.",
    "tool_change": "Replace the current tool with a new one using {grasp_type} with the {dominant_hand} hand. Task {outcome}. Duration: {duration}s.",
    "packaging_fold": "Fold packaging material using {grasp_type} with the {dominant_hand} hand and place at {target_location}. Task {outcome}. Duration: {duration}s.",
    "idle": "Idle period with no active manipulation. Duration: {duration}s.",
    "default": "Perform {task} task using {dominant_hand} hand with {grasp_type}. Duration: {duration}s.",
}
KEY_PHASES = ("grasp", "active_manipulation", "release")


def facts(frames: DataFrame, episodes: DataFrame, keys: list[str], frame: str) -> DataFrame:
    """Episodes with dominant_hand (right if none is seen), grasp_type, success, outcome, object and place.

    frames: keys, frame, dominant_hand, active_primitives. episodes: keys, L1_task, confidence,
    duration_sec, overall_valid (null is valid).
    """
    hands = first_on_ties(frames, keys, "dominant_hand", frame, "_hand")
    active = F.col("active_primitives")
    grasps = frames.groupBy(*keys).agg(F.count_if(F.array_contains(active, "lateral_pinch")).alias("_pinch"), F.count_if(F.array_contains(active, "power_grasp")).alias("_power"))
    out = episodes.join(hands, keys, "left").join(grasps, keys, "left")
    success = F.coalesce("overall_valid", F.lit(True)) & (F.coalesce("confidence", F.lit(0.0)) > 0.7)
    out = out.withColumn("dominant_hand", F.coalesce("_hand", F.lit("right"))).withColumn("grasp_type", F.when(F.col("_pinch") > F.col("_power"), "pinch grasp").otherwise("power grasp"))
    out = out.withColumn("success", success).withColumn("outcome", F.when(F.col("success"), "completed successfully").otherwise("attempted"))
    return out.withColumn("object_class", F.lit("the object")).withColumn("target_location", F.lit("the target location")).drop("_hand", "_pinch", "_power")


def ground(facts_: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Adds instruction: the task's template, the default one for other tasks, with its fields filled."""
    table = facts_.sparkSession.createDataFrame(list(templates.items()), "L1_task string, _template string")
    out = facts_.join(F.broadcast(table), "L1_task", "left")
    fields = {"grasp_type": F.col("grasp_type"), "dominant_hand": F.col("dominant_hand"), "object_class": F.col("object_class"), "target_location": F.col("target_location"), "outcome": F.col("outcome"), "task": F.col("L1_task"), "duration": F.format_string("%.1f", F.bround("duration_sec", 1))}
    return out.withColumn("instruction", strings.fill(F.coalesce("_template", F.lit(templates["default"])), fields)).drop("_template")


def representative_frames(start: Column, end: Column, segments: Column, most: int = 5, least: int = 3) -> Column:
    """Three to five frames of an episode: its ends, middles of key phases, evenly spaced ones if those are few. segments: array of struct(phase, start_frame, end_frame)."""
    inside = F.filter(F.array_sort(F.transform(segments, lambda g: F.struct(g["start_frame"].alias("start_frame"), g["end_frame"].alias("end_frame"), g["phase"].alias("phase")))), lambda g: (g["start_frame"] <= end) & (g["end_frame"] >= start) & g["phase"].isin(*KEY_PHASES))
    middles = F.filter(F.transform(inside, lambda g: F.floor((F.greatest(g["start_frame"], start) + F.least(g["end_frame"], end)) / 2).cast("int")), lambda m: (m > start) & (m < end))
    room = most - 2
    n = F.size(middles)
    chosen = F.when(n > room, F.transform(F.sequence(F.lit(0), F.lit(room - 1)), lambda i: F.get(middles, F.floor(i * n / room).cast("int")))).otherwise(middles)
    extra = F.greatest(F.lit(least - 2) - n, F.lit(0))
    steps = F.when(extra > 0, F.sequence(F.lit(1), extra)).otherwise(F.array().cast("array<int>"))
    even = F.transform(steps, lambda i: (start + F.bround((end - start) * i / (extra + 1))).cast("int"))
    every = F.array_sort(F.array_distinct(F.concat(F.array(start.cast("int")), chosen, even, F.array(end.cast("int")))))
    return F.when(end <= start, F.array(start.cast("int"))).otherwise(F.slice(every, 1, most))


def subtasks(segments: DataFrame, keys: list[str], s: Settings = DEFAULT, gap: int = 90) -> DataFrame:
    """Segments that aren't idle, neighbours of one phase merged over at most gap frames."""
    return win.gap_merge(segments.filter("phase <> 'idle'"), keys, "phase", "start_frame", "end_frame", gap)


def facts_between(frames: DataFrame, spans: DataFrame, keys: list[str], frame: str, columns: list[str]) -> DataFrame:
    """Sorted different values of columns over the frames of each span."""
    inside = frames.join(spans.select(*keys, "start_frame", "end_frame"), keys).filter(F.col(frame).between(F.col("start_frame"), F.col("end_frame")))
    return inside.groupBy(*keys, "start_frame", "end_frame").agg(*(F.array_sort(F.collect_set(c)).alias(c) for c in columns))


def consistency(scores: list[Column], threshold: float, verdict: Column) -> Column:
    """Least of a judge's scores, in [0, 1], and whether it needs review."""
    low = F.least(*(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)) for x in scores))
    return F.struct(low.alias("score"), ((low < threshold) | ~verdict).alias("flagged"))


def recent_instructions(episodes: DataFrame, keys: list[str], order: list[str], instruction: str, n: int = 5) -> DataFrame:
    return episodes.withColumn("recent", F.collect_list(instruction).over(win.rows(keys, order, -n, -1)))


def reuse(episodes: DataFrame, donors: DataFrame) -> DataFrame:
    """Episodes with paraphrases of a donor of the same capture that has any. One donor per capture: the one with most."""
    best = donors.filter(F.size("paraphrases") > 0).groupBy("capture_id").agg(F.max_by("paraphrases", F.size("paraphrases")).alias("_donated"))
    return episodes.join(best, "capture_id", "left").withColumn("reused", F.col("_donated").isNotNull()).withColumnRenamed("_donated", "paraphrases")
