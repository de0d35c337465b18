"""Which task an episode shows, by counts of its primitives and the object most often in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.operators.stats import first_on_ties
from motolake.settings import DEFAULT, TASK_OBJECTS, TASK_SIGNATURES, Settings


def signatures(table: dict[str, dict[str, int]] = TASK_SIGNATURES) -> Column:
    """Array of (task, primitive, required)."""
    return F.array(*(F.struct(F.lit(t).alias("task"), F.lit(p).alias("primitive"), F.lit(n).alias("required")) for t, s in table.items() for p, n in s.items()))


def primitive_counts(frames: DataFrame, keys: list[str], active: str = "active_primitives") -> DataFrame:
    return frames.select(*keys, F.explode(active).alias("primitive")).groupBy(*keys, "primitive").agg(F.count(F.lit(1)).alias("n"))


def dominant_object(frames: DataFrame, tracks: DataFrame, keys: list[str], frame: str) -> DataFrame:
    """The class seen on most frames with an active primitive, the first seen of equals. tracks: keys, frame, objects."""
    active = frames.filter(F.size("active_primitives") > 0).select(*keys, frame)
    last = tracks.groupBy(*keys, frame).agg(F.max_by("objects", F.size("objects")).alias("objects"))
    seen = active.join(last, [*keys, frame]).select(*keys, frame, F.posexplode("objects").alias("place", "object"))
    seen = seen.withColumn("class_label", F.nullif(F.col("object.class_label"), F.lit(""))).withColumn("order", F.col(frame) * 1_000_000 + F.col("place"))
    return first_on_ties(seen, keys, "class_label", "order", "dominant_object")


def scores(counts: DataFrame, keys: list[str], table: dict[str, dict[str, int]] = TASK_SIGNATURES) -> DataFrame:
    """Score of every task for each key of counts: the mean share of its required counts that is reached."""
    each = counts.select(*keys).distinct().select(*keys, F.explode(signatures(table)).alias("s")).select(*keys, "s.*")
    found = each.join(counts, [*keys, "primitive"], "left").withColumn("share", F.least(F.coalesce("n", F.lit(0)) / F.col("required"), F.lit(1.0)))
    return found.groupBy(*keys, "task").agg(F.round(F.avg("share"), 4).alias("score"))


def classify(counts: DataFrame, keys: list[str], objects: DataFrame | None = None, s: Settings = DEFAULT) -> DataFrame:
    """keys, L1_task, confidence, needs_human_review: the best task, unknown if it scores too little or others come within the tie margin.

    objects: keys, dominant_object, which lifts the tasks that expect it.
    """
    scored = scores(counts, keys)
    if objects is not None:
        expected = counts.sparkSession.createDataFrame([(t, o) for t, os in TASK_OBJECTS.items() for o in os], "task string, dominant_object string")
        lifted = objects.join(F.broadcast(expected), "dominant_object").select(*keys, "task", F.lit(s.object_bonus).alias("bonus"))
        scored = scored.join(lifted, [*keys, "task"], "left").withColumn("score", F.round(F.least(F.col("score") + F.coalesce("bonus", F.lit(0.0)), F.lit(1.0)), 4)).drop("bonus")
    best = scored.withColumn("top", F.max("score").over(Window.partitionBy(*keys)))
    tied = best.groupBy(*keys, "top").agg(F.count_if(F.col("top") - F.col("score") <= s.tie_margin + 1e-12).alias("near"), F.max_by("task", "score").alias("task"))
    sure = (F.col("top") >= s.task_accept) & (F.col("near") == 1)
    return tied.select(*keys, F.when(sure, F.col("task")).otherwise("unknown").alias("L1_task"), F.col("top").alias("confidence"), (~sure).alias("needs_human_review"))
