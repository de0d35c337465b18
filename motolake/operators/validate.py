"""Checks of one signal against another."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motolake.operators import asof
from motolake.operators import windows as win
from motolake.settings import DEFAULT, TASK_PHASES, Settings


def spikes_at_contact(frames: DataFrame, keys: list[str], frame: str, contact: str, magnitude: str, s: Settings = DEFAULT, reach: int = 5) -> DataFrame:
    """Share of contacts with a spike within reach frames; all is well without contacts."""
    top = F.max(magnitude).over(win.rows(keys, [frame], -reach, reach))
    marked = frames.withColumn("_hit", F.when(F.col(contact), (top > s.contact_g).cast("int")))
    out = marked.groupBy(*keys).agg(F.count("_hit").alias("contacts"), F.coalesce(F.sum("_hit"), F.lit(0)).alias("spikes"), F.coalesce(F.avg("_hit"), F.lit(1.0)).alias("spike_rate"))
    return out.withColumn("passed", (F.col("contacts") == 0) | (F.col("spike_rate") > s.spike_rate))


def slowing_at_boundaries(segments: DataFrame, frames: DataFrame, keys: list[str], frame: str, speed: str, s: Settings = DEFAULT, back: int = 10, first: str = "reach", then: str = "grasp") -> DataFrame:
    """Share of first-then boundaries before which speed falls over back frames; too few frames count as falling, no boundary passes."""
    w = Window.partitionBy(*keys).orderBy("start_frame")
    ends = segments.withColumn("_next", F.lead("phase").over(w)).filter((F.col("phase") == first) & (F.col("_next") == then)).select(*keys, F.col("end_frame").alias(frame), F.lit(True).alias("_edge"))
    trail = win.rows(keys, [frame], -back, 0)
    values = frames.withColumn("_first", F.first(speed, ignorenulls=True).over(trail)).withColumn("_last", F.last(speed, ignorenulls=True).over(trail)).withColumn("_n", F.count(speed).over(trail))
    at = ends.join(values, [*keys, frame], "left")
    slow = F.when(F.coalesce("_n", F.lit(0)) >= 2, (F.col("_last") < F.col("_first")).cast("int")).otherwise(1)
    checked = at.groupBy(*keys).agg(F.count(F.lit(1)).alias("boundaries"), F.sum(slow).alias("correct"), F.avg((F.col("_last") - F.col("_first")) / back).alias("mean_change"))
    out = segments.select(*keys).distinct().join(checked, keys, "left").fillna(0, ["boundaries", "correct"]).fillna(0.0, ["mean_change"])
    return out.withColumn("passed", (F.col("boundaries") == 0) | (F.col("correct") / F.greatest("boundaries", F.lit(1)) > s.decel_rate))


def causal_order(events: DataFrame, keys: list[str], frame: str, cause: str, effect: str, ms_per_step, s: Settings = DEFAULT, shown: int = 20) -> DataFrame:
    """Causes whose nearest effect lies outside the window: total, inversions, rate, the first of them. Without effects there is none.

    ms_per_step turns a difference of frame into milliseconds.
    """
    causes, effects = events.filter(F.col(cause)).select(*keys, frame), events.filter(F.col(effect)).select(*keys, F.col(frame).alias("_at"))
    near = asof.nearest(causes, effects, keys, frame, "_at", "_effect")
    offset = (F.col("_effect") - F.col(frame)) * ms_per_step
    bad = F.coalesce(~((offset > s.causal_ms[0]) & (offset < s.causal_ms[1])), F.lit(False))
    marked = near.withColumn("_bad", bad)
    found = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"), F.count_if("_bad").alias("inversions"), F.slice(F.array_sort(F.collect_list(F.when(F.col("_bad"), F.col(frame)))), 1, shown).alias("inversion_frames"))
    out = events.select(*keys).distinct().join(found, keys, "left").fillna(0, ["events", "inversions"])
    rate = F.when(F.col("events") > 0, F.col("inversions") / F.greatest("events", F.lit(1))).otherwise(0.0)
    return out.withColumn("inversion_rate", rate).withColumn("passed", F.col("inversion_rate") < s.inversion_rate)


def phase_proportions(frames: DataFrame, keys: list[str], phase: str, tasks: DataFrame, table: dict[str, dict[str, float]] = TASK_PHASES) -> DataFrame:
    """Share of each phase that a key's task expects, and whether it is reached; tasks: keys, L1_task. Tasks without expectations have no rows."""
    expected = frames.sparkSession.createDataFrame([(t, p, m) for t, ps in table.items() for p, m in ps.items()], "L1_task string, phase string, least double")
    total = frames.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
    counts = frames.groupBy(*keys, F.col(phase).alias("phase")).agg(F.count(F.lit(1)).alias("_n"))
    wanted = tasks.join(F.broadcast(expected), "L1_task").join(total, keys).join(counts, [*keys, "phase"], "left")
    return wanted.withColumn("proportion", F.coalesce("_n", F.lit(0)) / F.col("_all")).withColumn("met", F.col("proportion") >= F.col("least")).drop("_n", "_all")


def phase_consistency(frames: DataFrame, keys: list[str], phase: str, tasks: DataFrame) -> DataFrame:
    """Whether all expectations of a key's task are met; true without any."""
    met = phase_proportions(frames, keys, phase, tasks).groupBy(*keys).agg(F.every("met").alias("_met"))
    return tasks.select(*keys).join(met, keys, "left").select(*keys, F.coalesce("_met", F.lit(True)).alias("passed"))


def overall(checks: list[tuple[str, DataFrame]], keys: list[str]) -> DataFrame:
    """Checks put together: a column per check, overall_valid and the flags of those that failed; a check without a row passes."""
    out = None
    for name, check in checks:
        one = check.select(*keys, F.col("passed").alias(name))
        out = one if out is None else out.join(one, keys, "full")
    names = [n for n, _ in checks]
    out = out.fillna(True, names)
    flags = F.filter(F.array(*(F.when(~F.col(n), F.lit(n)) for n in names)), lambda x: x.isNotNull())
    return out.withColumn("flags", flags).withColumn("overall_valid", F.size("flags") == 0)
