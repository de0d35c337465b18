"""Episode integrity: five shares, weighted, from 0 to 100, with uses and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motolake.functions.geometry import clip
from motolake.settings import DEFAULT, Settings


def components(drift_ms: Column, blur: Column, presence: Column, label_confidence: Column, causal_passed: Column, inversions: Column, events: Column) -> dict[str, Column]:
    causal = F.when(causal_passed, F.lit(1.0)).otherwise(F.greatest(1 - inversions / F.greatest(events, F.lit(1)), F.lit(0.0)))
    return {"sync": F.greatest(1 - drift_ms / 5, F.lit(0.0)), "blur": F.least(blur / 200, F.lit(1.0)), "hands": presence, "label": label_confidence, "causal": causal}


def score(df: DataFrame, parts: dict[str, Column], s: Settings = DEFAULT) -> DataFrame:
    """Adds eis_raw and eis."""
    raw = sum((w * p for w, p in zip(s.eis_weights, parts.values(), strict=True)), F.lit(0.0))
    return df.withColumn("eis_raw", raw).withColumn("eis", clip(F.bround(F.col("eis_raw") * 100).cast("int"), 0, 100))


def recommended_use(eis: Column, retargetable: Column, s: Settings = DEFAULT) -> Column:
    high, middle = s.eis_tiers
    uses = (
        F.when(eis >= high, F.array(*map(F.lit, ("imitation_learning", "VLA_finetuning", "foundation_model_pretraining"))))
        .when(eis >= middle, F.array(*map(F.lit, ("foundation_model_pretraining", "action_recognition"))))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.when(retargetable, uses).otherwise(F.filter(uses, lambda u: u != "VLA_finetuning"))


def flags(named: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in their order; unknown ones don't."""
    return F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in named.items())), lambda x: x.isNotNull())


def label_confidence(episodes: DataFrame, segments: DataFrame, keys: list[str], task_confidence: str) -> DataFrame:
    """Mean of the task's confidence and of its segments' by their frames, both sides weighing alike; the task's alone without segments.

    segments: keys, start_frame, end_frame, mean_confidence of the segments that overlap the episode.
    """
    frames = F.greatest(F.col("end_frame") - F.col("start_frame") + 1, F.lit(0))
    sums = segments.groupBy(*keys).agg(F.sum(frames).alias("_n"), F.sum(F.coalesce("mean_confidence", F.lit(0.0)) * frames).alias("_c"))
    out = episodes.join(sums, keys, "left")
    mixed = F.round((F.col(task_confidence) * F.col("_n") + F.col("_c")) / (2 * F.col("_n")), 4)
    return out.withColumn("label_confidence", F.when(F.col("_n") > 0, mixed).otherwise(F.col(task_confidence))).drop("_n", "_c")


def certificates(episodes: DataFrame, keys: list[str], s: Settings = DEFAULT) -> DataFrame:
    """Episodes with eis, components, recommended_use, flags.

    Reads max_drift_ms, blur_score, hand_presence_rate, label_confidence, causal_passed, inversions,
    events, qa_passed, validation_passed, needs_human_review, retargetable; nulls are missing data: a
    missing measure counts as the worst, a missing verdict as passed.
    """
    c = F.col
    parts = components(F.coalesce(c("max_drift_ms"), F.lit(999.0)), F.coalesce(c("blur_score"), F.lit(0.0)), F.coalesce(c("hand_presence_rate"), F.lit(0.0)), F.coalesce(c("label_confidence"), F.lit(0.0)), F.coalesce(c("causal_passed"), F.lit(True)), F.coalesce(c("inversions"), F.lit(0)), F.coalesce(c("events"), F.lit(1)))
    out = score(episodes.select("*", *(v.alias(f"{k}_component") for k, v in parts.items())), {k: c(f"{k}_component") for k in parts}, s)
    named = {
        "missing_sync": c("max_drift_ms").isNull(),
        "missing_blur": c("blur_score").isNull(),
        "quarantine_low_eis": c("eis") < s.eis_tiers[1],
        "qa_failed": ~c("qa_passed"),
        "validation_failed": ~c("validation_passed"),
        "needs_human_review": c("needs_human_review"),
        "no_metric_3d_retargeting_ineligible": ~c("retargetable"),
    }
    return out.withColumn("recommended_use", recommended_use(c("eis"), F.coalesce(c("retargetable"), F.lit(False)), s)).withColumn("flags", flags(named))


def session_mean(certificates_: DataFrame, keys: list[str]) -> DataFrame:
    return certificates_.groupBy(*keys).agg(F.round(F.avg("eis"), 1).alias("session_mean_eis"), F.count(F.lit(1)).alias("episodes"))
