"""Consent and delivery, closed unless shown to be open: an absent record is a state of its own, and it blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.schema import permissiveness
from motolake.settings import CONSENT, DEFAULT, Settings


def _status(rank: Column) -> Column:
    return F.element_at(F.array(*(F.lit(c) for c in CONSENT)), rank.cast("int") + 1)


def reconcile(observations: DataFrame, capture: str, status: str) -> DataFrame:
    """capture, status (the least permissive seen), conflicted, observations, note."""
    rank = permissiveness(status)
    out = observations.groupBy(capture).agg(F.min(rank).alias("_rank"), F.count_distinct(status).alias("_kinds"), F.count(status).alias("observations"), F.array_sort(F.collect_set(status)).alias("_seen"))
    conflicted = F.col("_kinds") > 1
    note = F.when(conflicted, F.concat(F.lit("sources reported "), F.array_join("_seen", ", "), F.lit("; the least permissive counts")))
    return out.select(capture, _status(F.col("_rank")).alias("status"), conflicted.alias("conflicted"), "observations", note.alias("note"))


def event_log(observations: DataFrame, capture: str, status: str, source: str) -> DataFrame:
    """Events of a reconciliation: each observation of a capture in conflict, and one decision per capture."""
    decided = reconcile(observations, capture, status)
    clash = observations.join(decided.filter("conflicted").select(capture), capture, "left_semi").select(capture, F.lit("duplicate_conflict").alias("event_type"), F.col(status).alias("status"), F.col(source).cast("string").alias("source"))
    result = decided.select(capture, F.when(F.col("conflicted"), "reconciled").otherwise("recorded").alias("event_type"), "status", F.lit(None).cast("string").alias("source"))
    return clash.unionByName(result)


def sticky(history: DataFrame, capture: str, order: list[str], status: str) -> DataFrame:
    """History with effective status and refused: once denied or revoked, every more permissive change is refused."""
    w = Window.partitionBy(capture).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    stop = F.when(F.col(status).isin("denied", "revoked"), F.struct(permissiveness(status).alias("r"), F.col(status).alias("s")))
    out = history.withColumn("_stop", F.min(stop).over(w))
    return out.withColumn("effective", F.when(F.col("_stop").isNotNull(), F.col("_stop.s")).otherwise(F.col(status))).withColumn("refused", F.col("_stop").isNotNull() & (permissiveness(status) > F.col("_stop.r"))).drop("_stop")


def history(events: DataFrame, capture: str, occurred: str, event_id: str) -> DataFrame:
    return events.orderBy(capture, occurred, event_id)


def current(captures: DataFrame, consent: DataFrame, capture: str) -> DataFrame:
    """Captures with their consent; null where there is no record, which isn't pending."""
    return captures.join(consent.select(F.col("capture_id").alias(capture), F.col("status").alias("consent")), capture, "left")


def block_reason(consent: Column, pii: Column, quality: Column | None = None, s: Settings = DEFAULT) -> Column:
    """Why something may not be delivered, the first reason; null if it may."""
    out = F.when(consent.isNull(), "no consent record").when(pii.isNull(), "no pii record").when(consent != "granted", F.concat(F.lit("consent is "), consent)).when(pii != "passed", F.concat(F.lit("pii is "), pii))
    if quality is not None:
        out = out.when(quality.isNull(), "quality unknown").when(quality < s.quality_floor, F.concat(F.lit("quality is "), quality.cast("string")))
    return out


def deliverable(episodes: DataFrame, captures: DataFrame, consent: DataFrame, certifications: DataFrame, task: str | None = None, min_quality: int | None = None) -> DataFrame:
    """Episodes that may be delivered: inner joins, so that a missing row hides an episode."""
    granted = consent.filter("status = 'granted'").select("capture_id")
    passed = certifications.filter("pii_status = 'passed'")
    if min_quality is not None:
        passed = passed.filter(F.col("quality") >= min_quality)
    out = episodes.join(captures.select(F.col("id").alias("capture_id")), "capture_id").join(granted, "capture_id").join(passed.select(F.col("episode_id").alias("id")), "id")
    return out.filter(F.col("task_id") == task) if task is not None else out


def migration_plan(sessions: DataFrame) -> DataFrame:
    """Captures by content: content_hash, status (least permissive), conflicted, sessions; sessions that are refused stand alone with a reason.

    sessions: session_id, content_hash, has_video, has_metadata, status.
    """
    reason = F.when(~F.col("has_video"), "no video").when(~F.col("has_metadata"), "no metadata").when(F.col("content_hash").isNull(), "no hash")
    marked = sessions.withColumn("refused", reason)
    groups = marked.filter("refused is null").groupBy("content_hash").agg(F.array_sort(F.collect_list("session_id")).alias("sessions"), _status(F.min(permissiveness("status"))).alias("status"), (F.count_distinct("status") > 1).alias("conflicted"))
    alone = marked.filter("refused is not null").select("content_hash", F.array("session_id").alias("sessions"), F.lit(None).cast("string").alias("status"), F.lit(False).alias("conflicted"), "refused")
    return groups.withColumn("refused", F.lit(None).cast("string")).unionByName(alone)


def profiles(table: DataFrame, now: Column, s: Settings = DEFAULT) -> DataFrame:
    """Worker profiles that were consented to and haven't outlived their retention."""
    from motolake.functions.strings import age_days

    return table.filter(F.col("consent_granted") & (age_days(now, F.col("created_at")) <= s.retention_days))


def status_of(files: DataFrame, metadata: DataFrame, sessions: DataFrame, key: str) -> DataFrame:
    """Consent of a session by its file, then its metadata, then pending."""
    a, b = files.select(key, F.col("status").alias("_file")), metadata.select(key, F.col("consent_status").alias("_meta"))
    return sessions.join(a, key, "left").join(b, key, "left").withColumn("consent_status", F.coalesce("_file", "_meta", F.lit("pending"))).drop("_file", "_meta")
