"""Stages of a run read back from its log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_status(log: DataFrame, keys: list[str], order: str, line: str) -> DataFrame:
    """Seconds and last status of each stage of a log of '[stage] status (ns)' lines; other lines don't count."""
    pattern = r"^\[(\w+)\] (\w+) \((\d+)s\)$"
    part = lambda k: F.regexp_extract(line, pattern, k)
    found = log.filter(F.col(line).rlike(pattern)).select(*keys, order, part(1).alias("stage"), part(2).alias("status"), part(3).cast("long").alias("s"))
    return found.groupBy(*keys, "stage").agg(F.sum("s").alias("seconds"), F.max_by("status", order).alias("status"))


def progress(status: DataFrame, keys: list[str], stages: list[str]) -> DataFrame:
    """Share of stages that are done, in percent, the stage that runs next, and whether one failed."""
    named = F.array(*(F.lit(s) for s in stages))
    done = F.collect_set(F.when(F.col("status").isin("done", "skipped"), F.col("stage")))
    out = status.groupBy(*keys).agg(done.alias("_done"), F.coalesce(F.max(F.col("status") == "FAILED"), F.lit(False)).alias("failed"))
    open_ = F.array_except(named, F.col("_done"))
    return out.select(*keys, (100 * (len(stages) - F.size(open_)) / len(stages)).alias("percent"), F.get(open_, 0).alias("next_stage"), "failed")
