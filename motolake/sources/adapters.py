"""Other datasets' records as canonical frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOINTS = "episode_id string, frame_idx int, t double, hands array<struct<side:string,joints:array<array<double>>>>"
SEGMENTS = "episode_id string, text string, start_frame int, end_frame int"


def read_joints(spark: SparkSession, path: str, max_frames: int | None = None) -> DataFrame:
    """episode_id, frame_idx, t, hands by side: hands without 21 joints and frames without hands are left out."""
    rows = spark.read.schema(JOINTS).json(path)
    if max_frames is not None:
        rows = rows.filter(F.col("frame_idx") < max_frames)
    return joints(rows)


def joints(rows: DataFrame) -> DataFrame:
    whole = F.filter("hands", lambda h: F.size(h["joints"]) == 21)
    entries = F.transform(whole, lambda h: F.struct(h["side"].alias("key"), F.struct(h["joints"].alias("keypoints_3d")).alias("value")))
    out = rows.withColumn("hands", F.map_from_entries(entries)).filter(F.size("hands") > 0)
    return out.select("episode_id", "frame_idx", "t", "hands", F.lit("vision_primary").alias("provenance"))


def subtasks(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Segments cut to the frames there are; empty ones go."""
    span = frames.groupBy("episode_id").agg(F.min("frame_idx").alias("_low"), F.max("frame_idx").alias("_high"))
    cut = rows.join(span, "episode_id").withColumn("start_frame", F.greatest("start_frame", "_low")).withColumn("end_frame", F.least("end_frame", "_high"))
    return cut.filter("end_frame >= start_frame").drop("_low", "_high")
