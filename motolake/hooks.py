"""Where models come in: typed tables, made by functions over batches or over a key's rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

# Schemas of what models give.
HAND_POSE = "session_id string, frame_idx int, hands_detected boolean, dominant_hand string, right_hand struct<confidence:double,landmarks:array<array<double>>>, left_hand struct<confidence:double,landmarks:array<array<double>>>, derived struct<thumb_index_dist:double,fingertip_dists:array<double>,wrist_velocity:array<double>,wrist_velocity_magnitude:double>"
OBJECT_TRACKS = "session_id string, frame_idx int, objects array<struct<track_id:bigint,class_label:string,confidence:double,bbox:array<double>,centroid_norm:array<double>>>"
DEPTH = "session_id string, frame_idx int, keypoint string, depth_m double, confidence double"
SHARPNESS = "session_id string, frame_idx int, blur double, coverage double"
TEXT_REGIONS = "session_id string, frame_idx int, region string, confidence double, polygon array<array<double>>"
VIDEO_META = "session_id string, width int, height int, fps double, frame_count bigint, duration_s double, creation_epoch_ms double"
CAPTIONS = "episode_id string, caption string, input_tokens bigint, output_tokens bigint"
FRAME_HASH = "session_id string, phash bigint"


def infer(df: DataFrame, model: Callable[[], Callable], schema: str, batch: int | None = None) -> DataFrame:
    """Rows of model()(pandas batch) for every batch; model() is called once a task, so weights load once.

    batch sets the number of rows a model sees at a time.
    """

    def run(batches: Iterator):
        apply = model()
        for pdf in batches:
            for a in range(0, len(pdf), batch or max(len(pdf), 1)):
                yield apply(pdf.iloc[a : a + (batch or len(pdf))])

    return df.mapInPandas(run, schema)


def infer_sequences(df: DataFrame, keys: list[str], order: str, model: Callable, schema: str) -> DataFrame:
    """model(pandas frame of a key in order) for each key, for models that keep state from frame to frame."""
    return df.groupBy(*keys).applyInPandas(lambda pdf: model(pdf.sort_values(order)), schema)


def unavailable(df: DataFrame, column: str, kind: str) -> DataFrame:
    """A column of nulls for a model that isn't there: not measured, which isn't zero."""
    from pyspark.sql import functions as F

    return df.withColumn(column, F.lit(None).cast(kind))
