"""Typed tables of the engine and its constraints as queries that return the rows which break them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motolake.settings import CONSENT, FINGERS, PROVENANCE

SCHEMA_VERSION = 5

SE3 = T.StructType([T.StructField("position_m", T.ArrayType(T.DoubleType())), T.StructField("quaternion_wxyz", T.ArrayType(T.DoubleType()))])
HAND = T.StructType(
    [
        T.StructField("keypoints_3d", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("keypoints_2d", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("wrist_pose", SE3),
        T.StructField("betas", T.ArrayType(T.DoubleType())),
        T.StructField("theta", T.ArrayType(T.DoubleType())),
        T.StructField("global_orient", T.ArrayType(T.DoubleType())),
    ]
)
CANONICAL_FRAME = T.StructType(
    [
        T.StructField("episode_id", T.StringType(), False),
        T.StructField("frame_idx", T.IntegerType(), False),
        T.StructField("t", T.DoubleType(), False),
        T.StructField("rig", T.StringType()),
        T.StructField("hands", T.MapType(T.StringType(), HAND)),
        T.StructField("camera_pose", SE3),
        T.StructField("objects", T.MapType(T.StringType(), T.StructType([T.StructField("label", T.StringType()), T.StructField("pose", SE3)]))),
        T.StructField("contact", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))),
        T.StructField("interaction_state", T.StringType()),
        T.StructField("mask_uri", T.StringType()),
        T.StructField("mask_rle", T.StringType()),
        T.StructField("confidence", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("provenance", T.MapType(T.StringType(), T.StringType())),
    ]
)
IMU_RAW = T.StructType([T.StructField("session_id", T.StringType()), T.StructField("sample_idx", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("t_ms", "ax", "ay", "az", "gx", "gy", "gz", "mx", "my", "mz", "temp_c"))])
FRAMES = T.StructType([T.StructField("session_id", T.StringType()), T.StructField("frame_idx", T.IntegerType()), T.StructField("pts", T.DoubleType())])
SEGMENTS = T.StructType([T.StructField("session_id", T.StringType()), T.StructField("phase", T.StringType()), T.StructField("start_frame", T.IntegerType()), T.StructField("end_frame", T.IntegerType()), T.StructField("start_sec", T.DoubleType()), T.StructField("end_sec", T.DoubleType()), T.StructField("mean_confidence", T.DoubleType())])
CATALOG = {
    "captures": "id string, content_hash string, size_bytes long, rig string, uri string, duration_sec double, frame_count long, fps double",
    "consent": "capture_id string, status string, granted_at timestamp, revoked_at timestamp, conflict_note string",
    "consent_events": "id long, capture_id string, event_type string, status string, source string, detail string, occurred_at timestamp",
    "episodes": "id string, capture_id string, scene_id string, demonstrator_id string, task_id string, schema_version int, tier string, uri string, hours double, frame_count long",
    "certifications": "episode_id string, quality int, speed int, mistakes array<string>, pii_status string",
    "annotations": "episode_id string, paraphrases array<string>, subgoal_frames array<int>",
    "retarget_results": "episode_id string, embodiment string, sim_validation_passed boolean, ik_convergence_rate double",
    "datasets": "customer string, name string, version string, tier string, manifest_uri string",
    "jobs": "id string, stage string, status string, error string",
    "episode_embeddings": "episode_id string, model string, embedding array<float>",
}


def rank(col: str | Column, order: tuple[str, ...]) -> Column:
    """Place of a value in an ordered vocabulary, from 0; null if it isn't one."""
    col = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.array_position(F.array(*(F.lit(v) for v in order)), col), F.lit(0)).cast("int") - 1


def trust_rank(col: str | Column) -> Column:
    """Trust of a provenance, larger is better."""
    return F.lit(len(PROVENANCE) - 1) - rank(col, PROVENANCE)


def permissiveness(col: str | Column) -> Column:
    return rank(col, CONSENT)


def frozen(schema: T.StructType) -> str:
    """A schema as JSON with sorted keys, to be compared with a committed snapshot."""
    return json.dumps(json.loads(schema.json()), sort_keys=True)


# ---------------------------------------------------------------- constraints
def _norm2(q: str) -> Column:
    return F.aggregate(F.col(q), F.lit(0.0), lambda a, x: a + x * x)


def bad_quaternions(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.coalesce((F.size(col) == 4) & (_norm2(col) > 0.99) & (_norm2(col) < 1.01), F.lit(False)))


def bad_masks(df: DataFrame, uri: str = "mask_uri", rle: str = "mask_rle") -> DataFrame:
    """Not exactly one of a place and a run-length string."""
    return df.filter(F.col(uri).isNull() == F.col(rle).isNull())


def bad_keypoints(df: DataFrame, col: str, n: int = 21) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & (F.size(col) != n))


def without_provenance(df: DataFrame, fields: list[str], provenance: str = "provenance") -> DataFrame:
    """Rows with a populated field that names no provenance; missing lists them."""
    known = F.coalesce(F.map_keys(provenance), F.array().cast("array<string>"))
    names = F.filter(F.array(*(F.when(F.col(f).isNotNull(), F.lit(f)) for f in fields)), lambda x: x.isNotNull())
    return df.withColumn("missing", F.array_except(names, known)).filter(F.size("missing") > 0)


def missing_fingers(df: DataFrame, contact: str) -> DataFrame:
    needed = F.array(*(F.lit(f) for f in FINGERS))
    return df.withColumn("missing", F.array_except(needed, F.map_keys(contact))).filter(F.col(contact).isNotNull() & (F.size("missing") > 0))


def disordered_spans(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(F.col(end) < F.col(start))


def empty_robot_actions(df: DataFrame, arm: str, finger: str) -> DataFrame:
    return df.filter(F.col(arm).isNull() & F.col(finger).isNull())


def unexplained_flags(df: DataFrame, ok: str, reason: str) -> DataFrame:
    return df.filter(~F.col(ok) & F.col(reason).isNull())


def unmeasured_channels(frames: DataFrame, rig_channels: DataFrame) -> DataFrame:
    """Reported (rig, channel) pairs that the rig doesn't measure."""
    return frames.select("rig", "channel").distinct().join(F.broadcast(rig_channels), ["rig", "channel"], "left_anti")


def over_ceiling(frames: DataFrame, rigs: DataFrame) -> DataFrame:
    """Rows whose measured provenance is better than the rig's ceiling; rigs: rig, ceiling."""
    joined = frames.join(F.broadcast(rigs), "rig")
    measured = F.col("provenance").isin(*PROVENANCE[:3])
    return joined.filter(measured & (trust_rank("provenance") > F.coalesce(trust_rank("ceiling"), F.lit(-1))))


def bad_hashes(df: DataFrame, capture: str, content_hash: str) -> DataFrame:
    """Null hashes pass."""
    return df.filter(F.col(content_hash) != F.col(capture))


def foreign_frames(frames: DataFrame, episodes: DataFrame, shown: int = 3) -> DataFrame:
    """Frames of no known (episode, rig), the first few of each episode."""
    from pyspark.sql import Window

    strangers = frames.join(episodes.select("episode_id", "rig"), ["episode_id", "rig"], "left_anti")
    place = F.row_number().over(Window.partitionBy("episode_id").orderBy("frame_idx"))
    return strangers.withColumn("place", place).filter(F.col("place") <= shown).drop("place")


def mislabelled_embodiments(df: DataFrame, actions: str) -> DataFrame:
    """Map entries whose value names another embodiment than the key."""
    return df.withColumn("wrong", F.map_filter(actions, lambda k, v: k != v["embodiment"])).filter(F.size("wrong") > 0)


def bad_manifests(df: DataFrame) -> DataFrame:
    return df.filter((F.length("capture_id") != 64) | (F.col("size_bytes") <= 0) | (F.col("fps") <= 0))


def bad_quality(df: DataFrame, col: str = "quality") -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).between(1, 5))
