"""Agreement of cameras, clocks and depths from different sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.functions import geometry as geo
from motolake.operators import asof


def tier(measured_fx: Column, robot_fx: Column, rtol: float = 0.05) -> Column:
    """Tier and whether cameras agree: second tier within rtol, first beyond or where one isn't known (then null)."""
    known = measured_fx.isNotNull() & robot_fx.isNotNull()
    near = F.when(known, F.abs(measured_fx - robot_fx) <= rtol * robot_fx)
    return F.struct(F.when(F.coalesce(near, F.lit(False)), "stage2_anchor").otherwise("stage1_volume").alias("tier"), near.alias("aligned"))


def wrist(right: Column, left: Column) -> Column:
    """The right hand's pose, else the left's."""
    return F.coalesce(right, left)


def wrists(frames: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Frames with a wrist (from right_wrist, left_wrist); a key with fewer than least is an error."""
    found = frames.withColumn("wrist", wrist(F.col("right_wrist"), F.col("left_wrist")))
    n = F.count("wrist").over(Window.partitionBy(*keys))
    checked = F.when(n < least, F.raise_error(F.lit("too few frames with a hand")).cast("boolean")).otherwise(F.col("wrist").isNotNull())
    return found.withColumn("_kept", checked).filter("_kept").drop("_kept")


def rotation_agreement(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Two sources' rotations of the same steps: median and 90th percentile of the angle between them in degrees, and how their angles correlate."""
    angle = lambda q: 2 * F.acos(F.least(F.lit(1.0), F.abs(geo.at(q, 0))))
    steps = pairs.withColumn("_rest", F.degrees(angle(geo.multiply(geo.conjugate(F.col(a)), F.col(b))))).withColumn("_a", angle(F.col(a))).withColumn("_b", angle(F.col(b)))
    p = F.percentile("_rest", F.array(F.lit(0.5), F.lit(0.9)))
    return steps.groupBy(*keys).agg(p.alias("_p"), F.corr("_a", "_b").alias("correlation")).select(*keys, F.col("_p")[0].alias("median_deg"), F.col("_p")[1].alias("p90_deg"), "correlation")


def anchored_depth(video: DataFrame, anchors: DataFrame, keys: list[str], frame: str, depth: str) -> DataFrame:
    """Video depths put on metric ones: an affine least-squares fit at each anchor frame, scale and shift interpolated over frames between. anchors: keys, frame, relative, metric (a row per sample)."""
    fits = anchors.groupBy(*keys, frame).agg(F.regr_slope("metric", "relative").alias("scale"), F.regr_intercept("metric", "relative").alias("shift")).filter("scale is not null")
    put = asof.interpolate(video, fits.withColumnRenamed(frame, "_at"), keys, frame, "_at", ["scale", "shift"])
    return put.withColumn("metric_depth", F.col("scale") * F.col(depth) + F.col("shift"))


def required(table: DataFrame | None, name: str) -> DataFrame:
    """A stage's input; one that is missing is an error, not an empty table."""
    if table is None:
        raise FileNotFoundError(f"the table {name} is missing")
    return table


def fps_claim(claimed: Column, probed: Column, rtol: float = 0.05) -> Column:
    """Whether a claimed rate fits the probed one; null if one isn't known."""
    return F.abs(claimed - probed) <= rtol * probed


def save_profile(profiles: DataFrame, new: DataFrame, key: str = "worker_id") -> DataFrame:
    """Profiles with new ones in place of old; a new one without consent is an error."""
    checked = new.withColumn("consent_granted", F.when(F.col("consent_granted"), True).otherwise(F.raise_error(F.lit("no consent for a profile")).cast("boolean")))
    return profiles.join(new.select(key), key, "left_anti").unionByName(checked)


def delete_profile(profiles: DataFrame, gone: DataFrame, key: str = "worker_id") -> DataFrame:
    return profiles.join(gone.select(key), key, "left_anti")
