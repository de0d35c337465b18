"""Measures of trajectories that models made: jumps, agreement, limits, choice among candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.functions import geometry as geo


def largest_change(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def teleports(df: DataFrame, keys: list[str], order: str, vector: str, limit: float = 0.3, per_frame: bool = False) -> DataFrame:
    """Rows whose largest change since the one before is over a limit, per frame of the gap if asked."""
    w = Window.partitionBy(*keys).orderBy(order)
    change = largest_change(F.col(vector), F.lag(vector).over(w))
    if per_frame:
        change = change / F.greatest(F.col(order) - F.lag(order).over(w), F.lit(1))
    return df.withColumn("_jump", F.coalesce(change > limit, F.lit(False))).groupBy(*keys).agg(F.count_if("_jump").alias("teleports"))


def common_frames(arm: DataFrame, finger: DataFrame, on: list[str]) -> DataFrame:
    return arm.join(finger, on)


def overlap_ratio(arm: DataFrame, finger: DataFrame, keys: list[str], frame: str) -> DataFrame:
    """Common frames over the larger of both numbers."""
    a, b = (x.groupBy(*keys).agg(F.count_distinct(frame).alias(n)) for x, n in ((arm, "_a"), (finger, "_b")))
    both = arm.select(*keys, frame).distinct().intersect(finger.select(*keys, frame).distinct()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    out = a.join(b, keys, "full").join(both, keys, "left")
    return out.select(*keys, (F.coalesce("_n", F.lit(0)) / F.greatest(F.coalesce("_a", F.lit(0)), F.coalesce("_b", F.lit(0)), F.lit(1))).alias("overlap"))


def grasp_agreement(df: DataFrame, keys: list[str], openness: str, grasped: str) -> DataFrame:
    """Share of frames on which a hand under half its range of openness agrees with the grasp; 1 if only one class occurs."""
    span = df.groupBy(*keys).agg(((F.min(openness) + F.max(openness)) / 2).alias("_mid"), F.count_distinct(grasped).alias("_kinds"))
    same = ((F.col(openness) < F.col("_mid")) == F.col(grasped)).cast("double")
    return df.join(span, keys).groupBy(*keys, "_kinds").agg(F.avg(same).alias("_share")).select(*keys, F.when(F.col("_kinds") < 2, 1.0).otherwise(F.col("_share")).alias("agreement"))


def reconcile(measures: DataFrame, least_overlap: float = 0.5, least_agreement: float = 0.5) -> DataFrame:
    """Adds reasons and ok. Reads overlap, agreement, arm_teleports, finger_teleports."""
    reasons = F.array(
        F.when(F.col("overlap") < least_overlap, F.lit("few common frames")),
        F.when(F.col("arm_teleports") > 0, F.lit("the arm jumps")),
        F.when(F.col("finger_teleports") > 0, F.lit("the fingers jump")),
        F.when(F.col("agreement") < least_agreement, F.lit("grasps disagree")),
    )
    return measures.withColumn("reasons", F.filter(reasons, lambda r: r.isNotNull())).withColumn("ok", F.size("reasons") == 0)


def eligible(measures: DataFrame, ik_floor: float = 0.8) -> DataFrame:
    """Adds reasons and eligible, null if nothing was simulated. Reads limit_frames, collision_frames, teleports, ik_convergence."""
    known = F.col("limit_frames").isNotNull() | F.col("ik_convergence").isNotNull()
    reasons = F.array(
        F.when(F.col("limit_frames") > 0, F.lit("joint limits")),
        F.when(F.col("collision_frames") > 0, F.lit("collisions")),
        F.when(F.col("teleports") > 0, F.lit("teleports")),
        F.when(F.col("ik_convergence") < ik_floor, F.lit("inverse kinematics")),
    )
    return measures.withColumn("reasons", F.filter(reasons, lambda r: r.isNotNull())).withColumn("eligible", F.when(known, F.size("reasons") == 0))


def violations(frames: DataFrame, keys: list[str], q: str, low: str, high: str, collides: str) -> DataFrame:
    """Frames outside joint limits, and colliding ones."""
    outside = F.exists(F.arrays_zip(F.col(q).alias("q"), F.col(low).alias("l"), F.col(high).alias("h")), lambda x: (x["q"] < x["l"]) | (x["q"] > x["h"]))
    return frames.groupBy(*keys).agg(F.count_if(outside).alias("limit_frames"), F.count_if(collides).alias("collision_frames"))


def best_candidate(candidates: DataFrame, keys: list[str], ordinal: str = "candidate") -> DataFrame:
    """Fewest collisions, then convergence, smoothness (small), manipulability, margin, residual (small), the first of equals."""
    order = (F.asc("collisions"), F.desc("convergence"), F.asc("smoothness"), F.desc("manipulability"), F.desc("margin"), F.asc("residual"), F.asc(ordinal))
    return candidates.withColumn("_p", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_p = 1").drop("_p")


def candidate_spread(candidates: DataFrame, keys: list[str], axes: list[str]) -> DataFrame:
    return candidates.groupBy(*keys).agg(F.sqrt(sum((F.var_pop(a) for a in axes), F.lit(0.0))).alias("spread"))


def clip_velocity(df: DataFrame, keys: list[str], order: str, x: str, limit: float, out: str = "clipped") -> DataFrame:
    """Values that change by limit at most from the last clipped value: each needs the one before, so a key is a fold."""
    item = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(x).cast("double").alias("x"))))
    zero = F.array().cast("array<struct<o:" + df.schema[order].dataType.simpleString() + ",x:double>>")

    def step(acc: Column, e: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))["x"]
        held = F.when(last.isNull(), e["x"]).otherwise(F.greatest(last - limit, F.least(last + limit, e["x"])))
        return F.concat(acc, F.array(F.struct(e["o"].alias("o"), held.alias("x"))))

    folded = df.groupBy(*keys).agg(F.aggregate(item, zero, step).alias("f"))
    return folded.select(*keys, F.explode("f").alias("f")).select(*keys, F.col("f.o").alias(order), F.col("f.x").alias(out))


def wrist_in_root(position: Column, rotation6d: Column, root: Column) -> Column:
    """A wrist given by position and six rotation numbers, in a root frame."""
    return geo.compose(root, geo.pose(position, geo.matrix_to_quaternion(geo.rot6d_to_matrix(rotation6d))))


def similarity_fit(pairs: DataFrame, keys: list[str], source: str, target: str) -> DataFrame:
    """scale, rotation (9 numbers, row by row), shift that map source points to target points with least squares (singular value decomposition per key)."""
    schema = ", ".join(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys) + ", scale double, rotation array<double>, shift array<double>"

    def fit(pdf):
        import numpy as np
        import pandas as pd

        x, y = np.stack(pdf[source].to_numpy()), np.stack(pdf[target].to_numpy())
        mx, my = x.mean(0), y.mean(0)
        u, d, vt = np.linalg.svd((y - my).T @ (x - mx) / len(x))
        sign = np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ vt)) or 1.0])
        r = u @ sign @ vt
        var = ((x - mx) ** 2).sum(1).mean()
        scale = float(np.trace(np.diag(d) @ sign) / var) if var > 0 else 1.0
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "scale": scale, "rotation": r.ravel().tolist(), "shift": (my - scale * r @ mx).tolist()}])

    return pairs.select(*keys, source, target).groupBy(*keys).applyInPandas(fit, schema)
