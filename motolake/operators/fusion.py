"""Several sources for one channel: the most trusted wins; and states of hands over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motolake.functions import geometry as geo
from motolake.operators import windows as win
from motolake.schema import trust_rank
from motolake.settings import DEFAULT, FINGERS, Settings


def arbitrate(candidates: DataFrame, keys: list[str], provenance: str = "provenance", confidence: str = "confidence", ordinal: str = "ordinal", trust: Column | None = None) -> DataFrame:
    """The candidate of each key with the largest trust, then confidence, then the first; none without candidates. trust can be given."""
    trust = trust if trust is not None else trust_rank(provenance)
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(trust), F.desc_nulls_last(confidence), ordinal)
    return candidates.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def interaction_states(df: DataFrame, keys: list[str], order: list[str], s: Settings = DEFAULT, require_object: bool = False) -> DataFrame:
    """state of each frame from left_signal, right_signal, left_near, right_near, wrist_x, wrist_y: hysteresis per hand, motion since the wrist was last seen, then the least dwell."""
    out = win.hysteresis(win.hysteresis(df, keys, order, "left_signal", s.grasp_high, s.grasp_low, "_left"), keys, order, "right_signal", s.grasp_high, s.grasp_low, "_right")
    if require_object:
        out = out.withColumn("_left", F.col("_left") & F.coalesce("left_near", F.lit(False))).withColumn("_right", F.col("_right") & F.coalesce("right_near", F.lit(False)))
    here = F.when(F.col("wrist_x").isNotNull() & F.col("wrist_y").isNotNull(), F.struct("wrist_x", "wrist_y"))
    out = out.withColumn("_here", here).withColumn("_last", F.last("_here", ignorenulls=True).over(win.upto(keys, order, -1)))
    moved = F.hypot(F.col("_here.wrist_x") - F.col("_last.wrist_x"), F.col("_here.wrist_y") - F.col("_last.wrist_y")) > s.motion_px
    raw = F.when(F.col("_left") & F.col("_right"), "GRASPED_BOTH").when(F.col("_left"), "GRASPED_L").when(F.col("_right"), "GRASPED_R").when(moved, "MOVING").otherwise("STATIC")
    return win.dwell(out.withColumn("raw_state", raw), keys, order, "raw_state", s.dwell, "state").drop("_left", "_right", "_here", "_last")


def contact_candidates(hands: DataFrame, keys: list[str], points: str, near: str, hardware: str, hardware_provenance: str, s: Settings = DEFAULT) -> DataFrame:
    """Candidates of contact per finger: half the curl away from objects, capped, by vision (the index for the thumb), and the hardware's reading where there is one (a map of finger to value)."""
    curls = geo.finger_curl(F.col(points))
    share = F.when(F.col(near), 1.0).otherwise(0.5)
    seen = [F.struct(F.lit(f).alias("finger"), F.least(F.greatest(curls["index" if f == "thumb" else f] * share, F.lit(0.0)), F.lit(s.vision_contact_cap)).alias("value")) for f in FINGERS]
    vision = hands.select(*keys, F.explode(F.array(*seen)).alias("c")).select(*keys, F.col("c.finger").alias("finger"), F.col("c.value").alias("value"), F.lit("vision_fallback").alias("provenance"), F.col("c.value").alias("confidence"), F.lit(0).alias("ordinal"))
    measured = hands.filter(F.col(hardware).isNotNull()).select(*keys, F.explode(hardware).alias("finger", "value"), F.col(hardware_provenance).alias("provenance"), F.lit(1.0).alias("confidence"), F.lit(1).alias("ordinal"))
    return vision.unionByName(measured)


def fuse_contact(hands: DataFrame, keys: list[str], points: str, near: str, hardware: str, hardware_provenance: str, s: Settings = DEFAULT) -> DataFrame:
    return arbitrate(contact_candidates(hands, keys, points, near, hardware, hardware_provenance, s), [*keys, "finger"])


def assign_tracks(detections: DataFrame, keys: list[str], frame: str, least_iou: float = 0.3) -> DataFrame:
    """track_id of each detection: greedily, in order, the free track of its class and best overlap in the last frame, else a new one.

    detections: keys, frame, det (order in the frame), class_label, bbox. A track's choice depends on the
    choices before it, so a key's frames are folded in order in one task; a key's state is its tracks.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in detections.schema.fields) + ", track_id long"

    def fold(pdf):
        import pandas as pd

        pdf = pdf.sort_values([frame, "det"]).reset_index(drop=True)
        tracks: dict[int, tuple[str, list[float]]] = {}
        fresh, ids, taken, now = 0, [], set(), None
        for row in pdf.itertuples():
            at = getattr(row, frame)
            if at != now:
                now, taken = at, set()
            best, found = least_iou, None
            x1, y1, x2, y2 = row.bbox
            for key, (name, box) in tracks.items():
                if key in taken or name != row.class_label:
                    continue
                w, h = min(x2, box[2]) - max(x1, box[0]), min(y2, box[3]) - max(y1, box[1])
                inter = max(w, 0) * max(h, 0)
                union = (x2 - x1) * (y2 - y1) + (box[2] - box[0]) * (box[3] - box[1]) - inter
                overlap = inter / union if union > 0 else 0.0
                if overlap > best or (overlap == best and found is None):
                    best, found = overlap, key
            if found is None:
                found, fresh = fresh, fresh + 1
            taken.add(found)
            tracks[found] = (row.class_label, [x1, y1, x2, y2])
            ids.append(found)
        return pdf.assign(track_id=pd.Series(ids, dtype="int64"))

    return detections.groupBy(*keys).applyInPandas(fold, schema)


def near_hand(detections: DataFrame, hands: DataFrame, on: list[str], radius: float) -> DataFrame:
    """Detections whose centre lies within a radius of the hand's; none without a hand. detections: cx, cy; hands: hx, hy."""
    return detections.join(hands, on).filter(F.hypot(F.col("cx") - F.col("hx"), F.col("cy") - F.col("hy")) <= radius)
