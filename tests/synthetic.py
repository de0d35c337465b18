"""Small sessions built by rule, as the stages before would leave them."""

from __future__ import annotations

import math

from motolake.hooks import HAND_POSE, OBJECT_TRACKS

HAND = "struct<confidence:double,landmarks:array<array<double>>>"


def landmarks(bend: float, x: float = 0.0, y: float = 0.0):
    """A right hand whose fingers bend by an angle at each joint."""
    points = [[x, y, 0.0] for _ in range(21)]
    for f, base in enumerate((5, 9, 13, 17)):
        px, py, angle = x + 0.02 * f, y + 0.1, 0.0
        for j in range(4):
            points[base + j] = [px, py, 0.0]
            angle += bend
            px, py = px + 0.04 * math.sin(angle), py + 0.04 * math.cos(angle)
    for j in range(1, 5):
        points[j] = [x - 0.03 * j, y + 0.03 * j, 0.0]
    return points


def pose_row(session, i, grasp, speed=0.0, vx=0.0, dominant="right", detected=True, bend=None):
    hand = (0.9, landmarks(bend if bend is not None else (0.9 if grasp else 0.0), 0.01 * i))
    derived = (0.05 if grasp else 0.2, [0.05 if grasp else 0.3] * 5, [vx, 0.0], speed)
    if not detected:
        return (session, i, False, None, None, None, None)
    return (session, i, True, dominant, hand if dominant == "right" else None, hand if dominant == "left" else None, derived)


def session(spark, n=240, fps=30.0):
    """Two sessions: reach, hold, release, over and over; and one without a hand."""
    frames, pose, imu, objects = [], [], [], []
    for s in ("busy", "empty"):
        for i in range(n):
            t = i / fps
            frames.append((s, i, t))
            phase = (i // 30) % 4
            grasp = phase in (1, 2)
            pose.append(pose_row(s, i, grasp, speed=0.6 if phase == 0 else 0.0, vx=0.5 if phase == 0 else 0.0, detected=s == "busy"))
            if s == "busy":
                objects.append((s, i, [(0, "bolt", 0.8, [0.0, 0.0, 0.2, 0.2], [0.01 * i, 0.05])]))
        for k in range(int(n / fps * 100) + 1):
            t = k / 100
            imu.append((s, t, 0.05, 0.0, 0.0, 0.3 * math.sin(t) if s == "busy" else 0.0, 0.0, 0.0))
    return {
        "frames": spark.createDataFrame(frames, "session_id string, frame_idx int, t double"),
        "pose": spark.createDataFrame(pose, HAND_POSE),
        "imu": spark.createDataFrame(imu, "session_id string, t double, ax double, ay double, az double, gx double, gy double, gz double"),
        "objects": spark.createDataFrame(objects, OBJECT_TRACKS),
        "sharpness": spark.createDataFrame([(s, i, 120.0, 1.0) for s in ("busy", "empty") for i in range(0, n, 30)], "session_id string, frame_idx int, blur double, coverage double"),
        "sessions": spark.createDataFrame([("busy", "none", None, "granted", "passed", True, True), ("empty", "thick", None, "pending", "passed", False, False)], "session_id string, glove_type string, worker_id string, consent string, pii_status string, redacted boolean, retargetable boolean"),
    }
