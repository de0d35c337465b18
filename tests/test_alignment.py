import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from motolake.operators import alignment


def test_tiers_keep_unknown_apart(spark):
    df = spark.createDataFrame([(100.0, 103.0), (100.0, 120.0), (None, 100.0)], "a double, b double")
    out = df.select(alignment.tier(F.col("a"), F.col("b")).alias("t")).collect()
    assert [(r["t"]["tier"], r["t"]["aligned"]) for r in out] == [("stage2_anchor", True), ("stage1_volume", False), ("stage1_volume", None)]


def test_wrists(spark):
    rows = [("a", 0, 1.0, 2.0), ("a", 1, None, 3.0), ("a", 2, None, None)]
    df = spark.createDataFrame(rows, "k string, i int, right_wrist double, left_wrist double")
    assert [r["wrist"] for r in alignment.wrists(df, ["k"]).orderBy("i").collect()] == [1.0, 3.0]
    with pytest.raises(Exception, match="too few"):
        alignment.wrists(df.filter("i > 0"), ["k"]).collect()


def test_rotations(spark):
    def turn(angle):
        return [math.cos(angle / 2), 0.0, 0.0, math.sin(angle / 2)]

    rng = np.random.default_rng(0)
    rows = [("s", turn(a), turn(a + 0.01)) for a in rng.uniform(0.1, 1, 50)]
    out = alignment.rotation_agreement(spark.createDataFrame(rows, "k string, a array<double>, b array<double>"), ["k"], "a", "b").first()
    assert out["median_deg"] == pytest.approx(math.degrees(0.01), rel=1e-3) and out["correlation"] > 0.999


def test_anchored_depth(spark):
    video = spark.createDataFrame([("s", i, 2.0) for i in range(11)], "k string, frame int, depth double")
    anchors = spark.createDataFrame([("s", f, x, (1.0 + f / 10) * x + 0.5) for f in (0, 10) for x in (1.0, 2.0, 3.0)], "k string, frame int, relative double, metric double")
    out = alignment.anchored_depth(video, anchors, ["k"], "frame", "depth").orderBy("frame").collect()
    assert [r["metric_depth"] for r in out] == [pytest.approx(2.5 + 0.2 * i) for i in range(11)]


def test_profiles_need_consent(spark):
    kind = "worker_id string, consent_granted boolean, power_grasp_dist double"
    old = spark.createDataFrame([("a", True, 0.1), ("b", True, 0.2)], kind)
    out = alignment.save_profile(old, spark.createDataFrame([("a", True, 0.3)], kind))
    assert {r["worker_id"]: r["power_grasp_dist"] for r in out.collect()} == {"a": 0.3, "b": 0.2}
    with pytest.raises(Exception, match="no consent"):
        alignment.save_profile(old, spark.createDataFrame([("c", False, 0.3)], kind)).collect()
    assert alignment.delete_profile(old, old.filter("worker_id = 'a'")).count() == 1
    with pytest.raises(FileNotFoundError):
        alignment.required(None, "episodes")
