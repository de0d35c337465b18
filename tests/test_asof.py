import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from motolake.operators import asof, sync

K = ["k"]


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    samples = {k: sorted({round(rng.uniform(0, 10), 2) for _ in range(rng.randint(1, 30))}) for k in range(12)}
    values = {k: [rng.random() for _ in ts] for k, ts in samples.items()}
    probes = {k: [round(rng.uniform(-1, 11), 2) for _ in range(20)] + ts[:2] for k, ts in samples.items()}
    return samples, values, probes


def frames(spark, data):
    samples, values, probes = data
    s = spark.createDataFrame([(k, t, v) for k, ts in samples.items() for t, v in zip(ts, values[k], strict=True)], "k int, st double, v double")
    p = spark.createDataFrame([(k, j, t) for k, ts in probes.items() for j, t in enumerate(ts)], "k int, j int, t double")
    return p, s


def test_interpolation_is_numpys(spark, data):
    samples, values, probes = data
    p, s = frames(spark, data)
    got = {(r["k"], r["j"]): r["v"] for r in asof.interpolate(p, s, K, "t", "st", ["v"]).collect()}
    for k, ts in probes.items():
        want = np.interp(ts, samples[k], values[k])
        assert [got[k, j] for j in range(len(ts))] == pytest.approx(list(want))


def test_nearest_prefers_the_later_of_equals(spark, data):
    samples, _, probes = data
    p, s = frames(spark, data)
    got = {(r["k"], r["j"]): r["nearest"] for r in asof.nearest(p, s, K, "t", "st").collect()}
    for k, ts in probes.items():
        for j, t in enumerate(ts):
            assert got[k, j] == min(samples[k], key=lambda x: (abs(x - t), -x))
    one = spark.createDataFrame([(0, 1.0)], "k int, t double"), spark.createDataFrame([(0, 0.0, 1.0), (0, 2.0, 1.0)], "k int, st double, v double")
    assert asof.nearest(*one, K, "t", "st").first()["nearest"] == 2.0


def test_probe_without_samples_is_null(spark):
    p, s = spark.createDataFrame([(0, 1.0)], "k int, t double"), spark.createDataFrame([(1, 0.0, 1.0)], "k int, st double, v double")
    assert asof.interpolate(p, s, K, "t", "st", ["v"]).first()["v"] is None


def test_fill_missing_holds_the_ends(spark):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate([None, 1.0, None, 3.0, None])], "k int, i int, v double")
    assert [r["f"] for r in asof.fill_missing(df, K, "i", "v", "f").orderBy("i").collect()] == [1.0, 1.0, 2.0, 3.0, 3.0]


def test_frames_in_a_dropout_are_told_apart(spark):
    times = [i / 100 for i in range(100) if not 30 < i < 40]
    samples = spark.createDataFrame([("s", t, t) for t in times], "session_id string, t double, gx double")
    video = spark.createDataFrame([("s", i, i / 10 + 0.05 * (i in (3,))) for i in range(10)], "session_id string, frame_idx int, t double")
    out = sync.synchronise(video, samples, ["session_id"], "t", ["gx"])
    rows = out.orderBy("frame_idx").collect()
    assert [r["frame_idx"] for r in rows if r["over_dropout"]] == [3]
    assert rows[3]["gx"] == pytest.approx(0.35)
    stats = sync.drift_stats(out, ["session_id"]).first()
    assert stats["max_drift_ms"] == pytest.approx(50) and stats["max_drift_clean_ms"] < 1e-6


def test_group_by_frame_shifts_one_based_numbers(spark):
    rows = [("s", f, float(v)) for f, v in ((1, 1), (1, 2), (2, 2), (2, 3), (3, 3), (3, 4), (4, 4), (4, 5), (5, 9), (5, 9))]
    df = spark.createDataFrame(rows, "session_id string, f int, gx double").withColumn("n", F.lit(4))
    out = sync.group_by_frame(df, ["session_id"], "f", "n", ["gx"]).orderBy("frame_idx").collect()
    assert [r["gx"] for r in out] == [1.5, 2.5, 3.5, 4.5]


def test_presentation_times_must_increase(spark):
    df = spark.createDataFrame([("s", 0, 5.0), ("s", 1, 5.1), ("s", 2, 5.5)], "session_id string, i int, pts double")
    out = sync.checked_pts(df, ["session_id"], "i", "pts").orderBy("i").collect()
    assert [round(r["pts"], 6) for r in out] == [0.0, 0.1, 0.5] and [r["late"] for r in out] == [False, False, True]
    with pytest.raises(Exception, match="must increase"):
        sync.checked_pts(df.withColumn("pts", F.lit(1.0)), ["session_id"], "i", "pts").collect()
