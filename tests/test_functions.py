import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from motolake.functions import geometry as geo
from motolake.functions import strings


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def unit(rng):
    q = rng.normal(size=4)
    return q / np.linalg.norm(q)


def matrix(q):
    w, x, y, z = q
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]])


def test_rotations_agree_with_matrices(spark):
    rng = np.random.default_rng(0)
    for _ in range(8):
        p, q, v = unit(rng), unit(rng), rng.normal(size=3)
        r = one(
            spark,
            geo.quaternion_to_matrix(geo.vector(*p)).alias("m"),
            geo.rotate(geo.vector(*p), geo.vector(*v)).alias("v"),
            geo.quaternion_to_matrix(geo.multiply(geo.vector(*p), geo.vector(*q))).alias("pq"),
            geo.quaternion_to_matrix(geo.matrix_to_quaternion(geo.quaternion_to_matrix(geo.vector(*p)))).alias("back"),
            geo.quaternion_to_matrix(geo.axis_angle_to_quaternion(geo.matrix_to_axis_angle(geo.quaternion_to_matrix(geo.vector(*p))))).alias("axis"),
        )
        assert np.allclose(r["m"], matrix(p).ravel()) and np.allclose(r["v"], matrix(p) @ v)
        assert np.allclose(r["pq"], (matrix(p) @ matrix(q)).ravel())
        assert np.allclose(r["back"], matrix(p).ravel()) and np.allclose(r["axis"], matrix(p).ravel(), atol=1e-6)


def test_reprojection_needs_both_cameras(spark):
    rng = np.random.default_rng(1)

    def pose(q, t):
        return geo.pose(geo.vector(*t), geo.vector(*q))

    qs, ts = [unit(rng) for _ in range(3)], [rng.normal(size=3) for _ in range(3)]
    w, c0, c1 = (pose(q, t) for q, t in zip(qs, ts, strict=True))
    got = one(spark, geo.reproject(w, c0, c1).alias("p"), geo.reproject(w, F.lit(None).cast("struct<position_m:array<double>,quaternion_wxyz:array<double>>"), c1).alias("n"))
    four = [np.vstack([np.hstack([matrix(q), t[:, None]]), [0, 0, 0, 1]]) for q, t in zip(qs, ts, strict=True)]
    want = np.linalg.inv(four[1]) @ four[2] @ four[0]
    assert np.allclose(got["p"]["position_m"], want[:3, 3]) and got["n"] is None


def test_degenerate_geometry(spark):
    zero = geo.vector(0, 0, 0)
    flat = F.array(*(geo.vector(float(i), 0, 0) for i in range(21)))
    r = one(spark, geo.joint_angle(zero, zero, zero).alias("a"), geo.palm_quaternion(flat).alias("q"), geo.iou(geo.vector(0, 0, 0, 0), geo.vector(0, 0, 0, 0)).alias("i"), geo.wrap_angle(F.lit(-3 * math.pi / 2)).alias("w"))
    assert r["a"] == pytest.approx(math.pi) and r["q"] is None and r["i"] == 0.0 and r["w"] == pytest.approx(math.pi / 2)


def test_run_lengths_round_trip(spark):
    rng = random.Random(3)
    masks = [[rng.random() < 0.4 for _ in range(40)] for _ in range(20)] + [[False] * 40, [True] * 40]
    df = spark.createDataFrame([(m,) for m in masks], "m array<boolean>")
    out = df.select("m", geo.decode_rle(geo.encode_rle(F.col("m"), F.lit(8), F.lit(5))).alias("b"), geo.encode_rle(F.col("m"), F.lit(8), F.lit(5)).alias("s")).collect()
    assert all(r["m"] == r["b"] for r in out)
    assert out[-1]["s"] == "8x5:0,40"
    assert one(spark, geo.mask_iou(F.array(F.lit(False)), F.array(F.lit(False))).alias("i"))["i"] == 1.0


def test_flat_hand_and_fist(spark):
    def hand(bend):
        points = [[0.0, 0.0, 0.0]] * 21
        for f in range(4):
            x, y = 0.1 * f, 0.0
            for j, k in enumerate(range(5 + 4 * f, 9 + 4 * f)):
                points[k] = [x, y, 0.0]
                x, y = x + math.sin(bend * (j + 1)), y + math.cos(bend * (j + 1))
        return F.array(*(geo.vector(*p) for p in points))

    r = one(spark, geo.grasp_signal(hand(0.0)).alias("flat"), geo.grasp_signal(hand(1.6)).alias("fist"))
    assert r["flat"] < 0.15 and r["fist"] > 0.4


def test_even_indices(spark):
    def slow(n, most):
        return list(range(n)) if most is None or n <= most else sorted({int(x) for x in np.round(np.linspace(0, n - 1, most))})

    for n, most in ((0, 5), (1, 5), (10, None), (10, 3), (7, 7), (100, 9), (5, 1)):
        got = one(spark, strings.even_indices(F.lit(n), F.lit(most).cast("int")).alias("x"))["x"]
        assert got == (slow(n, most) if most != 1 else [0])


def test_text_scalars(spark):
    r = one(
        spark,
        strings.fill(F.lit("{a} and {b}"), {"a": F.lit("x")}).alias("fill"),
        strings.disagree(F.lit("Bolt Tightening"), F.lit("bolt_tightening")).alias("same"),
        strings.disagree(F.lit("x"), F.lit("unknown")).alias("unknown"),
        strings.url_filename(F.lit("https://a.b/c/d%20e.mp4?x=1")).alias("file"),
        strings.url_filename(F.lit("https://a.b/")).alias("none"),
        strings.drive_download(F.lit("https://drive.google.com/file/d/abc_1/view")).alias("drive"),
        strings.expires_seconds(F.lit("2h")).alias("h"),
        strings.expires_seconds(F.lit("soon")).alias("bad"),
        strings.epoch_ms(F.lit("1970-01-01T00:00:01Z")).alias("ms"),
        strings.safe_filename(F.lit("a  b/c__é.mp4")).alias("name"),
        strings.safe_prefix(F.lit("/a/../b/./c")).alias("prefix"),
        strings.paraphrases(F.lit("Pick up the box."), 3).alias("p"),
        strings.sorted_json(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2))).alias("json"),
    )
    assert r["fill"] == "x and {b}" and r["same"] is False and r["unknown"] is False
    assert r["file"] == "d e.mp4" and r["none"] == "download" and r["drive"].endswith("id=abc_1")
    assert r["h"] == 7200 and r["bad"] is None and r["ms"] == 1000
    assert r["name"] == "a_b_c_.mp4" and r["prefix"] == "a/b/c"
    assert r["p"] == ["Pick up the box.", "Grab the box.", "Please pick up the box."] and r["json"] == '{"a":2,"b":1}'
