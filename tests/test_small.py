from pyspark.sql import functions as F

from motolake.functions import geometry as geo
from motolake.operators import logs, package
from motolake.sources import files


def test_points_that_are_not_there(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, [[nan, nan], [nan, nan]]), (1, [[nan, 1.0], [2.0, 3.0]])], "i int, p array<array<double>>")
    out = df.orderBy("i").select(geo.present_points(F.col("p")).alias("h"), geo.strips(F.col("p"), [(0, 1), (1, 1), (1, 5)]).alias("s")).collect()
    assert out[0]["h"] is None and out[1]["h"] is not None
    assert [len(r["s"]) for r in out] == [0, 1]


def test_colours_and_names(spark):
    df = spark.createDataFrame([(None,), (2.0,)], "c double").select(geo.contact_colour(F.col("c")).alias("rgb"), package.dof_names(F.col("c").isNull()).alias("n")).collect()
    assert [r["rgb"] for r in df] == [[128, 128, 128], [255, 0, 0]] and [len(r["n"]) for r in df] == [53, 8]


def test_log_and_fallback(spark):
    rows = [("a", 0, "[x] done (2s)"), ("a", 1, "noise"), ("a", 2, "[x] FAILED (3s)"), ("a", 3, "[y] done (1s)")]
    status = logs.stage_status(spark.createDataFrame(rows, "k string, i int, line string"), ["k"], "i", "line")
    assert sorted((r["stage"], r["seconds"], r["status"]) for r in status.collect()) == [("x", 5, "FAILED"), ("y", 1, "done")]
    p = logs.progress(status, ["k"], ["x", "y"]).first()
    assert p["percent"] == 50.0 and p["next_stage"] == "x" and p["failed"]
    a, b = spark.createDataFrame([("s", None, 2)], "k string, x int, y int"), spark.createDataFrame([("s", 1, 9), ("t", 3, 4)], "k string, x int, y int")
    out = {r["k"]: (r["x"], r["y"]) for r in files.with_fallback(a, b, "k", ["x", "y"]).collect()}
    assert out == {"s": (1, 2), "t": (3, 4)}
