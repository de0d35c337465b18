"""A finished stream gives what the batch form gives."""

import random

from pyspark.sql import functions as F

from motolake.operators import privacy
from motolake.operators import windows as win
from motolake.settings import Settings
from motolake.streaming import operators as st


def run(spark, df, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name)


def source(spark, tmp_path, df, parts=3):
    """A stream of files that come in order, one a micro-batch."""
    path = tmp_path / "in"
    for p in range(parts):
        df.filter(f"i div 20 = {p}").drop("part").coalesce(1).write.mode("append").parquet(f"file://{path}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"file://{path}")


def signal(spark, seed=0):
    rng = random.Random(seed)
    rows = [(k, i, rng.random() if rng.random() > 0.1 else None, rng.random() < 0.1) for k in ("a", "b") for i in range(60)]
    return spark.createDataFrame(rows, "k string, i long, v double, seen boolean")


def test_hysteresis(spark, tmp_path):
    df = signal(spark)
    got = run(spark, st.hysteresis(source(spark, tmp_path, df), "k", "i", "v", 0.7, 0.3), "hysteresis_out")
    want = win.hysteresis(df, ["k"], ["i"], "v", 0.7, 0.3)
    assert sorted((r["k"], r["i"], r["on"]) for r in got.collect()) == sorted((r["k"], r["i"], r["on"]) for r in want.collect())


def test_regions_expire(spark, tmp_path):
    df, s = signal(spark, 1), Settings(ocr_grace=4, ocr_interval=5)
    got = run(spark, st.regions(source(spark, tmp_path, df), "k", "i", "seen", s), "regions_out")
    want = privacy.active_regions(df, ["k"], "i", "seen", s)
    assert sorted((r["k"], r["i"], r["active"]) for r in got.collect()) == sorted((r["k"], r["i"], r["active"]) for r in want.collect())


def test_windows_and_sessions(spark, tmp_path):
    rows = [("a", i, t, 0.1 if t < 2 else 0.9) for i, t in enumerate((0.0, 0.5, 1.0, 3.0, 20.0, 20.5))]
    df = spark.createDataFrame(rows, "k string, i long, t double, v double").withColumn("ts", F.timestamp_seconds(F.col("t") + 1_700_000_000))
    stream = source(spark, tmp_path, df, 1)
    low = run(spark, st.low_windows(stream, "ts", ["k"], "v"), "low_out", "complete").collect()
    assert sorted(r["n"] for r in low) == [1, 2]
    spans = run(spark, st.sessions(stream, "ts", ["k"]), "spans_out", "append").collect()
    batch = df.groupBy(F.session_window("ts", "8 seconds"), "k").count().collect()
    assert {r["count"] for r in batch} == {4, 2} and all(r["n"] in (4, 2) for r in spans)


def test_gaps(spark, tmp_path):
    df = spark.createDataFrame([("a", i, float(i) + (0.5 if i >= 25 else 0.0)) for i in range(60)], "k string, i long, t double")
    got = run(spark, st.gaps(source(spark, tmp_path, df), "k", "t", 1.2), "gaps_out").collect()
    assert [r["t"] for r in got] == [25.5]
