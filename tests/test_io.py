import json
import struct

import pytest
from pyspark.sql import functions as F

from motolake import hooks
from motolake.operators.package import data_card
from motolake.sinks import store
from motolake.sources import adapters, files, imu, resolvers


@pytest.fixture
def folder(tmp_path):
    return tmp_path


def test_imu_spellings(spark, folder):
    (folder / "imu_a.json").write_text(json.dumps([{"timestamp_ns": 5, "gyro": [1, 2, 3], "accel": {"x": 1, "y": 0, "z": 0}}, {"timestamp_ms": 2, "gyro_x": 1, "gyro_y": 1, "gyro_z": 1, "temp_c": 20.5}, {"timestamp_ns": 1}, {"timestamp_s": 1.5, "gyroX": "1", "gyroY": "2", "gyroZ": "nan"}]))
    (folder / "imu_b.json").write_text(json.dumps({"samples": [{"epoch_ms": 3, "gyro": [0, 0, 1, 9], "nearest_video_frame": 4}]}))
    records = imu.read_json(spark, f"{folder}/*.json")
    out = imu.columnar(records, "record", ["source"]).orderBy("timestamp_ns").collect()
    assert [r["timestamp_ns"] for r in out] == [5, 2_000_000, 3_000_000]
    assert out[0]["accel"] == [1.0, 0.0, 0.0] and out[1]["accel"] == [0.0, 0.0, 0.0] and out[1]["temp_c"] == 20.5
    assert out[2]["gyro"] == [0.0, 0.0, 1.0] and out[2]["frame"] == 4 and out[2]["mag"] is None


def test_imu_csv_and_two_files(spark, folder):
    (folder / "imu.csv").write_text("timestamp_ns,gyro.x,gyro.y,gyro.z\n1,0.1,0.2,0.3\n2,,0.2,0.3\n")
    out = imu.columnar(imu.read_csv(spark, f"{folder}/imu.csv"), "record").collect()
    assert len(out) == 1 and out[0]["gyro"] == [0.1, 0.2, 0.3]
    two = spark.createDataFrame([("s", "imu.json"), ("s", "imu.csv"), ("r", "imu.csv")], "session_id string, path string")
    assert [(r["session_id"], r["paths"]) for r in imu.ambiguous(two, "session_id").collect()] == [("s", ["imu.csv", "imu.json"])]


def test_streams_layouts_and_videos(spark):
    names = {"a": ["imu.json", "raw.mp4", "compressed.mp4"], "b": ["imu1.csv", "imu2.csv", "cam.mp4"], "c": ["glove.bin"]}
    listing = spark.createDataFrame([(s, n) for s, ns in names.items() for n in ns], "session_id string, name string")
    streams = spark.createDataFrame([(s, "imu", p, True) for s in names for p in ("imu*.json", "imu*.csv")] + [("a", "glove", "glove*", False)], "session_id string, stream string, pattern string, required boolean")
    out = sorted((r["session_id"], r["problem"], r["subject"]) for r in files.stream_problems(listing, streams, "session_id").collect())
    assert out == [("b", "ambiguous", "imu"), ("c", "missing", "imu"), ("c", "undeclared", "glove.bin")]
    videos = {r["session_id"]: r["video"] for r in files.preferred_video(listing, "session_id").collect()}
    assert videos == {"a": "compressed.mp4", "b": "cam.mp4"}
    layouts = {r["session_id"]: r["layout"] for r in files.layout(listing.withColumn("aspect", F.when(F.col("session_id") == "b", 2.0)), "session_id", "aspect").collect()}
    assert layouts == {"a": "multi_view", "b": "stereo", "c": "unknown"}


def test_cameras_and_claims(spark):
    s = spark.createDataFrame([("a", 1920, 1080), ("b", 1920, 1080)], "device_id string, width int, height int")
    m = spark.createDataFrame([("a", 660.0, 661.0, 960.0, 540.0), ("b", -1.0, 1.0, 1.0, 1.0)], "device_id string, fx double, fy double, cx double, cy double")
    out = {r["device_id"]: r for r in files.intrinsics(s, m).collect()}
    assert out["a"]["fx"] == 660.0 and out["a"]["intrinsics_source"] == "measured"
    assert out["b"]["fx"] == pytest.approx(1104.4, abs=0.5) and out["b"]["intrinsics_source"] == "field_of_view"
    rates = spark.createDataFrame([("30000/1001",), ("30",), ("1/0",)], "r string").select(files.fps_of(F.col("r")).alias("f")).collect()
    assert [r["f"] for r in rates] == [pytest.approx(29.97, abs=0.01), 30.0, None]
    claims = spark.createDataFrame([(100, 105, 5, 5), (100, 200, 5, 6)], "size_bytes long, claimed_bytes long, claimed_frames int, perceived_frames int")
    assert [r["problems"] for r in files.claim_problems(claims).collect()] == [["size", "frames"]]


def test_raw_cubes_and_hashes(spark, folder):
    (folder / "ok.raw").write_bytes(struct.pack("<8f", *range(8)))
    (folder / "short.raw").write_bytes(b"123")
    out = files.raw_cubes(spark, f"{folder}/*.raw", (2, 2)).orderBy("path", "frame_idx").collect()
    assert [r["values"] for r in out] == [[0, 1, 2, 3], [4, 5, 6, 7], None]
    assert files.content_hashes(spark, str(folder), "*.raw").filter(F.length("content_hash") == 64).count() == 2
    assert files.listing(spark, str(folder)).count() == 2


def test_addresses():
    assert resolvers.resolve("s3://b/k").path == "s3a://b/k" and not resolvers.resolve("/data/x").needs_staging
    assert resolvers.stage("https://x/y", lambda kind, path: f"/staged/{kind}") == "/staged/web"


def test_joint_adapter(spark):
    hand = [[0.0, 0.0, 0.0]] * 21
    rows = spark.createDataFrame([("e", 0, 0.0, [("left", hand), ("right", hand[:5])]), ("e", 1, 0.1, [("right", hand[:5])])], adapters.JOINTS)
    out = adapters.joints(rows)
    assert [list(r["hands"]) for r in out.collect()] == [["left"]]
    segs = spark.createDataFrame([("e", "a", -3, 9), ("e", "b", 5, 9)], adapters.SEGMENTS)
    assert [(r["start_frame"], r["end_frame"]) for r in adapters.subtasks(segs, out).collect()] == [(0, 0)]


def test_store_round_trip_and_rewrite(spark, folder):
    rows = [("e1", 1, 0, {"b": 0.5, "a": 1.0}, {"x": "vision_primary"}), ("e2", 1, 0, {}, None)]
    df = spark.createDataFrame(rows, "episode_id string, version int, frame_idx int, confidence map<string,double>, provenance map<string,string>")
    path = f"file://{folder}/canonical"
    store.write_episodes(df, path)
    store.write_episodes(df.filter("episode_id = 'e1'"), path)
    back = store.read_episodes(spark, path, "e1", 1).collect()
    assert len(back) == 1 and back[0]["confidence"] == {"a": 1.0, "b": 0.5} and back[0]["confidence_json"] == '{"a":1.0,"b":0.5}'
    assert store.read_episodes(spark, path).count() == 2
    for bad in ("/x", "a/../b"):
        with pytest.raises(ValueError):
            store.clean_key(bad)


def test_delivery_checks_all_before_writing(spark, folder):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "episode_id string, x int")
    eps = spark.createDataFrame([("a", "granted", "passed", 5), ("b", "granted", "passed", 1)], "episode_id string, consent string, pii_status string, quality int")
    out, ledger = f"file://{folder}/out", f"file://{folder}/ledger"
    with pytest.raises(store.DeliveryRefused, match="b: quality is 1"):
        store.deliver(rows, eps, out, ledger, "c", "n")
    assert not (folder / "out").exists()
    assert store.deliver(rows, eps.filter("episode_id = 'a'"), out, ledger, "c", "n") == 1
    assert spark.read.parquet(out).count() == 1 and spark.read.parquet(ledger).first()["customer"] == "c"


def test_metadata_and_columns(spark):
    a = spark.createDataFrame([("s", {"x": "1", "y": "2"}), ("t", {"x": "1"})], "k string, m map<string,string>")
    b = spark.createDataFrame([("s", {"y": "3", "z": "4"})], "k string, m map<string,string>")
    out = {r["k"]: r["m"] for r in store.merge_metadata(a, b, "k", "m").collect()}
    assert out == {"s": {"x": "1", "y": "3", "z": "4"}, "t": {"x": "1"}}
    df = spark.createDataFrame([(1, None, 2.0)], "a int, b double, c double")
    assert store.measured_columns(df, ["b", "c"]).columns == ["a", "c"]
    up = store.upsert(a, b, ["k"])
    assert {r["k"]: len(r["m"]) for r in up.collect()} == {"s": 2, "t": 1}
    depth = spark.createDataFrame([("s", i, 4, 4 + (i > 1)) for i in range(3)], "s string, f int, height int, width int")
    assert [r["chunk_index"] for r in store.depth_refs(depth.filter("f < 2"), ["s"], "f").orderBy("f").collect()] == [0, 1]
    with pytest.raises(Exception, match="differ in shape"):
        store.depth_refs(depth, ["s"], "f").collect()


def test_hooks_load_a_model_once_a_task(spark):
    def model():
        def apply(pdf):
            assert len(pdf) <= 3
            return pdf.assign(y=pdf["x"] * 2)

        return apply

    df = spark.range(10).withColumnRenamed("id", "x")
    assert sorted(r["y"] for r in hooks.infer(df, model, "x long, y long", batch=3).collect()) == list(range(0, 20, 2))
    seq = hooks.infer_sequences(df.withColumn("k", F.col("x") % 2), ["k"], "x", lambda p: p.assign(y=p["x"].cumsum()), "x long, k long, y long")
    assert sorted(r["y"] for r in seq.collect())[-1] == 25
    assert hooks.unavailable(df, "pose", "array<double>").first()["pose"] is None


def test_card():
    assert "| b | 3 |\n| a | 1 |" in data_card({"episodes": 4}, [("a", 1), ("b", 3)], "T")
