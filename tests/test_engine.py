import pytest

from motolake.plans.engine import STAGES, Engine
from tests.synthetic import session


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    made = Engine(spark, session(spark), store_dir=f"file://{tmp_path_factory.mktemp('store')}")
    made.run()
    return made


def test_all_stages_run_and_are_reused(spark, engine):
    assert [s for _, s in engine.status()] == ["made"] * len(STAGES)
    again = Engine(spark, engine.tables, store_dir=engine.store_dir)
    again.run("episodes")
    assert [s for _, s in again.status()][:5] == ["reused"] * 5
    assert {s: engine.stage(s).count() for s in ("sync", "primitives", "phases")} == {"sync": 480, "primitives": 480, "phases": 480}


def test_other_rows_and_other_sessions_make_other_tables(spark, engine):
    from pyspark.sql import functions as F

    other = {**engine.tables, "imu": engine.tables["imu"].withColumn("gx", F.col("gx") + 1e-6)}
    assert Engine(spark, other, store_dir=engine.store_dir).key("sync") != engine.key("sync")
    nulls = {**engine.tables, "imu": engine.tables["imu"].withColumn("gx", F.when(F.col("t") > 0, F.col("gx")))}
    assert Engine(spark, nulls, store_dir=engine.store_dir).key("sync") != engine.key("sync")
    again = Engine(spark, {k: t.orderBy(F.rand(3)) for k, t in engine.tables.items()}, store_dir=engine.store_dir)
    assert again.key("sync") == engine.key("sync")
    some = Engine(spark, dict(engine.tables), store_dir=engine.store_dir)
    some.run("sync", sessions=["busy"])
    assert some.log == [("sync", "made")] and some.stage("sync").select("session_id").distinct().count() == 1
    whole = Engine(spark, dict(engine.tables), store_dir=engine.store_dir)
    assert whole.stage("sync").select("session_id").distinct().count() == 2
    one, two = (Engine(spark, engine.tables, store_dir=engine.store_dir, version=v) for v in ("1", "2"))
    assert one.key("sync") != two.key("sync") and not one.prints


def test_phases_follow_the_hand(engine):
    seen = [r["phase"] for r in engine.segments().filter("session_id = 'busy'").orderBy("start_frame").collect()]
    assert "grasp" in seen and "reach" in seen
    assert {r["phase"] for r in engine.segments().filter("session_id = 'empty'").collect()} == {"idle"}


def test_every_session_has_an_episode(engine):
    rows = {r["session_id"]: r for r in engine.stage("episodes").collect()}
    assert rows["busy"]["episode_id"] == "busy_ep00" and rows["busy"]["end_frame"] == 239
    assert set(rows) == {"busy", "empty"}


def test_certificates_tell_sessions_apart(engine):
    rows = {r["session_id"]: r for r in engine.stage("certificates").collect()}
    assert rows["busy"]["hand_presence_rate"] == 1.0 and rows["empty"]["hand_presence_rate"] == 0.0
    assert rows["busy"]["eis"] > rows["empty"]["eis"]
    assert "no_metric_3d_retargeting_ineligible" in rows["empty"]["flags"]


def test_gates_block_what_isnt_granted(engine):
    reasons = {r["session_id"]: r["reason"] for r in engine.deliverable().collect()}
    assert reasons["empty"] == "consent is pending"
    assert engine.manifest().first()["episode_count"] == 1


def test_labels_and_language(engine):
    rows = {r["session_id"]: r for r in engine.stage("labels").collect()}
    assert rows["busy"]["L1_task"] and len(rows["busy"]["L2_phases"]) > 1 and rows["busy"]["L3_primitives"]
    text = {r["session_id"]: r["instruction"] for r in engine.stage("language").collect()}
    assert "{" not in text["busy"] and "right hand" in text["empty"] or "Idle" in text["empty"]
    assert engine.report().startswith("# Batch")


def test_modes_agree_on_what_the_pose_says(spark, engine, tmp_path):
    flags = ("power_grasp", "lateral_pinch", "reach_onset", "finger_curl", "transport")
    seen = {}
    for mode in ("head_mounted", "wrist_mounted", "dual"):
        table = Engine(spark, engine.tables, mode=mode, store_dir=f"file://{tmp_path}").stage("primitives")
        seen[mode] = [tuple(r) for r in table.orderBy("session_id", "frame_idx").select(*flags).collect()]
    assert seen["head_mounted"] == seen["wrist_mounted"] == seen["dual"]
    with pytest.raises(ValueError, match="unknown sensor mode"):
        Engine(spark, engine.tables, mode="foot_mounted").stage("primitives")


def test_empty_tables(spark):
    tables = {k: t.limit(0) for k, t in session(spark, n=30).items()}
    out = Engine(spark, tables).run("phases")
    assert all(t.count() == 0 for t in out.values())


def test_schema_snapshot_is_stable():
    assert Engine.schema_snapshot() == Engine.schema_snapshot() and '"interaction_state"' in Engine.schema_snapshot()


def test_certificates_take_in_contact_simulation_and_mistakes(spark):
    from motolake.plans.engine import Engine
    from motolake.settings import Settings

    frames = spark.createDataFrame(
        [(e, k / 2, "glove" if e == "a" else "head", {"left": {"thumb": 0.9 if k < 3 else 0.1}}, True, {"hand": 0.2 if k < 2 else 0.8}, (1.0,)) for e in "ab" for k in range(4)],
        "episode_id string, t double, rig string, contact map<string,map<string,double>>, grasped boolean, confidence map<string,double>, camera_pose struct<x:double>",
    )
    drift = spark.createDataFrame([(e, 0.0, 30.0) for e in "ab"], "episode_id string, drift_ms double, fps double")
    rigs = spark.createDataFrame([("glove", "contact"), ("head", "pose")], "rig string, channel string")
    simulated = spark.createDataFrame([("a", "arm", 0.5, ["teleports"])], "episode_id string, embodiment string, ik_convergence_rate double, reasons array<string>")
    earlier = spark.createDataFrame([("a", ["dropped it"])], "episode_id string, mistakes array<string>")
    engine = Engine.__new__(Engine)
    engine.settings = Settings()
    out = {r["episode_id"]: r for r in engine.certify(frames, drift, True, rigs=rigs, simulated=simulated, earlier=earlier).collect()}
    low = "low_confidence@0s-1s(mean 0.20)"
    assert (out["a"]["contact_consistency"], out["a"]["ik_convergence_rate"], out["a"]["notes"]) == (0.75, 0.5, [])
    assert out["a"]["mistakes"] == [low, "dropped it", "sim_validate[arm]: teleports"] and out["b"]["mistakes"] == [low]
    # 1 + 4 (0.15 + 0.3 + 0.35 * 0.5 + 0.05 * 0.75 + 0.15 * 0.5) = 3.95
    assert out["a"]["quality"] == 4
    assert out["b"]["notes"] == ["contact_consistency not measured", "ik_convergence_rate not measured"]
    plain = {r["episode_id"]: r for r in engine.certify(frames, drift, True).collect()}
    assert plain["a"]["notes"] == out["b"]["notes"] and plain["a"]["mistakes"] == [low]
