import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from motolake import schema
from motolake.operators import actions, canonical, certify, consent, dataset_qc, eis, fusion, language, package, privacy, qa, retarget, stats, tasks, validate
from motolake.operators import primitives as prim
from motolake.settings import TASK_SIGNATURES, Settings


# ---------------------------------------------------------------- tasks
def test_each_signature_wins_on_its_own_counts(spark):
    rows = [(t, p, n) for t, s in TASK_SIGNATURES.items() for p, n in s.items()]
    out = {r["k"]: r for r in tasks.classify(spark.createDataFrame(rows, "k string, primitive string, n int"), ["k"]).collect()}
    assert {t: out[t]["L1_task"] for t in TASK_SIGNATURES} == {t: t for t in TASK_SIGNATURES}
    assert not any(r["needs_human_review"] for r in out.values())


def test_ties_and_low_scores_are_unknown(spark):
    rows = [("tie", p, 200) for s in TASK_SIGNATURES.values() for p in s] + [("low", "idle", 1)]
    out = {r["k"]: r for r in tasks.classify(spark.createDataFrame(rows, "k string, primitive string, n int").distinct(), ["k"]).collect()}
    assert out["tie"]["L1_task"] == "unknown" and out["tie"]["confidence"] == 1.0 and out["tie"]["needs_human_review"]
    assert out["low"]["L1_task"] == "unknown"


def test_an_object_breaks_a_tie(spark):
    counts = [("k", "transport", 200), ("k", "power_grasp", 200), ("k", "reach_onset", 9)]
    objects = spark.createDataFrame([("k", "box")], "k string, dominant_object string")
    df = spark.createDataFrame(counts, "k string, primitive string, n int")
    with_object = tasks.classify(df, ["k"], objects).first()
    assert with_object["L1_task"] == "material_transfer"


# ---------------------------------------------------------------- validation, scores
def test_causal_order(spark):
    rows = [(0, i, i == 10, i in (8, 40)) for i in range(50)] + [(1, i, i == 3, False) for i in range(5)] + [(2, i, False, True) for i in range(3)]
    df = spark.createDataFrame(rows, "k int, i int, c boolean, e boolean")
    out = {r["k"]: r for r in validate.causal_order(df, ["k"], "i", "c", "e", 1000 / 30).collect()}
    assert out[0]["inversions"] == 1 and out[0]["inversion_frames"] == [10] and not out[0]["passed"]
    assert out[1]["events"] == 1 and out[1]["inversions"] == 0 and out[1]["passed"]
    assert out[2]["events"] == 0 and out[2]["passed"]


def test_spikes_and_nothing_to_check(spark):
    rows = [(0, i, i == 5, 2.0 if i == 9 else 1.0) for i in range(20)] + [(1, 0, False, 1.0)]
    out = {r["k"]: r for r in validate.spikes_at_contact(spark.createDataFrame(rows, "k int, i int, c boolean, m double"), ["k"], "i", "c", "m").collect()}
    assert out[0]["spike_rate"] == 1.0 and out[1]["contacts"] == 0 and out[1]["passed"]


def test_certificate_ignores_what_isnt_measured(spark):
    full = {c: 0.5 for c in Settings().certificate_weights}
    rows = [tuple(full.values()), (None, None, 0.5, None, None), (None,) * 5, (1.0,) * 5]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in full))
    out = df.select(certify.quality().alias("q"), certify.notes().alias("n")).collect()
    assert [r["q"] for r in out] == [3, 3, 1, 5] and [len(r["n"]) for r in out] == [0, 4, 5, 0]


def test_mistakes_and_speed(spark):
    rows = [("e", 100 + i / 10, 0.2 if 10 <= i < 20 else 0.9) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, t double, c double")
    out = certify.mistakes(df, ["k"], "t", "c").collect()
    assert [r["window"] for r in out] == [1] and out[0]["flag"].startswith("low_confidence@1s-2s")
    assert certify.speed(df, ["k"], "t").first()["speed"] == 1
    assert certify.speed(df.limit(1), ["k"], "t").first()["speed"] is None


def test_mistakes_do_not_depend_on_the_order_of_rows(spark):
    # three values with a mean of 20 whose sum as doubles is below 60 in every order, next to one that is lower
    groups = {"a": [37.41, 17.08, 5.51], "b": [10.94, 32.23, 16.83], "c": [9.94, 17.4, 32.66], "low": [10.94, 32.23, 16.82], "large": [1e300, 1e10, 1.0], "odd": [1.0, float("nan"), 2.0], "minus": [float("-inf"), 1.0]}
    assert all(sum(groups[k]) / 3 < 20 for k in "abc")
    rows = [(k, float(i) / 10, v) for k, values in groups.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, t double, c double")
    out = {r["k"]: r["mean"] for r in certify.mistakes(df, ["k"], "t", "c", Settings(mistake_floor=20.0)).collect()}
    assert out == {"low": 59.99 / 3, "minus": float("-inf")}
    same = spark.createDataFrame([("e", i / 10, 0.4) for i in range(3)], "k string, t double, c double")
    assert certify.mistakes(same, ["k"], "t", "c").count() == 0


def test_eis_bounds(spark):
    df = spark.createDataFrame([(0.0, 200.0, 1.0, 1.0, True), (99.0, 0.0, 0.0, 0.0, False)], "d double, b double, p double, l double, c boolean")
    out = eis.score(df, eis.components(F.col("d"), F.col("b"), F.col("p"), F.col("l"), F.col("c"), F.lit(3), F.lit(3))).orderBy("d").collect()
    assert [r["eis"] for r in out] == [100, 0]


def test_fps_gate(spark):
    rows = [("good", i / 30, 30.0) for i in range(60)] + [("claimed", i / 30, 60.0) for i in range(60)]
    out = {r["k"]: r for r in qa.fps_consistency(spark.createDataFrame(rows, "k string, t double, f double"), ["k"], "t", "f").collect()}
    assert out["good"]["passed"] and out["claimed"]["mismatch"] and not out["claimed"]["passed"]


def test_mount_plausibility(spark):
    rows = [("head_mounted", 4.0)] * 10 + [("wrist_mounted", 0.01)] * 10
    df = spark.createDataFrame(rows, "m string, g double").withColumn("z", F.lit(0.0))
    out = {r["m"]: r["plausible"] for r in qa.mount_plausibility(df, [], "m", ["g", "z"]).collect()}
    assert out == {"head_mounted": False, "wrist_mounted": False}


# ---------------------------------------------------------------- fusion
def test_trust_beats_confidence_and_an_inverted_rank_would_not(spark):
    rows = [(0, "vision_primary", 0.99, 0), (0, "measured_human", 0.1, 1), (0, "approximated", 1.0, 2), (1, "vision_primary", 0.5, 1), (1, "vision_primary", 0.5, 0)]
    df = spark.createDataFrame(rows, "k int, provenance string, confidence double, ordinal int")
    out = {r["k"]: r for r in fusion.arbitrate(df, ["k"]).collect()}
    assert out[0]["provenance"] == "measured_human" and out[1]["ordinal"] == 0
    wrong = fusion.arbitrate(df, ["k"], trust=-schema.trust_rank("provenance")).filter("k = 0").first()
    assert wrong["provenance"] != "measured_human"


def test_states(spark):
    rows = [(i, 0.5 if 10 <= i < 20 else 0.1, 0.1, True, True, 10.0 * (i >= 30) * (i - 29), 0.0) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, left_signal double, right_signal double, left_near boolean, right_near boolean, wrist_x double, wrist_y double").withColumn("k", F.lit(0))
    out = [r["state"] for r in fusion.interaction_states(df, ["k"], ["i"]).orderBy("i").collect()]
    assert out == ["STATIC"] * 10 + ["GRASPED_L"] * 10 + ["STATIC"] * 10 + ["MOVING"] * 10


def test_tracks_are_matched_once(spark):
    rows = [("s", 0, 0, "a", [0.0, 0.0, 1.0, 1.0]), ("s", 0, 1, "a", [2.0, 2.0, 3.0, 3.0]), ("s", 1, 0, "a", [0.1, 0.0, 1.1, 1.0]), ("s", 1, 1, "a", [0.1, 0.0, 1.1, 1.0]), ("s", 1, 2, "b", [2.0, 2.0, 3.0, 3.0])]
    out = fusion.assign_tracks(spark.createDataFrame(rows, "session_id string, frame_idx int, det int, class_label string, bbox array<double>"), ["session_id"], "frame_idx").orderBy("frame_idx", "det").collect()
    assert [r["track_id"] for r in out] == [0, 1, 0, 2, 3]


def test_contact_arbitration(spark):
    points = [[0.0, 0.1 * (j % 4), 0.0] for j in range(21)]
    df = spark.createDataFrame([(0, points, True, {"index": 0.9}, "measured_human")], "k int, p array<array<double>>, near boolean, hw map<string,double>, prov string")
    out = {r["finger"]: r for r in fusion.fuse_contact(df, ["k"], "p", "near", "hw", "prov").collect()}
    assert out["index"]["value"] == 0.9 and out["index"]["provenance"] == "measured_human"
    assert out["pinky"]["value"] <= 0.4 and len(out) == 5


def test_actions_of_a_still_hand_are_idle(spark):
    rows = [("e", "left", i, i / 30, [0.0, 0.0, 0.5], True, False, []) for i in range(30)]
    rows += [("f", "left", i, i / 30, [0.1 * (i >= 15) * (i - 14), 0.0, 0.5], True, 10 <= i, []) for i in range(30)]
    df = spark.createDataFrame(rows, "episode_id string, side string, frame_idx int, t double, wrist array<double>, has_hand boolean, grasped boolean, object_points array<array<double>>")
    out = actions.label_actions(df, ["episode_id"], "side").orderBy("episode_id", "interval").collect()
    assert [r["action_label"] for r in out if r["episode_id"] == "e"] == ["idle"]
    assert {"hold", "transport"} <= {r["action_label"] for r in out if r["episode_id"] == "f"}


# ---------------------------------------------------------------- primitives
def test_peak_must_drop(spark):
    arrays = [([1.0, 2.0, 1.0],), ([1.0, 1.0, 2.0],), ([1.0, 1.0],), ([2.0, 2.0, 2.0],), ([],)]
    df = spark.createDataFrame(arrays, "a array<double>").withColumn("i", F.monotonically_increasing_id())
    out = df.orderBy("i").select(prim.peak_then_drop(F.col("a"), 1.2).alias("p")).collect()
    assert [bool(r["p"]) for r in out] == [True, False, False, False, False]


def test_thresholds_by_worker_then_glove(spark):
    s = spark.createDataFrame([("a", "thick", None), ("b", None, None), ("c", "thin", "w"), ("d", "odd", None)], "session_id string, glove_type string, worker_id string")
    p = spark.createDataFrame([("w", 0.3, 0.2)], "worker_id string, power_grasp_dist double, lateral_pinch_dist double")
    out = {r["session_id"]: (r["power_grasp_dist"], r["threshold_source"]) for r in prim.grasp_thresholds(s, p).collect()}
    assert out == {"a": (0.2025, "glove"), "b": (0.15, "default"), "c": (0.3, "worker"), "d": (0.15, "glove")}


# ---------------------------------------------------------------- governance
def test_inner_joins_hide_what_has_no_record(spark):
    eps = spark.createDataFrame([(i, f"c{i}", "t") for i in range(4)], "id int, capture_id string, task_id string")
    caps = spark.createDataFrame([(f"c{i}",) for i in range(4)], "id string")
    con = spark.createDataFrame([("c0", "granted"), ("c1", "pending"), ("c2", "granted")], "capture_id string, status string")
    cert = spark.createDataFrame([(0, "passed", 3), (1, "passed", 3), (3, "passed", 5)], "episode_id int, pii_status string, quality int")
    assert [r["id"] for r in consent.deliverable(eps, caps, con, cert).collect()] == [0]
    assert consent.deliverable(eps, caps, con, cert, min_quality=4).count() == 0
    leaky = eps.join(con, "capture_id", "left").filter("status is null or status = 'granted'")
    assert leaky.count() > 1


def test_least_permissive_wins(spark):
    rows = [("a", "granted", "1"), ("a", "pending", "2"), ("b", "granted", "3")]
    df = spark.createDataFrame(rows, "capture_id string, status string, source string")
    out = {r["capture_id"]: r for r in consent.reconcile(df, "capture_id", "status").collect()}
    assert out["a"]["status"] == "pending" and out["a"]["conflicted"] and not out["b"]["conflicted"]
    log = sorted((r["capture_id"], r["event_type"]) for r in consent.event_log(df, "capture_id", "status", "source").collect())
    assert log == [("a", "duplicate_conflict")] * 2 + [("a", "reconciled"), ("b", "recorded")]


def test_a_refusal_sticks(spark):
    rows = [("a", i, s) for i, s in enumerate(("pending", "granted", "revoked", "pending", "granted", "denied"))]
    out = consent.sticky(spark.createDataFrame(rows, "c string, i int, s string"), "c", ["i"], "s").orderBy("i").collect()
    assert [r["effective"] for r in out] == ["pending", "granted", "revoked", "revoked", "revoked", "denied"]
    assert [bool(r["refused"]) for r in out] == [False, False, False, True, True, False]


def test_absence_blocks(spark):
    rows = [(None, "passed"), ("granted", None), ("granted", "passed"), ("revoked", "passed"), ("granted", "failed")]
    out = spark.createDataFrame(rows, "c string, p string").select(consent.block_reason(F.col("c"), F.col("p")).alias("r")).collect()
    assert [r["r"] for r in out] == ["no consent record", "no pii record", None, "consent is revoked", "pii is failed"]


def test_greedy_duplicates_follow_the_loop(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(60) for _ in range(8)]
    items = [b ^ sum(1 << rng.randrange(60) for _ in range(rng.randrange(7))) for b in base * 6]
    rng.shuffle(items)
    kept, want = [], {}
    for i, h in enumerate(items):
        best = None
        for j in kept:
            sim = 1 - bin(h ^ items[j]).count("1") / 64
            if sim >= 0.9 and (best is None or sim > best[0]):
                best = (sim, j)
        want[i] = best[1] if best else None
        if best is None:
            kept.append(i)
    df = spark.createDataFrame([(0, i, h) for i, h in enumerate(items)], "k int, i int, h bigint")
    out = dataset_qc.greedy_duplicates(df, ["k"], "i", "i", "h").collect()
    assert {r["i"]: r["duplicate_of"] for r in out} == want


def loop(rows, bits, least):
    """The reference's loop over (item, hash) in order: item, kept item or None, similarity or None."""
    kept, out = [], []
    for i, h in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        match, best = None, 0.0
        for j, x in kept if h is not None else ():
            sim = 1 - bin((h ^ x) & ((1 << 64) - 1)).count("1") / bits
            if sim >= least and sim > best:
                match, best = (j,), sim
        if match is None and h is not None:
            kept.append((i, h))
        out.append((i, match[0] if match else None, best if match else None))
    return out


def test_greedy_duplicates_of_all_follow_the_loop(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(40)]
    hashes = [b ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(8))}) for b in base * 8]
    rng.shuffle(hashes)
    hashes = [h - (1 << 64) if h >> 63 else h for h in hashes + hashes[:30]]
    rows = [(i, h) for i, h in enumerate(hashes)] + [(900, hashes[0]), (901, None), (902, 77), (902, 77), (902, 78), (903, None), (None, hashes[5])]
    df = spark.createDataFrame(rows, "i int, h bigint")
    for block in (7, 65536):
        out = dataset_qc.greedy_duplicates_of_all(df, "i", "h", block=block)
        assert out.schema["duplicate_of"].dataType == df.schema["i"].dataType
        assert sorted(((r["i"], r["duplicate_of"], r["similarity"]) for r in out.collect()), key=str) == sorted(loop(rows, 64, 0.9), key=str)
    assert dataset_qc.greedy_duplicates_of_all(df.limit(0), "i", "h").count() == 0


def test_dedup_greedy_compares_the_whole_table(spark, sf_dir):
    from motolake.plans import bindings

    rows = [(r["vec_id"], r["h"]) for r in bindings.signs(spark, sf_dir).collect()]
    out = bindings.dedup_greedy(spark, sf_dir).collect()
    assert sorted((r["vec_id"], r["duplicate_of"], r["similarity"]) for r in out) == sorted(loop(rows, 32, 0.8))
    label = {r["vec_id"]: r["label"] for r in out}
    assert any(r["duplicate_of"] is not None and label[r["duplicate_of"]] != r["label"] for r in out)


def test_split_shares(spark):
    df = spark.createDataFrame([(i, "a" if i < 100 else None) for i in range(107)], "e int, t string")
    out = dataset_qc.stratified_split(df, "e", "t").groupBy("t", "split").count().collect()
    assert {(r["t"], r["split"]): r["count"] for r in out} == {("a", "train"): 80, ("a", "val"): 10, ("a", "test"): 10, (None, "train"): 6, (None, "test"): 1}


def test_nearest_vector_excludes_itself(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>")
    out = {r["i"]: r["nearest"] for r in dataset_qc.nearest_vectors(df, "i", "v", parts=3, block=7).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    like = u @ u.T
    np.fill_diagonal(like, -2)
    assert [out[i] for i in range(50)] == like.argmax(1).tolist()


def test_batch_report(spark):
    t = spark.createDataFrame([(i, "ab"[i % 3 == 0]) for i in range(9)], "e int, L1_task string")
    d = spark.createDataFrame([(0, None), (1, 0)], "i int, duplicate_of int")
    out = dataset_qc.batch_report(t, d, dataset_qc.stratified_split(t, "e", "L1_task"), "L1_task").first()
    assert out["episodes"] == 9 and out["ratio"] == 2.0 and out["duplicates"] == 1 and sum(out["splits"].values()) == 9


def test_privacy(spark):
    df = spark.createDataFrame([("r", i, i in (3, 10)) for i in range(20)], "r string, i int, seen boolean")
    out = privacy.active_regions(df, ["r"], "i", "seen", Settings(ocr_grace=4, ocr_interval=5)).orderBy("i").collect()
    assert [r["i"] for r in out if r["active"]] == [*range(3, 8), *range(10, 15)]
    with pytest.raises(ValueError, match="expire"):
        Settings(ocr_grace=4)
    with pytest.raises(ValueError, match="consent"):
        Settings(allow_unconsented_delivery=True)


# ---------------------------------------------------------------- packaging, statistics
def test_round_trip_inside_the_percentiles(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(0, v.tolist()) for v in rng.normal(size=(200, 3))], "k int, v array<double>")
    out = stats.field_stats(df, ["k"], "v")
    assert out.count() == 3 and out.first()["p01"] < out.first()["p50"] < out.first()["p99"]
    rows = df.select("k", F.posexplode("v").alias("dim", "x")).join(out, ["k", "dim"])
    assert stats.round_trip_errors(rows, "x", "p01", "p99", 1e-9).count() == 0
    broken = rows.withColumn("p99", F.col("p01"))
    assert stats.round_trip_errors(broken.withColumn("p99", F.lit(float("nan"))), "x", "p01", "p99", 1e-9).count() > 0


def test_weighted_median_is_the_lower(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, 1.0), (0, 3.0, 2.0), (1, 5.0, 0.0)], "k int, v double, w double")
    assert [(r["k"], r["m"]) for r in stats.weighted_median(df, ["k"], "v", "w", "m").collect()] == [(0, 2.0)]


def test_steps_and_robot_actions(spark):
    df = spark.createDataFrame([("e", i, i != 1) for i in range(4)], "episode_id string, frame_idx int, kept boolean")
    out = package.steps(df, ["episode_id"], "frame_idx").orderBy("frame_idx").collect()
    assert [r["is_first"] for r in out] == [True, False, False, False] and out[-1]["is_terminal"]
    for n, want in ((4, [[0.0], [2.0], [3.0]]), (3, [[0.0], [1.0], [2.0]])):
        traj = spark.createDataFrame([("e", [[float(i)] for i in range(n)])], "episode_id string, trajectory array<array<double>>")
        got = package.aligned_robot_actions(df, traj, "episode_id", "frame_idx").orderBy("frame_idx").collect()
        assert [r["robot_action"] for r in got] == want
    with pytest.raises(Exception, match="fits neither"):
        package.aligned_robot_actions(df, spark.createDataFrame([("e", [[0.0]])], "episode_id string, trajectory array<array<double>>"), "episode_id", "frame_idx").collect()


def test_tiers(spark):
    df = spark.createDataFrame([("a", None), ("b", "stage2_anchor")], "e string, tier string")
    assert [r["e"] for r in package.tier_filter(df, "stage1").collect()] == ["a"]
    assert package.tier_filter(df, "all").count() == 2
    with pytest.raises(ValueError):
        package.tier_filter(df, "stage9")


def test_retarget_measures(spark):
    df = spark.createDataFrame([("e", 0, [0.0, 0.0]), ("e", 1, [0.1, 0.5]), ("e", 5, [0.2, 1.5])], "e string, f int, q array<double>")
    assert retarget.teleports(df, ["e"], "f", "q").first()["teleports"] == 2
    assert retarget.teleports(df, ["e"], "f", "q", per_frame=True).first()["teleports"] == 1
    c = spark.createDataFrame([("e", 0, 1, 0.9, 0.1, 0.5, 0.5, 0.1), ("e", 1, 0, 0.5, 0.1, 0.5, 0.5, 0.1), ("e", 2, 0, 0.5, 0.1, 0.5, 0.5, 0.1)], "e string, candidate int, collisions int, convergence double, smoothness double, manipulability double, margin double, residual double")
    assert retarget.best_candidate(c, ["e"]).first()["candidate"] == 1
    v = spark.createDataFrame([("e", i, x) for i, x in enumerate((0.0, 5.0, 5.0, 0.0))], "e string, i int, x double")
    assert [r["clipped"] for r in retarget.clip_velocity(v, ["e"], "i", "x", 1.0).orderBy("i").collect()] == [0.0, 1.0, 2.0, 1.0]
    m = spark.createDataFrame([(None, None, None, None), (0, 0, 0, 0.9), (1, 0, 0, 0.9)], "limit_frames int, collision_frames int, teleports int, ik_convergence double")
    assert [r["eligible"] for r in retarget.eligible(m).collect()] == [None, True, False]


def test_similarity_fit(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6, 3))
    r = np.linalg.qr(rng.normal(size=(3, 3)))[0]
    r *= np.sign(np.linalg.det(r))
    y = 2.5 * x @ r.T + np.array([1.0, 2.0, 3.0])
    df = spark.createDataFrame([("e", a.tolist(), b.tolist()) for a, b in zip(x, y, strict=True)], "e string, s array<double>, t array<double>")
    out = retarget.similarity_fit(df, ["e"], "s", "t").first()
    assert out["scale"] == pytest.approx(2.5) and np.allclose(out["rotation"], r.ravel()) and np.allclose(out["shift"], [1, 2, 3])


def test_canonical_actions(spark):
    still = {"position_m": [0.0, 0.0, 0.0], "quaternion_wxyz": [1.0, 0.0, 0.0, 0.0]}
    half = {"position_m": [0.0, 0.0, 0.0], "quaternion_wxyz": [math.cos(math.pi / 4), 0.0, math.sin(math.pi / 4), 0.0]}
    wrist = {"position_m": [0.0, 0.0, 1.0], "quaternion_wxyz": [1.0, 0.0, 0.0, 0.0]}
    kind = "struct<position_m:array<double>,quaternion_wxyz:array<double>>"
    df = spark.createDataFrame([("e", 0, wrist, still), ("e", 1, wrist, half), ("f", 0, wrist, None), ("f", 1, wrist, None)], f"e string, i int, w {kind}, c {kind}")
    out = {(r["e"], r["i"]): r for r in canonical.actions(df, ["e"], "i", "w", "c").collect()}
    assert np.allclose(out["e", 0]["action"]["position_m"], [1.0, 0.0, 0.0]) and not out["e", 1]["action_valid"]
    assert out["f", 0]["ego_contaminated"] and out["f", 0]["action"]["position_m"] == [0.0, 0.0, 1.0]


def test_orientation_by_gyro(spark):
    df = spark.createDataFrame([("s", i / 100, 0.0, 0.0, math.pi / 2) for i in range(101)], "s string, t double, x double, y double, z double")
    out = canonical.cumulated_rotation(canonical.relative_rotations(df, ["s"], "t", ["x", "y", "z"]), ["s"], "t", "rotation").first()
    assert np.allclose(out["orientation"], [math.cos(math.pi / 4), 0, 0, math.sin(math.pi / 4)], atol=1e-9)


def test_representative_frames(spark):
    segs = "array<struct<phase:string,start_frame:int,end_frame:int>>"
    rows = [(0, 100, [("grasp", 10, 30), ("release", 60, 80)]), (0, 100, []), (5, 5, []), (0, 100, [("grasp", 10 * k, 10 * k + 8) for k in range(1, 9)])]
    out = [r["f"] for r in spark.createDataFrame(rows, f"s int, e int, g {segs}").withColumn("o", F.monotonically_increasing_id()).orderBy("o").select(language.representative_frames(F.col("s"), F.col("e"), F.col("g")).alias("f")).collect()]
    assert out[0] == [0, 20, 70, 100] and out[1] == [0, 50, 100] and out[2] == [5]
    assert len(out[3]) == 5 and out[3][0] == 0 and out[3][-1] == 100


# ---------------------------------------------------------------- constraints
def test_constraints_return_offenders(spark):
    q = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0]), (1, [1.0, 1.0, 0.0, 0.0]), (2, None), (3, [1.0])], "i int, q array<double>")
    assert [r["i"] for r in schema.bad_quaternions(q, "q").orderBy("i").collect()] == [1, 3]
    m = spark.createDataFrame([("u", None), (None, "r"), (None, None), ("u", "r")], "mask_uri string, mask_rle string")
    assert schema.bad_masks(m).count() == 2
    p = spark.createDataFrame([(0, 1.0, None, {"a": "vision_primary"}), (1, None, 2.0, {"a": "x"}), (2, None, None, None)], "i int, a double, b double, provenance map<string,string>")
    assert [(r["i"], r["missing"]) for r in schema.without_provenance(p, ["a", "b"]).collect()] == [(1, ["b"])]
    f = spark.createDataFrame([({"thumb": 1.0},), (None,), (dict.fromkeys(("thumb", "index", "middle", "ring", "pinky"), 1.0),)], "c map<string,double>")
    assert schema.missing_fingers(f, "c").count() == 1
    assert schema.disordered_spans(spark.createDataFrame([(1, 0), (0, 1)], "s int, e int"), "s", "e").count() == 1
    h = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None)], "c string, h string")
    assert schema.bad_hashes(h, "c", "h").count() == 1
    r = spark.createDataFrame([("glove", "measured_robotspace"), ("glove", "measured_human"), ("glove", "vision_primary")], "rig string, provenance string")
    assert schema.over_ceiling(r, spark.createDataFrame([("glove", "measured_human")], "rig string, ceiling string")).count() == 1
    frames = spark.createDataFrame([("e", "a", i) for i in range(5)] + [("f", "a", 0)], "episode_id string, rig string, frame_idx int")
    assert schema.foreign_frames(frames, spark.createDataFrame([("f", "a")], "episode_id string, rig string")).count() == 3
    assert schema.bad_quality(spark.createDataFrame([(0,), (3,), (None,)], "quality int")).count() == 1
