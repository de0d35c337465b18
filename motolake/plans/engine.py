"""The engine: typed tables in, stages as functions of tables, each stage's table kept where the caller says.

A stage's table is written once under a name made of the stage and a hash of the tables' rows, the sessions
asked for and the settings it was made from, so that running again reads what is there (resume) and changed
input makes new tables. Rows are hashed in one pass over each table; a caller that names the data's ``version``
spares it. Without a store, stages are cached for as long as the session wants.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motolake import schema
from motolake.operators import actions as act
from motolake.operators import canonical as can
from motolake.operators import certify, consent, eis, intervals, language, package, phases, qa, sync, tasks, validate
from motolake.operators import primitives as prim
from motolake.settings import DEFAULT, Settings
from motolake.sinks import store

SESSION = ["session_id"]
EPISODE = ["session_id", "episode_id"]
STAGES = ("sync", "qa", "primitives", "phases", "episodes", "tasks", "validation", "certificates", "language", "labels")


@dataclass
class Engine:
    """tables: imu (session_id, t, ax..gz), frames (session_id, frame_idx, t), pose, objects, sharpness (blur, coverage), sessions (session_id, glove_type, worker_id, imu_mode, consent, pii_status, redacted, retargetable); what a stage lacks it treats as not measured."""

    spark: SparkSession
    tables: dict[str, DataFrame]
    settings: Settings = DEFAULT
    mode: str = "head_mounted"
    store_dir: str | None = None
    version: str | None = None
    sessions: tuple[str, ...] | None = None
    prints: dict[str, str] = field(default_factory=dict)
    done: dict[str, DataFrame] = field(default_factory=dict)
    log: list[tuple[str, str]] = field(default_factory=list)

    # ------------------------------------------------------------ orchestration
    def key(self, stage: str) -> str:
        inputs = {k: [sorted(f.simpleString() for f in t.schema.fields), self.version or self.fingerprint(k)] for k, t in self.tables.items()}
        return hashlib.sha256(json.dumps([stage, self.mode, inputs, self.sessions, asdict(self.settings)], sort_keys=True, default=str).encode()).hexdigest()[:16]

    def fingerprint(self, name: str) -> str:
        """Number of a table's rows and the sum of their hashes, whatever their order."""
        if name not in self.prints:
            table = self.tables[name]
            row = F.xxhash64(*(F.to_json(c) if t.startswith(("map", "struct", "array")) else F.col(c) for c, t in table.dtypes))
            known = F.xxhash64(*(F.col(c).isNull() for c in table.columns))  # hashes skip nulls
            found = table.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("a"), F.sum((row.bitwiseXOR(known)).cast("decimal(38,0)")).alias("b")).first()
            self.prints[name] = f"{found['n']}:{found['a']}:{found['b']}"
        return self.prints[name]

    def stage(self, name: str) -> DataFrame:
        """A stage's table, from this run, from the store, or made now."""
        if name not in STAGES:
            raise ValueError(f"unknown stage {name!r}: one of {', '.join(STAGES)}")
        if name in self.done:
            return self.done[name]
        path = f"{self.store_dir}/{name}-{self.key(name)}" if self.store_dir else None
        if path and self._exists(path):
            self.done[name] = self.spark.read.parquet(path)
            self.log.append((name, "reused"))
            return self.done[name]
        made = getattr(self, f"_{name}")()
        if path:
            made.write.mode("overwrite").parquet(path)
            made = self.spark.read.parquet(path)
        else:
            made = made.persist()
        self.done[name] = made
        self.log.append((name, "made"))
        return made

    def run(self, upto: str = "labels", sessions: list[str] | None = None) -> dict[str, DataFrame]:
        """All stages as far as one, for all sessions or some."""
        if sessions is not None:
            self.tables = {k: t.filter(F.col("session_id").isin(*sessions)) if "session_id" in t.columns else t for k, t in self.tables.items()}
            self.sessions = tuple(sorted(sessions))
            self.done.clear()
            self.prints.clear()
        return {s: self.stage(s) for s in STAGES[: STAGES.index(upto) + 1]}

    def status(self) -> list[tuple[str, str]]:
        return [(s, dict(self.log).get(s, "pending")) for s in STAGES]

    def _exists(self, path: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    # ------------------------------------------------------------ stages
    def _sync(self) -> DataFrame:
        return sync.synchronise(self.tables["frames"], self.tables["imu"], SESSION, "t", ["ax", "ay", "az", "gx", "gy", "gz"], s=self.settings)

    def sync_stats(self) -> DataFrame:
        stats = sync.drift_stats(self.stage("sync"), SESSION, self.settings)
        stream = sync.stream_stats(self.tables["imu"], SESSION, "t")
        span = self.tables["imu"].groupBy(*SESSION).agg((F.max("t") - F.min("t")).alias("duration_s"))
        return stats.join(stream, SESSION, "left").join(span, SESSION, "left")

    def _qa(self) -> DataFrame:
        s = self.settings
        fps = qa.fps_consistency(self.tables["frames"], SESSION, "t", s=s).select(*SESSION, "std_ms", F.col("passed").alias("fps_passed"))
        gate = qa.sync_gate(self.sync_stats(), s=s).select(*SESSION, "gate_ms", "max_drift_clean_ms", F.col("passed").alias("sync_passed"))
        out = fps.join(gate, SESSION, "full")
        for name, least in (("blur", s.blur_min), ("coverage", s.coverage_min)):
            if "sharpness" in self.tables:
                check = qa.sampled_check(self.tables["sharpness"], SESSION, "frame_idx", name, least, s).select(*SESSION, F.col("score").alias(name), F.col("passed").alias(f"{name}_passed"))
                out = out.join(check, SESSION, "left")
            else:
                out = out.withColumn(name, F.lit(None).cast("double")).withColumn(f"{name}_passed", F.lit(None).cast("boolean"))
        zero = out.withColumn("_blur", F.coalesce("blur", F.lit(0.0))).withColumn("_coverage", F.coalesce("coverage", F.lit(0.0)))
        return qa.composite(zero, "_blur", "_coverage", "std_ms", "gate_ms", ["fps_passed", "sync_passed", "blur_passed", "coverage_passed"], s).drop("_blur", "_coverage")

    def _primitives(self) -> DataFrame:
        frames = self.stage("sync").join(self.tables["pose"], [*SESSION, "frame_idx"])
        if "objects" in self.tables:
            frames = frames.join(self.tables["objects"].select(*SESSION, "frame_idx", "objects"), [*SESSION, "frame_idx"], "left")
        else:
            frames = frames.withColumn("objects", F.lit(None).cast("array<struct<class_label:string,confidence:double,centroid_norm:array<double>>>"))
        sessions = self.tables["sessions"].select("session_id", "glove_type", "worker_id")
        limits = prim.grasp_thresholds(sessions, self.tables.get("profiles"), self.settings).select("session_id", "power_grasp_dist", "lateral_pinch_dist")
        return prim.detect(frames.join(limits, SESSION), SESSION, "frame_idx", self.mode, self.settings)

    def _phases(self) -> DataFrame:
        return phases.label(self.stage("primitives"), SESSION, "frame_idx", self.settings)

    def segments(self) -> DataFrame:
        from motolake.operators import windows as win

        return win.segments(self.stage("phases"), SESSION, "frame_idx", "phase", "t", "phase_confidence")

    def _episodes(self) -> DataFrame:
        return phases.episodes(self.segments(), SESSION, "session_id", self.settings)

    def in_episodes(self, frames: DataFrame) -> DataFrame:
        return intervals.contained(frames, self.stage("episodes"), SESSION, "frame_idx", "start_frame", "end_frame", ["episode_id"])

    def _tasks(self) -> DataFrame:
        frames = self.in_episodes(self.stage("primitives").select(*SESSION, "frame_idx", "active_primitives"))
        counts = tasks.primitive_counts(frames, EPISODE)
        objects = None
        if "objects" in self.tables:
            objects = tasks.dominant_object(frames, self.in_episodes(self.tables["objects"].select(*SESSION, "frame_idx", "objects")), EPISODE, "frame_idx")
        found = tasks.classify(counts, EPISODE, objects, self.settings)
        out = self.stage("episodes").select(*EPISODE).join(found, EPISODE, "left")
        return out.fillna("unknown", ["L1_task"]).fillna(0.0, ["confidence"]).fillna(True, ["needs_human_review"])

    def _validation(self) -> DataFrame:
        s, prims = self.settings, self.stage("primitives")
        marked = prims.withColumn("contact", F.col("contact_onset")).withColumn("grasp", F.col("power_grasp") | F.col("lateral_pinch"))
        spikes = validate.spikes_at_contact(marked, SESSION, "frame_idx", "contact", "accel_mag", s)
        pose = self.tables["pose"].select(*SESSION, "frame_idx", F.col("derived.wrist_velocity_magnitude").alias("speed"))
        slowing = validate.slowing_at_boundaries(self.segments(), pose, SESSION, "frame_idx", "speed", s)
        causal = validate.causal_order(marked, SESSION, "frame_idx", "contact", "grasp", 1000 / s.fps_nominal, s)
        by_episode = validate.phase_consistency(self.in_episodes(self.stage("phases").select(*SESSION, "frame_idx", "phase")), EPISODE, "phase", self.stage("tasks"))
        consistent = by_episode.groupBy(*SESSION).agg(F.every("passed").alias("passed"))
        checks = validate.overall([("imu_spike", spikes), ("deceleration", slowing), ("causal", causal), ("task_phase", consistent)], SESSION)
        return checks.join(causal.select(*SESSION, "events", "inversions"), SESSION, "left")

    def _certificates(self) -> DataFrame:
        s, eps = self.settings, self.stage("episodes")
        seen = self.in_episodes(self.tables["pose"].select(*SESSION, "frame_idx", "hands_detected")).groupBy(*EPISODE).agg(F.avg(F.coalesce("hands_detected", F.lit(False)).cast("double")).alias("hand_presence_rate"))
        segs = self.segments().select(*SESSION, F.col("start_frame").alias("seg_start"), F.col("end_frame").alias("seg_end"), "mean_confidence")
        inside = intervals.overlapping(eps.select(*EPISODE, "start_frame", "end_frame"), segs, SESSION, "start_frame", "end_frame", "seg_start", "seg_end").select(*EPISODE, F.col("seg_start").alias("start_frame"), F.col("seg_end").alias("end_frame"), "mean_confidence")
        labelled = eis.label_confidence(self.stage("tasks"), inside, EPISODE, "confidence")
        out = labelled.join(seen, EPISODE, "left").join(self.stage("qa").select(*SESSION, F.col("max_drift_clean_ms").alias("max_drift_ms"), F.col("blur").alias("blur_score"), F.col("overall_passed").alias("qa_passed")), SESSION, "left")
        checks = self.stage("validation").select(*SESSION, F.col("causal").alias("causal_passed"), "inversions", "events", F.col("overall_valid").alias("validation_passed"))
        sessions = self.tables["sessions"]
        able = sessions.select(*SESSION, F.coalesce("retargetable", F.lit(False)).alias("retargetable")) if "retargetable" in sessions.columns else sessions.select(*SESSION, F.lit(False).alias("retargetable"))
        return eis.certificates(out.join(checks, SESSION, "left").join(able, SESSION, "left"), EPISODE, s)

    def _language(self) -> DataFrame:
        frames = self.in_episodes(self.stage("primitives").select(*SESSION, "frame_idx", "active_primitives").join(self.tables["pose"].select(*SESSION, "frame_idx", "dominant_hand"), [*SESSION, "frame_idx"]))
        eps = self.stage("episodes").join(self.stage("tasks").select(*EPISODE, "L1_task", "confidence"), EPISODE).join(self.stage("validation").select(*SESSION, "overall_valid"), SESSION, "left")
        return language.ground(language.facts(frames, eps, EPISODE, "frame_idx"))

    def _labels(self) -> DataFrame:
        return package.nested_labels(self.stage("episodes"), self.stage("tasks"), self.segments(), self.stage("primitives"), self.stage("certificates"), SESSION, "frame_idx")

    # ------------------------------------------------------------ products
    def deliverable(self) -> DataFrame:
        """Episodes with the reason that blocks them, null if none does."""
        gates = self.tables["sessions"].select(*SESSION, "consent", "pii_status")
        out = self.stage("certificates").join(gates, SESSION, "left").withColumn("quality", F.greatest(F.lit(1), F.bround(F.col("eis") / 20).cast("int")))
        return out.withColumn("reason", consent.block_reason(F.col("consent"), F.col("pii_status"), F.col("quality"), self.settings))

    def manifest(self) -> DataFrame:
        eps = self.stage("episodes").join(self.stage("tasks"), EPISODE).join(self.stage("certificates").select(*EPISODE, "eis"), EPISODE)
        return package.batch_manifest(eps, self.tables["sessions"])

    def deliver(self, rows: DataFrame, path: str, ledger: str, customer: str, name: str) -> int:
        eps = self.deliverable().select("episode_id", "consent", "pii_status", "quality")
        return store.deliver(rows, eps, path, ledger, customer, name, self.settings)

    def canonical(self, pose_3d: DataFrame, depth: DataFrame) -> DataFrame:
        prims = self.stage("primitives").select(*SESSION, "frame_idx", "t", "power_grasp", "lateral_pinch", "c_power_grasp", "c_lateral_pinch", "c_transport", "c_idle")
        pose = self.tables["pose"].select(*SESSION, "frame_idx", "dominant_hand", "derived")
        frames = can.build(pose_3d, pose, depth, prims, [*SESSION, "frame_idx"])
        grasping = F.coalesce(F.col("power_grasp") | F.col("lateral_pinch"), F.lit(False))
        state = can.interaction(grasping, F.col("dominant_hand"), F.greatest("c_power_grasp", "c_lateral_pinch"), F.col("derived.wrist_velocity_magnitude"), F.col("c_transport"), F.col("c_idle"))
        return frames.withColumn("wrist_pose", can.wrist_pose(F.col("points_3d"))).withColumn("interaction", state)

    def label_actions(self, hands: DataFrame) -> DataFrame:
        """Action intervals; hands: episode_id, side, frame_idx, t, wrist, has_hand, grasped, object_points."""
        return act.label_actions(hands, ["episode_id"], "side", self.settings)

    def certify(self, frames: DataFrame, drift: DataFrame, measured: bool = False, *, rigs: DataFrame | None = None, grasped: str = "grasped", simulated: DataFrame | None = None, earlier: DataFrame | None = None) -> DataFrame:
        """Certificates of canonical episodes. drift: episode_id, drift_ms, fps.

        rigs: rig, channel, for the agreement of frames' contact with the boolean column grasped. simulated, a row an episode:
        episode_id, embodiment, ik_convergence_rate, reasons. earlier: episode_id, mistakes of the episode's metadata. What
        isn't given isn't measured. mistakes: windows of low confidence, then earlier ones, then the simulation's reasons.
        """
        key = ["episode_id"]
        parts = [
            certify.perception_confidence(frames, key, "confidence"),
            certify.calibration_completeness(frames, key, "camera_pose", measured),
            drift.select("episode_id", certify.sync_integrity(F.col("drift_ms"), F.col("fps")).alias("sync_integrity")),
            certify.speed(frames, key, "t", self.settings),
            certify.mistake_flags(frames, key, "t", "confidence", self.settings),
        ]
        if rigs is not None:
            parts.append(certify.contact_consistency(frames, key, "contact", grasped, "rig", rigs))
        none = F.array().cast("array<string>")
        more, last = none, none
        if simulated is not None:
            reasons = F.transform("reasons", lambda r: F.concat(F.lit("sim_validate["), F.col("embodiment"), F.lit("]: "), r))
            parts.append(simulated.select("episode_id", F.col("ik_convergence_rate").cast("double").alias("ik_convergence_rate"), reasons.alias("_reasons")))
            last = F.coalesce("_reasons", none)
        if earlier is not None:
            parts.append(earlier.select("episode_id", F.col("mistakes").alias("_earlier")))
            more = F.coalesce("_earlier", none)
        out = certify.certificates(parts, key, self.settings)
        return out.withColumn("mistakes", F.concat(F.array_distinct(F.concat(F.coalesce("flags", none), more)), last)).drop("flags", "_earlier", "_reasons")

    def export(self, kind: str, frames: DataFrame, episodes: DataFrame, tier: str = "all") -> DataFrame:
        """Rows of a training dataset: 'table' or 'steps'."""
        rows = package.training_table(frames, episodes, tier)
        if kind == "table":
            return rows
        if kind == "steps":
            return package.step_episodes(rows, ["episode_id", "task"], "frame_index", ["state", "action"])
        raise ValueError(f"unknown export {kind!r}")

    def migrate_plan(self, sessions: DataFrame) -> DataFrame:
        return consent.migration_plan(sessions)

    def report(self, certificates: DataFrame | None = None) -> str:
        table = certificates if certificates is not None else self.stage("certificates")
        counts = table.agg(F.count(F.lit(1)).alias("episodes"), F.round(F.avg("eis"), 1).alias("mean_eis"), F.count_if(F.size("recommended_use") == 0).alias("quarantined")).first().asDict()
        by_task = self.stage("tasks").groupBy("L1_task").count().collect()
        return package.data_card(counts, [(r["L1_task"], r["count"]) for r in by_task], "Batch")

    @staticmethod
    def schema_snapshot() -> str:
        return schema.frozen(schema.CANONICAL_FRAME)
