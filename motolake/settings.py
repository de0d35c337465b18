"""Every threshold, vocabulary and registry of the engine, in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass, field

# Closed vocabularies and constants that results depend on.
PRIMITIVES = ("wrist_pronate", "wrist_supinate", "wrist_flex", "reach_onset", "power_grasp", "lateral_pinch", "contact_onset", "contact_release", "finger_curl", "finger_extend", "idle", "transport")
PHASES = ("reach", "grasp", "active_manipulation", "release", "reposition", "idle")
TASKS = ("bolt_tightening", "material_transfer", "box_seal", "label_apply", "inspection_visual", "pick_and_place", "tool_change", "idle", "assembly_insert", "packaging_fold")
TASK_SIGNATURES = {
    "bolt_tightening": {"wrist_pronate": 50, "power_grasp": 30, "contact_onset": 3},
    "material_transfer": {"transport": 80, "power_grasp": 20, "reach_onset": 15},
    "box_seal": {"transport": 30, "finger_extend": 40, "contact_onset": 3},
    "label_apply": {"lateral_pinch": 30, "transport": 20, "finger_extend": 15},
    "inspection_visual": {"idle": 100, "reach_onset": 10, "finger_extend": 10},
    "pick_and_place": {"reach_onset": 20, "power_grasp": 20, "transport": 30},
    "tool_change": {"power_grasp": 20, "contact_release": 5, "contact_onset": 5},
    "assembly_insert": {"wrist_flex": 30, "power_grasp": 20, "contact_onset": 5},
    "packaging_fold": {"finger_curl": 50, "finger_extend": 30, "transport": 10},
}
TASK_OBJECTS = {
    "bolt_tightening": ("bolt",),
    "material_transfer": ("box", "package", "bin", "component"),
    "box_seal": ("box",),
    "label_apply": ("label", "box"),
    "inspection_visual": ("component", "tool"),
    "pick_and_place": ("component", "bin"),
    "tool_change": ("tool",),
    "assembly_insert": ("component",),
    "packaging_fold": ("box", "package"),
}
TASK_PHASES = {
    "bolt_tightening": {"active_manipulation": 0.30},
    "material_transfer": {"reposition": 0.20},
    "box_seal": {"active_manipulation": 0.20},
    "label_apply": {"active_manipulation": 0.15},
    "inspection_visual": {"idle": 0.30},
    "pick_and_place": {"reach": 0.10, "grasp": 0.10},
    "tool_change": {"release": 0.05},
    "assembly_insert": {"active_manipulation": 0.25},
    "packaging_fold": {"active_manipulation": 0.20},
    "idle": {"idle": 0.50},
}
PROVENANCE = ("measured_robotspace", "measured_human", "gripper_aperture", "vision_primary", "vision_fallback", "approximated")
CONSENT = ("denied", "revoked", "pending", "granted")
PII = ("passed", "pending", "failed")
TIERS = ("stage1_volume", "stage2_anchor")
FINGERS = ("thumb", "index", "middle", "ring", "pinky")
SIDES = ("left", "right")
VERBS = ("idle", "hold", "grasp", "release", "lift", "place", "lower", "transport", "reach")
STATES = ("STATIC", "GRASPED_L", "GRASPED_R", "GRASPED_BOTH", "MOVING")
FINGER_JOINTS = {"index": (5, 6, 7), "middle": (9, 10, 11), "ring": (13, 14, 15), "pinky": (17, 18, 19), "thumb": (1, 2, 3)}
FINGERTIPS = (4, 8, 12, 16, 20)
PERCENTILES = (0.01, 0.02, 0.05, 0.25, 0.5, 0.75, 0.95, 0.98, 0.99)
PHASE_PRIMITIVES = {
    "active_manipulation": ("wrist_pronate", "wrist_supinate", "wrist_flex", "power_grasp", "lateral_pinch"),
    "release": ("contact_release",),
    "grasp": ("power_grasp", "lateral_pinch"),
    "reach": ("reach_onset",),
    "reposition": ("transport",),
    "idle": ("idle",),
}


# The thresholds' defaults, on which results depend.
@dataclass(frozen=True)
class Settings:
    # clocks
    epoch_floor_ms: float = 946_684_800_000.0
    uptime_ceiling_ms: float = 1e10
    drift_limit_ms: float = 2.0
    dropout_factor: float = 3.0
    missing_limit: float = 0.05
    dropout_frame_ms: float = 10.0
    near_sample: float = 0.25
    fps_nominal: float = 30.0
    # quality assurance
    blur_min: float = 80.0
    coverage_min: float = 0.5
    fps_std_ms: float = 5.0
    fps_rtol: float = 0.05
    qa_stride: int = 30
    qa_weights: tuple[float, float, float, float] = (0.30, 0.20, 0.20, 0.30)
    # primitives
    pronate_deg_s: float = 15.0
    supinate_deg_s: float = -15.0
    flex_deg_s: float = 10.0
    contact_g: float = 1.2
    release_g: float = 1.0
    reach_speed: float = 0.3
    grasp_dist: float = 0.15
    pinch_dist: float = 0.08
    contact_dist: float = 0.06
    min_frames: int = 3
    contact_min_frames: int = 1
    idle_accel: float = 0.15
    idle_speed: float = 0.05
    head_idle_accel: float = 0.15
    head_idle_gyro: float = 5.0
    vision_weight: float = 0.7
    imu_weight: float = 0.3
    vote_margin: float = 0.3
    snap_deg_s: float = 150.0
    snap_fraction: float = 0.02
    still_peak_deg_s: float = 20.0
    still_spike_fraction: float = 0.001
    snr_reference: float = 3.0
    snr_floor: float = 0.5
    glove_factors: dict[str, float] = field(default_factory=lambda: {"none": 1.0, "thin": 1.15, "thick": 1.35})
    # phases, episodes, tasks
    gap_fill: int = 5
    phase_min: int = 10
    episode_gap_s: float = 8.0
    episode_min_s: float = 2.0
    object_bonus: float = 0.15
    tie_margin: float = 0.05
    task_accept: float = 0.5
    # validation
    spike_rate: float = 0.7
    decel_rate: float = 0.6
    inversion_rate: float = 0.3
    causal_ms: tuple[float, float] = (-50.0, 200.0)
    # scores
    eis_weights: tuple[float, float, float, float, float] = (0.30, 0.20, 0.20, 0.15, 0.15)
    eis_tiers: tuple[int, int] = (85, 70)
    certificate_weights: dict[str, float] = field(default_factory=lambda: {"sync_integrity": 0.15, "calibration_completeness": 0.30, "perception_confidence": 0.35, "contact_consistency": 0.05, "ik_convergence_rate": 0.15})
    speed_fast_s: float = 15.0
    speed_slow_s: float = 60.0
    mistake_floor: float = 0.4
    mistake_window_s: float = 1.0
    # states and actions
    grasp_high: float = 0.35
    grasp_low: float = 0.22
    motion_px: float = 6.0
    dwell: int = 3
    near_iou: float = 0.05
    vision_contact_cap: float = 0.40
    still_mps: float = 0.04
    vertical_fraction: float = 0.55
    near_object_m: float = 0.12
    review_confidence: float = 0.5
    # governance
    duplicate_similarity: float = 0.90
    hash_bits: int = 64
    split: tuple[tuple[str, float], ...] = (("train", 0.8), ("val", 0.1), ("test", 0.1))
    retention_days: int = 180
    quality_floor: int = 2
    ocr_min: float = 0.3
    ocr_blur: float = 0.7
    ocr_interval: int = 30
    ocr_grace: int = 40
    allow_unconsented_delivery: bool = False

    def __post_init__(self) -> None:
        if self.allow_unconsented_delivery:
            raise ValueError("delivery without consent can't be switched on")
        if self.ocr_grace < self.ocr_interval - 1:
            raise ValueError("text regions would expire before they are looked for again")
        if abs(sum(r for _, r in self.split) - 1) > 1e-9:
            raise ValueError("split ratios must sum to 1")


DEFAULT = Settings()
