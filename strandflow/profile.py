"""Settings of a corpus: joints, limits, thresholds, metric anchors. One frozen object with defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Anchor:
    """How a metric turns into a penalty: weight, the values of penalty 0 and 1, and the value that flags it."""

    weight: float
    good: float
    bad: float
    flag_at: float


# Weight, value of no penalty, value of full penalty, value of the flag.
ANCHORS = {
    "dropped_frame_rate": Anchor(2, 0, 0.1, 0.05),
    "timing_jitter": Anchor(1, 0.05, 0.4, 0.3),
    "nan_fraction": Anchor(2, 0, 0.05, 0.01),
    "idle_fraction": Anchor(1.5, 0.1, 0.6, 0.5),
    "action_saturation": Anchor(1.5, 0.02, 0.3, 0.2),
    "jerk_spike_rate": Anchor(1, 0, 0.05, 0.03),
    "gripper_chatter_hz": Anchor(1, 0.05, 1, 0.6),
    "tracking_error": Anchor(2, 0.002, 0.03, 0.02),
    "duration_zabs": Anchor(0.5, 0.5, 3, 2.5),
}
METRICS = tuple(ANCHORS)


@dataclass(frozen=True)
class Profile:
    """Defaults are those of a 7-joint arm recorded at 20 Hz (fixed values)."""

    n_joints: int = 7
    dt_us: int = 50_000
    max_gap_us: int = 250_000
    lower: tuple[float, ...] = (-2.8973, -1.7628, -2.8973, -3.0718, -2.8973, -0.0175, -2.8973)
    upper: tuple[float, ...] = (2.8973, 1.7628, 2.8973, -0.0698, 2.8973, 3.7525, 2.8973)
    limit_tolerance: float = 0.1
    action_limit: float = 0.08
    min_steps: int = 20
    max_steps: int = 6000
    max_nan_fraction: float = 0.02
    max_mean_dt_error: float = 0.35
    idle_speed_eps: float = 0.02
    jerk_spike_k: float = 12.0
    anchors: dict[str, Anchor] = field(default_factory=lambda: dict(ANCHORS))
    gold: float = 85.0
    silver: float = 65.0
    hard_max_nan: float = 0.10
    hard_max_dropped: float = 0.25
    hard_min_steps: int = 20
    min_tier: str = "silver"
    require_success: bool = True
    val_fraction: float = 0.2
    seed: int = 17
    horizon: int = 8
    bootstrap_samples: int = 1000
    rollout_horizons: tuple[int, ...] = (1, 8, 32)

    def joints(self, kind: str = "q") -> list[str]:
        return [f"{kind}_{i}" for i in range(self.n_joints)]

    def channels(self) -> list[str]:
        """Canonical channels in order, without time."""
        ee = ["ee_x", "ee_y", "ee_z", "ee_qx", "ee_qy", "ee_qz", "ee_qw"]
        return [*self.joints("q"), *self.joints("dq"), *ee, "grip", *self.joints("act_q"), "act_grip"]
