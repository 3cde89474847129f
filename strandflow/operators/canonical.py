"""From messy headers to the canonical schema: names, order, derived velocity and command."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strandflow.profile import Profile

KEYS = ("session_id", "episode_id")
# Header names in use and their canonical names.
ALIASES = {
    "time": "t", "timestamp": "t", "stamp": "t", "secs": "t",
    "gripper": "grip", "gripper_width": "grip", "gripper_pos": "grip",
    "cmd_gripper": "act_grip", "gripper_cmd": "act_grip", "action_gripper": "act_grip",
    "ee_pos_x": "ee_x", "ee_pos_y": "ee_y", "ee_pos_z": "ee_z",
    "ee_rot_x": "ee_qx", "ee_rot_y": "ee_qy", "ee_rot_z": "ee_qz", "ee_rot_w": "ee_qw",
}
PREFIXES = {"q": ("joint", "jpos", "pos"), "dq": ("vel", "jvel", "qd", "dq"), "act_q": ("cmd", "action", "act", "target")}


def canonical_name(header: str) -> str:
    """Canonical name of one header; an unknown one is only lower-cased and trimmed. joint_01 is joint 1, as joint_1."""
    name = header.strip().lower()
    if name in ALIASES:
        return ALIASES[name]
    if m := re.fullmatch(r"([a-z]+)_?(\d+)", name):
        for kind, prefixes in PREFIXES.items():
            if m[1] in prefixes:
                return f"{kind}_{int(m[2])}"
    return name


def canonicalise(df: DataFrame) -> DataFrame:
    """Rename every column; two headers of one canonical name are an error."""
    names = [canonical_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several columns are {', '.join(twice)}")
    return df.select([F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names, strict=True)])


def merge_headers(df: DataFrame) -> DataFrame:
    """`canonicalise` for a table of files with different headers: columns of one canonical name become one.

    A row with values under two of them fails the job, as a file with both headers would.
    """
    groups: dict[str, list[Column]] = {}
    for c in df.columns:
        groups.setdefault(canonical_name(c), []).append(F.col(f"`{c}`"))

    def one(name: str, columns: list[Column]) -> Column:
        if len(columns) == 1:
            return columns[0]
        held = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
        return F.when(held > 1, F.raise_error(F.lit(f"several columns are {name}"))).otherwise(F.coalesce(*columns))

    return df.select([one(n, c).alias(n) for n, c in groups.items()])


def known(c: Column) -> Column:
    """NaN and infinities are missing, once and for all at the boundary."""
    c = c.cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def episode_window(*order: str):
    return W.partitionBy(*KEYS).orderBy(*(order or ("t_us",)))


def derive_velocity(df: DataFrame, profile: Profile) -> DataFrame:
    """dq as the gradient of q over the gradient of time: central inside, one-sided at the ends, null where time stands still."""
    w = episode_window("t_us", "step")
    first, last = (f(F.lit(1)).over(w).isNull() for f in (F.lag, F.lead))

    def slope(c: str) -> Column:
        x = F.col(c)
        ahead, back = F.lead(x).over(w), F.lag(x).over(w)
        return F.when(first, ahead - x).when(last, x - back).otherwise((ahead - back) / 2)

    dt = slope("t_us") / 1e6
    return df.withColumns({f"dq_{i}": F.try_divide(slope(f"q_{i}"), F.nullif(dt, F.lit(0.0))) for i in range(profile.n_joints)})


def derive_action(df: DataFrame, profile: Profile) -> DataFrame:
    """act_q as the forward difference of q; 0 in the last row."""
    w = episode_window("t_us", "step")
    last = F.lead(F.lit(1)).over(w).isNull()
    return df.withColumns(
        {f"act_q_{i}": F.when(last, 0.0).otherwise(F.lead(f"q_{i}").over(w) - F.col(f"q_{i}")) for i in range(profile.n_joints)}
    )


def derive_absent(df: DataFrame, profile: Profile) -> DataFrame:
    """Velocities and commands of a table of episodes with different channels: all are derived in an episode where one of them has no value."""
    for kind, derive in (("dq", derive_velocity), ("act_q", derive_action)):
        names = profile.joints(kind)
        given = [c for c in names if c in df.columns]
        if given == names:
            counts = [F.count(c).over(W.partitionBy(*KEYS)) for c in names]
            lacking = F.least(*counts) == 0 if len(counts) > 1 else counts[0] == 0
            df = derive(df.withColumns({f"_{c}": F.col(c) for c in names} | {"_lacking": lacking}), profile)
            df = df.withColumns(
                {c: F.when(F.col("_lacking"), F.col(c)).otherwise(F.col(f"_{c}")) for c in names}
            ).drop("_lacking", *(f"_{c}" for c in names))
        else:
            df = derive(df, profile)
    return df


def coerce(df: DataFrame, profile: Profile, kind: str = "double", carry: tuple[str, ...] = ()) -> DataFrame:
    """Canonical columns in order, then those to `carry`; absent channels are null, velocity and command are derived if any of them is absent."""
    need = ["t_us", *profile.joints("q")]
    if lacking := [c for c in need if c not in df.columns]:
        raise ValueError(f"columns are missing: {', '.join(lacking)}")
    has = set(df.columns)
    if not set(profile.joints("dq")) <= has:
        df = derive_velocity(df, profile)
    if not set(profile.joints("act_q")) <= has:
        df = derive_action(df, profile)
    has = set(df.columns)
    return df.select(
        *KEYS,
        "step",
        "t_us",
        *(known(F.col(c)).cast(kind).alias(c) if c in has else F.lit(None).cast(kind).alias(c) for c in profile.channels()),
        *carry,
    )


def rebase_time(df: DataFrame) -> DataFrame:
    """Time from the episode's first sample, for episodes that are not resampled."""
    return df.withColumn("t_us", F.col("t_us") - F.min("t_us").over(W.partitionBy(*KEYS)))


def success_label(stem: Column) -> Column:
    return ~stem.rlike("(?i)(fail|bad|abort)")


# Fixed values of the placeholder geometry: centre and amplitude of each coordinate in metres.
POSE = {"ee_x": (0.30, 0.25), "ee_y": (0.0, 0.25), "ee_z": (0.40, 0.20)}
POSE_JOINTS = 6


def with_pose(df: DataFrame) -> DataFrame:
    """End-effector position and unit quaternion from the joints where the recording has none (opt-in).

    A placeholder for rigs that log no pose; it reads joints 0, 1, 3 and 5, so a table of fewer than
    six joints is an error.
    """
    if lacking := [f"q_{i}" for i in range(POSE_JOINTS) if f"q_{i}" not in df.columns]:
        raise ValueError(f"a pose needs {POSE_JOINTS} joints; columns are missing: {', '.join(lacking)}")
    turn, lift = F.sin("q_0"), F.col("q_1")
    swing = {"ee_x": turn * F.cos(lift), "ee_y": turn * F.sin(lift), "ee_z": F.cos(lift + F.col("q_3"))}
    pose = {k: F.lit(POSE[k][0]) + F.lit(POSE[k][1]) * v for k, v in swing.items()}
    known_wrist = F.col("q_5").isNotNull()
    pose |= {
        "ee_qx": F.sin(F.col("q_5") / 2),
        "ee_qy": F.when(known_wrist, 0.0),
        "ee_qz": F.when(known_wrist, 0.0),
        "ee_qw": F.cos(F.col("q_5") / 2),
    }
    return df.withColumns({k: F.coalesce(F.col(k), v) if k in df.columns else v for k, v in pose.items()})
