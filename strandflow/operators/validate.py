"""The validity gate: one aggregation of measurements, one projection that names the issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strandflow.operators.canonical import KEYS, episode_window
from strandflow.profile import Profile


def missing_columns(columns: list[str], profile: Profile) -> list[str]:
    """Canonical columns a table lacks (decided on its header alone)."""
    return sorted({"t_us", *profile.channels()} - set(columns))


def intervals() -> dict[str, Column]:
    """The time since the step before, for `aggregates`."""
    return {"_dt": (F.col("t_us") - F.lag("t_us").over(episode_window("step"))).cast("double")}


def aggregates(profile: Profile) -> dict[str, Column]:
    """What the rules look at, as aggregations of an episode's steps (with `intervals`)."""
    channels, q, act = profile.channels(), profile.joints("q"), profile.joints("act_q")
    n = F.count("*")
    excess = F.greatest(
        *(x for c, lo, up in zip(q, profile.lower, profile.upper, strict=True) for x in (F.lit(lo) - F.col(c), F.col(c) - F.lit(up))),
        F.lit(0.0),
    )
    norm = F.sqrt(F.col("ee_qx") ** 2 + F.col("ee_qy") ** 2 + F.col("ee_qz") ** 2 + F.col("ee_qw") ** 2)
    seen = [F.count(c) for c in channels]
    held = F.filter(F.array(*seen), lambda x: x > 0)
    peak = F.greatest(*(F.abs(a) for a in act)) if len(act) > 1 else F.abs(act[0])
    return {
        "n": n,
        "time_null": F.coalesce(F.bool_or(F.col("t_us").isNull()), F.lit(False)),
        "not_increasing": F.count_if(F.col("_dt") <= 0),
        "mean_dt": F.avg("_dt"),
        "absent": F.filter(F.array(*(F.when(c == 0, F.lit(name)) for c, name in zip(seen, channels, strict=True))), F.isnotnull),
        "nan_share": 1 - F.try_divide(F.aggregate(held, F.lit(0).cast("long"), lambda a, x: a + x), n * F.size(held)),
        "excess": F.coalesce(F.max(excess), F.lit(0.0)),
        "quat_off": F.max(F.abs(norm - 1)),
        **{f"{k}_{c}": f(c) for c in ("grip", "act_grip") for k, f in (("min", F.min), ("max", F.max))},
        "peak_action": F.max(peak),
    }


def measure(steps: DataFrame, profile: Profile) -> DataFrame:
    """Per episode: what the rules look at."""
    return steps.withColumns(intervals()).groupBy(*KEYS).agg(*(c.alias(k) for k, c in aggregates(profile).items()))


def validate(steps: DataFrame, profile: Profile) -> DataFrame:
    """(keys, ok, issues): issues as structs of code, message and severity, in rule order. A single row fails and is checked no further."""
    return issues_of(measure(steps, profile), profile)


def issues_of(m: DataFrame, profile: Profile) -> DataFrame:
    """`validate`, from what `measure` found."""
    tol = profile.limit_tolerance

    def issue(code: str, when: Column, severity: str, message: Column) -> Column:
        return F.when(when, F.struct(F.lit(code).alias("code"), message.cast("string").alias("message"), F.lit(severity).alias("severity")))

    n, timed = F.col("n"), ~F.col("time_null")
    rest = n >= 2
    off = F.abs(F.col("mean_dt") - profile.dt_us) / profile.dt_us
    issues = [
        issue("too_short", n < profile.min_steps, "error", n),
        issue("too_long", n > profile.max_steps, "error", n),
        issue("nonfinite_time", rest & F.col("time_null"), "error", n),
        issue("time_not_increasing", rest & timed & (F.col("not_increasing") > 0), "error", F.col("not_increasing")),
        issue("dt_mismatch", rest & timed & (F.col("not_increasing") == 0) & (off > profile.max_mean_dt_error), "error", F.col("mean_dt")),
        issue("columns_absent", rest & (F.size("absent") > 0), "warning", F.array_join(F.array_sort("absent"), ",")),
        issue("excess_nan", rest & (F.col("nan_share") > profile.max_nan_fraction), "error", F.col("nan_share")),
        issue("joint_limit_violation", rest & (F.col("excess") > tol), "error", F.col("excess")),
        issue("joint_limit_grazed", rest & (F.col("excess") > 0) & (F.col("excess") <= tol), "warning", F.col("excess")),
        issue("quaternion_not_unit", rest & (F.col("quat_off") > 0.05), "warning", F.col("quat_off")),
        *(
            issue(
                "gripper_out_of_range",
                rest & ((F.col(f"min_{c}") < -0.01) | (F.col(f"max_{c}") > 1.01)),
                "warning",
                F.lit(c),
            ) for c in ("grip", "act_grip")
        ),
        issue("action_over_limit", rest & (F.col("peak_action") > 1.05 * profile.action_limit), "warning", F.col("peak_action")),
    ]
    found = m.withColumn("issues", F.filter(F.array(*issues), F.isnotnull))
    return found.select(*KEYS, ((n >= 2) & ~F.exists("issues", lambda x: x["severity"] == "error")).alias("ok"), "issues")


def quarantine(steps: DataFrame, validation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined): steps of passing episodes, and of failing ones with their issues."""
    failed = validation.filter(~F.col("ok"))
    return steps.join(failed, list(KEYS), "left_anti"), steps.join(failed.select(*KEYS, "issues"), list(KEYS))
