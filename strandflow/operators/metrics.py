"""Nine quality metrics, their penalties, the composite score and the tier.

All metrics come from two windows over (session, episode) and one aggregation on the same keys,
so a table that is laid out by episode is not exchanged again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strandflow.operators.canonical import KEYS, episode_window
from strandflow.operators.quantiles import quantiles
from strandflow.profile import METRICS, Anchor, Profile

MAD_SCALE = 1.4826


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def centre_and_scale(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per keys: _median, _scale (scaled median absolute deviation) and _size of a column's known values.

    Exact, by `quantiles`; no task holds more of a key than its bound.
    """
    middle = quantiles(df, keys, column, {"_median": 0.5})
    off = df.select(*keys, column).alias("d").join(middle.alias("m"), [F.col(f"d.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys])
    off = off.select(*(F.col(f"d.{k}").alias(k) for k in keys), F.abs(F.col(f"d.{column}") - F.col("_median")).alias("_off"))
    spread = quantiles(off, keys, "_off", {"_mad": 0.5}).drop("size")
    both = middle.alias("m").join(spread.alias("s"), [F.col(f"m.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    return both.select(*(F.col(f"m.{k}").alias(k) for k in keys), "_median", (MAD_SCALE * F.col("_mad")).alias("_scale"), F.col("size").alias("_size"))


def _beside(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with its keys' statistics (null where they have none)."""
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return df.alias("d").join(stats.alias("s"), same, "left").select("d.*", "_median", "_scale", "_size")


def robust_scale(df: DataFrame, keys: list[str], column: str, name: str = "scale") -> DataFrame:
    """Adds the scaled median absolute deviation of a column within its keys (null values are skipped; 0 if there are none)."""
    found = _beside(df, centre_and_scale(df, keys, column), keys)
    return found.withColumn(name, F.coalesce("_scale", F.lit(0.0))).drop("_median", "_scale", "_size")


def with_neighbours(steps: DataFrame, profile: Profile, more: dict[str, Column] | None = None) -> DataFrame:
    """Steps with what `step_aggregates` needs of the rows around them: one window in their order, two over the episode for the medians.

    `more` columns that look at rows in the same order come from the same window.
    """
    q, act = profile.joints("q"), profile.joints("act_q")
    w, own = episode_window("step"), W.partitionBy(*KEYS)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    # the gripper's state changes only at rows beyond either threshold; before the first of them it is that of the first known row
    grip = F.col("grip")
    mark = F.when(grip > 0.6, 1).when(grip < 0.4, 0)
    held = F.coalesce(F.last(mark, ignorenulls=True).over(before), (F.first(grip, ignorenulls=True).over(before) > 0.5).cast("int"))
    df = steps.withColumns(
        {f"_j_{i}": F.abs(F.col(a) - F.lag(a).over(w)) for i, a in enumerate(act)} | {
            f"_d_{i}": F.abs(F.lead(c).over(w) - F.col(c) - F.col(a)) for i, (c, a) in enumerate(zip(q, act, strict=True))
        } | {"_mark": mark, "_held": held} | (more or {})
    )
    df = df.withColumns({f"_m_{i}": F.median(f"_j_{i}").over(own) for i in range(profile.n_joints)})
    return df.withColumns(
        {f"_s_{i}": MAD_SCALE * F.median(F.abs(F.col(f"_j_{i}") - F.col(f"_m_{i}"))).over(own) for i in range(profile.n_joints)}
    )


def step_aggregates(profile: Profile) -> dict[str, Column]:
    """The metrics that come from an episode's steps (`with_neighbours`), and n_steps, as aggregations."""
    q, dq, act = profile.joints("q"), profile.joints("dq"), profile.joints("act_q")
    spike = any_of(
        [
            F.coalesce(
                (F.col(f"_s_{i}") > 0) & (F.col(f"_j_{i}") > F.col(f"_m_{i}") + profile.jerk_spike_k * F.col(f"_s_{i}")),
                F.lit(False),
            ) for i in range(profile.n_joints)
        ]
    )
    highest = F.greatest(*(F.abs(a) for a in act)) if len(act) > 1 else F.abs(act[0])
    n, channels = F.count("*"), profile.channels()
    counts = F.array(*(F.count(c) for c in channels))
    held = F.filter(counts, lambda x: x > 0)
    return {
        "n_steps": n,
        "dropped": F.avg(any_of([F.col(c).isNull() for c in [*q, *dq, *act]]).cast("double")),
        "nan_fraction": F.when(F.size(held) == 0, 1.0).otherwise(
            1 - F.try_divide(F.aggregate(held, F.lit(0).cast("long"), lambda a, x: a + x), n * F.size(held))
        ),
        "idle_fraction": F.avg(
            (F.sqrt(total([F.coalesce(F.col(c), F.lit(0.0)) ** 2 for c in dq])) < profile.idle_speed_eps).cast("double")
        ),
        "action_saturation": F.coalesce(
            F.avg(F.when(highest.isNotNull(), (highest >= 0.98 * profile.action_limit).cast("double"))),
            F.lit(0.0),
        ),
        "jerk_spike_rate": F.when(n < 3, 0.0).otherwise(F.try_divide(F.sum(spike.cast("double")), n - 1)),
        "grip_changes": F.when(F.count("grip") < 2, 0).otherwise(F.count_if(F.col("_mark") != F.col("_held"))),
        "tracking_error": F.when(n < 2, 0.0).otherwise(
            F.coalesce(
                F.try_divide(
                    total([F.coalesce(F.sum(f"_d_{i}"), F.lit(0.0)) for i in range(profile.n_joints)]),
                    total([F.count(f"_d_{i}") for i in range(profile.n_joints)]),
                ),
                F.lit(0.0),
            )
        ),
    }


def step_metrics(steps: DataFrame, profile: Profile) -> DataFrame:
    """Per episode: the seven metrics that come from the steps, and n_steps."""
    return with_neighbours(steps, profile).groupBy(*KEYS).agg(*(c.alias(k) for k, c in step_aggregates(profile).items()))


def duration_zabs(episodes: DataFrame, keys: list[str]) -> DataFrame:
    """Adds each episode's distance from its population's median duration in robust scales; 0 below 3 episodes or without spread.

    Durations are whole grid steps, so a population has few distinct ones.
    """
    df = _beside(episodes, centre_and_scale(episodes, keys, "duration_s"), keys)
    z = F.abs(F.col("duration_s") - F.col("_median")) / F.nullif(F.col("_scale"), F.lit(0.0))
    return df.withColumn(
        "duration_zabs",
        F.when((F.col("_size") >= 3) & (F.col("_scale") > 0), z).otherwise(0.0),
    ).drop("_median", "_scale", "_size")


def metrics(steps: DataFrame, episodes: DataFrame, profile: Profile, population: list[str] | None = None) -> DataFrame:
    """Per episode of `episodes`: all nine metrics. `population` names the keys durations are compared within (task_id; for one session alone session_id)."""
    m = duration_zabs(episodes, population or ["task_id"]).join(step_metrics(steps, profile).drop("n_steps"), list(KEYS))
    return combined(m, episodes.columns)


def combined(m: DataFrame, columns: list[str]) -> DataFrame:
    """`metrics`, from episodes with duration_zabs and the columns of `step_metrics`; `columns` go with them."""
    return m.select(
        *columns,
        F.greatest("dropped", "raw_gap_fraction").alias("dropped_frame_rate"),
        F.col("raw_dt_jitter").alias("timing_jitter"),
        "nan_fraction", "idle_fraction", "action_saturation", "jerk_spike_rate",
        F.when(
            F.col("duration_s") > 0,
            F.col("grip_changes") / F.nullif(F.col("duration_s"), F.lit(0.0)),
        ).otherwise(0.0).alias("gripper_chatter_hz"),
        "tracking_error", "duration_zabs",
    )


def penalty(value: Column, anchor: Anchor) -> Column:
    if anchor.good == anchor.bad:
        return F.when(value <= anchor.good, 0.0).otherwise(1.0)
    return F.least(F.greatest((value - anchor.good) / (anchor.bad - anchor.good), F.lit(0.0)), F.lit(1.0))


def score(measured: DataFrame, profile: Profile) -> DataFrame:
    """Adds score, flags, the metric structs, hard_reject_reasons and tier. A missing metric counts as 0."""
    a = profile.anchors
    value = {m: F.coalesce(F.col(m), F.lit(0.0)) for m in METRICS}
    weights = sum(a[m].weight for m in METRICS)
    worth = 100 * (1 - total([a[m].weight * penalty(value[m], a[m]) for m in METRICS]) / weights)
    flags = F.array(*(F.when(value[m] >= a[m].flag_at, F.lit(m)) for m in METRICS))
    structs = F.array(
        *(
            F.struct(
                F.lit(m).alias("name"),
                value[m].alias("value"),
                penalty(value[m], a[m]).alias("penalty"),
                F.lit(float(a[m].weight)).alias("weight"),
                (value[m] >= a[m].flag_at).alias("flagged"),
            ) for m in METRICS
        )
    )
    reasons = F.array(
        F.when(value["nan_fraction"] > profile.hard_max_nan, F.lit("nan_fraction")),
        F.when(value["dropped_frame_rate"] > profile.hard_max_dropped, F.lit("dropped_frame_rate")),
        F.when(F.col("n_steps") < profile.hard_min_steps, F.lit("n_steps")),
    )
    df = measured.withColumns(
        {"score": worth, "flags": F.filter(flags, F.isnotnull), "metrics": structs, "hard_reject_reasons": F.filter(reasons, F.isnotnull)}
    )
    tier = F.when(
        F.size("hard_reject_reasons") > 0,
        "reject",
    ).when(F.col("score") >= profile.gold, "gold").when(F.col("score") >= profile.silver, "silver").otherwise("reject")
    return df.withColumn("tier", tier)
