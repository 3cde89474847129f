"""The driver's `events` and `lineitem` tables seen as raw episodes, and the profile that fits their units."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandflow.operators import canonical, dataset, metrics, resample, validate
from strandflow.operators.canonical import KEYS
from strandflow.profile import Anchor, Profile
from strandflow.sources.layout import scratch_layout
from strandflow.sources.scratch import cut

DAY_US = 86_400_000_000
_ANCHORS = {
    "dropped_frame_rate": Anchor(2, 0, 0.1, 0.05),
    "timing_jitter": Anchor(1, 0.7, 1.3, 1.1),
    "nan_fraction": Anchor(2, 0, 0.05, 0.01),
    "idle_fraction": Anchor(1.5, 0.1, 0.6, 0.3),
    "action_saturation": Anchor(1.5, 0.02, 0.3, 0.1),
    "jerk_spike_rate": Anchor(1, 0.02, 0.3, 0.15),
    "gripper_chatter_hz": Anchor(1, 0, 2.5e-5, 1.2e-5),
    "tracking_error": Anchor(2, 15, 40, 25),
    "duration_zabs": Anchor(0.5, 0.5, 3, 2.5),
}
PROFILE = Profile(
    n_joints=3, dt_us=DAY_US // 4, max_gap_us=2 * DAY_US, lower=(0.0, 0.0, 0.0), upper=(300.0, 99.0, 4.0), limit_tolerance=30.0,
    action_limit=50.0, min_steps=36, max_steps=39, max_mean_dt_error=0.35, max_nan_fraction=0.1, idle_speed_eps=0.0006, jerk_spike_k=4.0,
    anchors=_ANCHORS, gold=80.0, silver=60.0, hard_max_nan=0.2, hard_min_steps=30, horizon=4, bootstrap_samples=200, rollout_horizons=(1, 4, 8),
)
OBS, ACT = ["q_0", "q_1", "q_2", "grip", "prev_act_q_0", "prev_act_q_1", "prev_act_q_2"], ["act_q_0", "act_q_1", "act_q_2"]
CHANNELS = ["q_0", "q_1", "q_2", "grip", "act_q_0", "act_q_1", "act_q_2"]


def keep(df: DataFrame) -> DataFrame:
    """A table that a query reads several times, written once."""
    return cut(df, "kept")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with messy headers; a tenth of the sessions is recorded a second time under another id, and rates (samples a day) differ."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("double")
    code = F.array_position(
        F.array(*(F.lit(x) for x in ("click", "error", "purchase", "signup", "view"))),
        F.col("event_type"),
    ).cast("double") - 1
    block = F.expr("cast((day(ts) - 1) div 10 as int)")
    odd = F.pmod(F.col("user_id") + block, F.lit(10))
    rows = e.select(
        "event_id", "user_id", block.alias("block"), F.unix_micros("ts").alias("TimeStamp"),
        F.when(F.col("user_id") % 9 == 4, 7.0).when(F.col("user_id") % 9 == 5, 3.7).otherwise(4.0).alias("rate"),
        F.when((F.col("event_type") == "error") & (F.col("event_id") % 25 == 0), None).otherwise(F.col("value")).alias("Joint_0"),
        k.alias("jpos1"), code.alias(" joint_2"), (k / 100).alias("Gripper"), (
            F.pmod(F.col("event_id") * 7, F.lit(41)) - 20.0
        ).alias("cmd_0"), (k - 50).alias("action_1"), (code - 2).alias("target2"),
        F.concat(F.lit("episode_"), block, F.when(odd == 0, "_fail").when(odd == 1, "_ABORT").otherwise("_ok")).alias("stem"),
    )
    copies = F.explode(F.when(F.col("user_id") % 10 == 3, F.array(F.lit(""), F.lit("c"))).otherwise(F.array(F.lit("")))).alias("copy")
    return rows.select("*", copies).withColumn(
        "session_id",
        F.concat(F.col("user_id").cast("string"), F.col("copy")),
    ).withColumn("episode_id", F.concat_ws("__", "session_id", "stem"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with canonical names; t is t_us here, in microseconds."""
    return canonical.canonicalise(raw_events(spark, sf_dir)).withColumnRenamed("t", "t_us")


def grid(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """The raw rows on their grids; with `parts`, dealt by episode into just as many tasks."""
    rows = raw(spark, sf_dir)
    rows = rows if parts is None else rows.repartition(parts, *KEYS)
    return resample.resample(rows, CHANNELS, F.col("rate"), PROFILE.max_gap_us, ["event_id"], DAY_US, ["user_id", "stem"])


def _damaged(steps: DataFrame) -> DataFrame:
    """Faults in some sessions, one kind each, so that every rule of the validity gate has something to find."""
    kind = F.replace("session_id", F.lit("c"), F.lit("")).cast("int") % 13
    time = F.when((kind == 7) & (F.col("step") == 5), None).when(
        (kind == 8) & (F.col("step") == 9),
        F.col("t_us") - 10 * DAY_US,
    ).otherwise(F.col("t_us"))
    faults = {
        "t_us": time,
        "grip": F.when(kind == 9, F.col("grip") + 0.5).otherwise(F.col("grip")),
        "act_q_1": F.when(kind == 10, F.col("act_q_1") * 3).otherwise(F.col("act_q_1")),
    }
    pose = {"ee_qx": 0.6, "ee_qy": 0.0, "ee_qz": 0.0, "ee_qw": 1.0}
    return steps.withColumns(faults | {c: F.when(kind == 11, v) for c, v in pose.items()})


_MADE = ("off_grid", "n_raw", "raw_dt_jitter", "raw_gap_fraction", "user_id", "stem", "grid_us")


def wide(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """The steps, and beside them what the grid says of its episodes."""
    made = grid(spark, sf_dir, parts).withColumn("grid_us", F.col("t_us"))
    return _damaged(canonical.coerce(made, PROFILE, carry=_MADE))


def steps(spark: SparkSession, sf_dir: str, made: DataFrame | None = None) -> DataFrame:
    return (wide(spark, sf_dir) if made is None else made).drop(*_MADE)


def _with_ids(episodes: DataFrame) -> DataFrame:
    ids = {
        "operator_id": F.concat(F.lit("op"), F.col("user_id") % 4),
        "task_id": F.concat(F.lit("task"), F.col("user_id") % 5),
        "success": canonical.success_label(F.col("stem")),
    }
    return episodes.withColumns(ids).drop("user_id", "stem")


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per episode: ids, label, raw timing, and what the grid made of it."""
    return _with_ids(resample.episodes_of(grid(spark, sf_dir), "user_id", "stem"))


def measured(made: DataFrame) -> tuple[DataFrame, list[str]]:
    """(one row per episode, columns of `episodes`): what the grid, the metrics and the rules need of its steps (`wide`), from one pass over them."""
    of_grid = resample.episode_aggregates("user_id", "stem", time="grid_us")
    found = of_grid | metrics.step_aggregates(PROFILE) | validate.aggregates(PROFILE)
    near = metrics.with_neighbours(made, PROFILE, validate.intervals())
    rows = _with_ids(near.groupBy(*KEYS).agg(*(c.alias(k) for k, c in found.items())))
    others = {*metrics.step_aggregates(PROFILE), *validate.aggregates(PROFILE)} - set(of_grid)
    return keep(rows), [c for c in rows.columns if c not in others]


def judged(
    spark: SparkSession, sf_dir: str, population: list[str] | None = None, made: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(steps, episodes, quality, validation)."""
    made = wide(spark, sf_dir) if made is None else made
    rows, own = measured(made)
    q = metrics.combined(metrics.duration_zabs(rows, population or ["task_id"]), own)
    return steps(spark, sf_dir, made), rows.select(*own), metrics.score(q, PROFILE), validate.issues_of(rows, PROFILE)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir)[2]


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate(steps(spark, sf_dir), PROFILE)


def gated(spark: SparkSession, sf_dir: str, made: DataFrame | None = None) -> DataFrame:
    """Episodes with exclude_reason."""
    return dataset.gate(*judged(spark, sf_dir, made=made)[1:], PROFILE)


def built(spark: SparkSession, sf_dir: str, hashed: Callable[[DataFrame, list[str]], DataFrame] = dataset.content_hash) -> tuple[DataFrame, DataFrame]:
    """(table, members), whose content_hash `hashed` makes; the grid is made once for the judgement and the table, and laid out by episode.

    Its rows are dealt into the layout's buckets at once: tasks that are merged by size come out a few more than there are cores.
    """
    made = scratch_layout(wide(spark, sf_dir, int(spark.conf.get("spark.sql.shuffle.partitions"))), "wide")
    return dataset.build(steps(spark, sf_dir, made), keep(gated(spark, sf_dir, made)), OBS, ACT, PROFILE, keep=keep, hashed=hashed)
