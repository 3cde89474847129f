"""The registered queries over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandflow.operators import canonical, dataset, evaluate, metrics, resample, rollups, validate
from strandflow.plans import driver_views as v
from strandflow.plans.driver_views import ACT, OBS, PROFILE, table

KEYS = list(canonical.KEYS)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to 6 digits: engines add in different orders."""
    return df.select(*(F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _windows(built, side=None):
    """The windows of a built table; of one side, if named: a session lies on one, so no window is lost."""
    return dataset.action_chunks(built if side is None else built.filter(F.col("split") == side), ACT, PROFILE.horizon, OBS)


def _train_mean(built):
    train = built.filter("split = 'train'").agg(*(F.avg(a).alias(a) for a in ACT))
    return train.select(F.posexplode(F.array(*ACT)).alias("d", "mean"))


def _predicted(spark, sf, keep=False):
    built, _ = v.built(spark, sf)
    windows = _windows(built, "val")
    return evaluate.baselines(evaluate.long_form(v.keep(windows) if keep else windows), _train_mean(built))


def _policy(spark, sf, keep=False):
    """Baselines beside a policy that SQL can state: the mean of the previous action and the train mean."""
    return _predicted(spark, sf, keep).withColumn("policy", (F.col("persistence") + F.col("train_mean")) / 2)


def _fitted(spark, sf):
    """(table, val windows, model, history) of the chunk policy fitted on the train split: least squares, then the robust loss.

    The train windows are read in every round, so only what a round reads is kept, in flat arrays.
    """
    built, _ = v.built(spark, sf)
    train = v.keep(_windows(built, "train").select("obs", F.flatten("actions").alias("actions")))
    val = v.keep(_windows(built, "val"))
    rows = dataset.norm_stats(built.filter("split = 'train'"), [*OBS, *ACT]).collect()
    model = evaluate.fit_policy(train, {r["column"]: (r["mean"], r["std"]) for r in rows}, OBS, ACT)
    model = evaluate.refit(train, model)
    return built, val, model, v.keep(evaluate.fit_history(val, model))


def _fitted_predictions(spark, sf):
    """Baselines beside the fitted policy, in long form."""
    built, val, model, history = _fitted(spark, sf)
    evaluate.check_layout(model["obs"], OBS)
    found = v.keep(evaluate.predict(val, model, evaluate.choose(model, history)))
    long = evaluate.long_form(found, "predicted")
    return evaluate.baselines(long, v.keep(_train_mean(built))).withColumnRenamed("predicted", "policy")


def _issue_counts(spark, sf):
    return v.validation(spark, sf).select(*KEYS, F.inline("issues")).select(*KEYS, "code", "severity")


def scan_events(spark, sf):
    return table(spark, sf, "events").filter("value > 50").groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.round(F.sum("value"), 4).alias("total"),
    )


def session_meta_check(spark, sf):
    n = F.lit(3)
    s = table(spark, sf, "customer").select(
        F.concat(F.lit(" s"), "c_custkey").alias("session_id"),
        F.when(F.col("c_custkey") % 7 == 0, " ").otherwise("op").alias("operator_id"),
        F.lit("r").alias("robot_id"),
        F.lit("t").alias("task_id"),
        (F.col("c_custkey") % 11).cast("double").alias("control_hz"),
        F.when(F.col("c_custkey") % 13 == 0, n + 1).otherwise(n).cast("int").alias("n_joints"),
    )
    from strandflow.sources.sessions import check_sessions

    return check_sessions(s, 3).groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


def success_label(spark, sf):
    return v.episodes(spark, sf).groupBy("success").agg(F.count("*").alias("n"), F.min("episode_id").alias("first_id"))


def canonicalise(spark, sf):
    return rounded(v.raw(spark, sf).select("session_id", "event_id", "t_us", "q_0", "q_1", "q_2", "grip", "act_q_0", "act_q_1", "act_q_2"))


def resample_grid(spark, sf):
    return v.grid(spark, sf).groupBy(*KEYS).agg(F.count("*").alias("n_steps"), F.max("t_us").alias("last_us"))


def resample_interp(spark, sf):
    return rounded(v.grid(spark, sf).select(*KEYS, "step", *v.CHANNELS), 5)


def live_resample(spark, sf):
    """`resample_interp` from a stream: the raw rows as they would arrive, and one row of another session long after, which ends all."""
    from strandflow.sources.scratch import shared_dir
    from strandflow.streaming import live, state

    raw = v.raw(spark, sf).select(*KEYS, F.timestamp_micros("t_us").alias("ts"), "rate", *v.CHANNELS)
    after = raw.agg(F.max("ts").alias("ts")).select(
        F.lit("end").alias("session_id"), F.lit("end").alias("episode_id"), (F.col("ts") + F.expr("interval 400 days")).alias("ts"), F.lit(1.0).alias("rate"),
        *(F.lit(None).cast("double").alias(c) for c in v.CHANNELS),
    )
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    raw.unionByName(after).write.parquet(f"{folder}/raw")
    arriving = spark.readStream.schema(raw.schema).parquet(f"{folder}/raw")
    made = live.resample_stream(arriving, "ts", v.CHANNELS, PROFILE.max_gap_us, "1 hour", 40 * v.DAY_US, v.DAY_US)
    found = state.append_available(made, f"{folder}/grid", f"{folder}/checkpoint")
    return rounded(found.filter("step is not null and session_id <> 'end'").select(*KEYS, "step", *v.CHANNELS), 5)


def resample_gaps(spark, sf):
    return v.grid(spark, sf).groupBy(*KEYS).agg(F.count_if(F.col("q_1").isNull()).alias("holes"))


def interp_fraction(spark, sf):
    return rounded(v.episodes(spark, sf).select(*KEYS, "interp_fraction"))


def raw_timing(spark, sf):
    return rounded(resample.raw_timing(v.raw(spark, sf), PROFILE.max_gap_us, ["event_id"]))


def late_steps(spark, sf):
    return resample.late_steps(v.raw(spark, sf), PROFILE.dt_us, tie=["event_id"])


def rebase_time(spark, sf):
    return canonical.rebase_time(v.raw(spark, sf)).select("session_id", "event_id", "t_us")


def derive_velocity(spark, sf):
    return rounded(v.steps(spark, sf).select(*KEYS, "step", "dq_0", "dq_1", "dq_2"), 8)


def derive_action(spark, sf):
    return rounded(canonical.derive_action(v.grid(spark, sf), PROFILE).select(*KEYS, "step", "act_q_0", "act_q_1", "act_q_2"), 5)


def coerce_schema(spark, sf):
    s = v.steps(spark, sf)
    return s.agg(F.count("*").alias("n"), *(F.count(c).alias(f"n_{c}") for c in PROFILE.channels()))


def ee_pose(spark, sf):
    """The driver's episodes have three joints; angles in turn stand for the six that a pose reads."""
    angles = {f"q_{i}": F.col(f"q_{i % 3}") / 100 for i in range(6)}
    six = v.steps(spark, sf).select(*KEYS, "step", *(c.alias(k) for k, c in angles.items()))
    return rounded(canonical.with_pose(six).drop(*angles), 5)


def m_step_metrics(spark, sf):
    return rounded(metrics.step_metrics(v.steps(spark, sf), PROFILE), 5)


def m_duration_zabs(spark, sf):
    return rounded(metrics.duration_zabs(v.episodes(spark, sf), ["task_id"]).select(*KEYS, "duration_zabs"), 5)


def robust_scale(spark, sf):
    return rounded(
        metrics.robust_scale(
            table(spark, sf, "lineitem"),
            ["l_suppkey"],
            "l_extendedprice",
        ).groupBy("l_suppkey").agg(F.max("scale").alias("scale")),
        4,
    )


def quality_score(spark, sf):
    return rounded(v.quality(spark, sf).select(*KEYS, "score", F.array_join("flags", ",").alias("flags")), 4)


def tiering(spark, sf):
    return v.quality(spark, sf).select(*KEYS, "tier", F.array_join("hard_reject_reasons", ",").alias("reasons"))


def session_scoring(spark, sf):
    return rounded(v.judged(spark, sf, ["session_id"])[2].select(*KEYS, "duration_zabs", "score"), 4)


def penalty(spark, sf):
    """The mean penalty of each metric."""
    return rounded(
        v.quality(spark, sf).select(F.inline("metrics")).groupBy("name").agg(
            F.avg("penalty").alias("mean_penalty"),
            F.count_if("flagged").alias("flagged"),
        ),
        5,
    )


def validate_issues(spark, sf):
    return _issue_counts(spark, sf)


def validate_ok(spark, sf):
    return v.validation(spark, sf).select(*KEYS, "ok")


def v_time_not_increasing(spark, sf):
    """Supplier-years of line items as episodes, in the order of their dates: dates tie, so time does not increase."""
    li = table(spark, sf, "lineitem")
    li = li.select(
        F.col("l_suppkey").cast("string").alias("session_id"),
        F.year("l_shipdate").cast("string").alias("episode_id"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("t_us"),
        F.col("l_quantity").alias("q_0"),
        F.col("l_tax").alias("q_1"),
        F.col("l_discount").alias("q_2"),
    )
    li = li.withColumn("step", F.row_number().over(canonical.episode_window("t_us", "q_0", "q_1", "q_2")))
    others = [c for c in PROFILE.channels() if c not in li.columns]
    return validate.measure(li.withColumns({c: F.lit(None).cast("double") for c in others}), PROFILE).select(*KEYS, "n", "not_increasing")


def quarantine_split(spark, sf):
    s = v.keep(v.steps(spark, sf))
    kept, failed = validate.quarantine(s, validate.validate(s, PROFILE))
    counts = lambda df, ok: df.agg(F.lit(ok).alias("ok"), F.count("*").alias("n_steps"), F.countDistinct("episode_id").alias("n_episodes"))
    return counts(kept, True).unionAll(counts(failed, False))


def corpus_summary(spark, sf):
    return rounded(rollups.corpus_summary(v.quality(spark, sf)), 4)


def tier_counts(spark, sf):
    return rounded(rollups.tier_counts(v.quality(spark, sf)))


def flag_counts(spark, sf):
    return rounded(rollups.flag_counts(v.quality(spark, sf)))


def operator_rollup(spark, sf):
    return rounded(rollups.operator_rollup(v.quality(spark, sf)), 4)


def task_rollup(spark, sf):
    return rounded(rollups.task_rollup(v.quality(spark, sf)), 4)


def metric_distributions(spark, sf):
    return rounded(rollups.metric_distributions(v.quality(spark, sf)), 4)


def worst_episodes(spark, sf):
    return rounded(rollups.worst_episodes(v.quality(spark, sf)), 4)


def validation_rollup(spark, sf):
    return rollups.validation_rollup(v.validation(spark, sf))


def issue_counts(spark, sf):
    return rollups.issue_counts(v.validation(spark, sf))


def validation_summary(spark, sf):
    return rollups.validation_summary(v.validation(spark, sf))


def drop_rate(spark, sf):
    _, _, quality, validation = v.judged(spark, sf)
    return rounded(rollups.drop_rate(validation, quality))


def ingest_summary(spark, sf):
    return rounded(rollups.ingest_summary(v.episodes(spark, sf)))


def ingest_result(spark, sf):
    """The sessions of a run, those skipped for their metadata, and those pruned since their source is gone."""
    e = v.keep(v.episodes(spark, sf))
    skipped = e.select("session_id").distinct().filter("session_id like '%c'").select(
        F.when(F.length("session_id") < 3, "n_joints").otherwise("unreadable").alias("reason")
    )
    pruned = rollups.prune_orphans(e.select("session_id").distinct(), e.filter("length(session_id) < 3"), e.limit(0)).filter("not keep")
    found = rollups.ingest_result(e, skipped, pruned)
    return found.withColumn(
        "reasons",
        F.array_join(F.transform("reasons", lambda x: F.concat_ws(":", x["reason"], x["n"].cast("string"))), ","),
    )


def episode_meta(spark, sf):
    """Session metadata beside its episodes."""
    e = v.episodes(spark, sf)
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("session_id"), F.col("c_mktsegment").alias("robot_id"))
    return rounded(e.join(c, "session_id").select(*KEYS, "robot_id", "duration_s"))


def episodes_with_quality(spark, sf):
    _, e, q, _ = v.judged(spark, sf)
    e = e.join(q.select(*KEYS, "score", "tier", F.array_join("flags", ",").alias("flags")), KEYS, "left")
    return rounded(e.select(*KEYS, "n_steps", "score", "tier", "flags"), 4)


def project_obs(spark, sf):
    """Columns of symbolic keys, in the order of the keys."""
    columns = dataset.select_columns(["grip", "q", "act_q"], PROFILE)
    return rounded(v.steps(spark, sf).select(*KEYS, "step", *columns), 5)


def gate_reasons(spark, sf):
    return v.gated(spark, sf).select(*KEYS, F.coalesce("exclude_reason", F.lit("")).alias("exclude_reason"))


def gate_join(spark, sf):
    return v.gated(spark, sf).groupBy("tier", "ok").agg(F.count("*").alias("n"))


def prune_orphans(spark, sf):
    e = v.episodes(spark, sf).select("session_id").distinct()
    declared, folders = e.filter(F.length("session_id") < 3), e.filter(F.col("session_id").endswith("c"))
    return rollups.prune_orphans(e, declared, folders)


def dedupe_episodes(spark, sf):
    d = table(spark, sf, "documents").withColumn("content_hash", F.sha2("text", 256))
    return dataset.dedupe(d, ("doc_id",)).select("doc_id", "duplicate")


def content_hash(spark, sf):
    """Of the raw rows in the order of time; copied sessions have equal hashes."""
    ordered = v.raw(spark, sf).withColumn("step", F.row_number().over(canonical.episode_window("t_us", "event_id")))
    return dataset.content_hash(ordered, v.CHANNELS)


def assign_split(spark, sf):
    c = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("session_id")).distinct()
    return c.select("session_id", dataset.assign_split(F.col("session_id"), PROFILE).alias("split"))


def prev_action(spark, sf):
    return rounded(dataset.prev_action(v.steps(spark, sf), ACT).select(*KEYS, "step", *(f"prev_{a}" for a in ACT)), 5)


def dense_steps(spark, sf):
    return dataset.dense_steps(v.steps(spark, sf), ["q_0", "q_1", *ACT]).select(*KEYS, "step", "t_us")


def norm_stats(spark, sf):
    wide = table(spark, sf, "embeddings").select(*(F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)))
    return rounded(dataset.norm_stats(wide, wide.columns))


def normalise(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    s = {r["column"]: (r["mean"], r["std"]) for r in dataset.norm_stats(li, ["l_quantity", "l_tax"]).collect()}
    return rounded(dataset.normalise(li, s), 5)


def split_summary(spark, sf):
    return rounded(rollups.split_summary(v.built(spark, sf)[1]), 4)


def exclusions(spark, sf):
    return rollups.exclusions(v.built(spark, sf)[1])


def heldout_operators(spark, sf):
    c = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("operator_id"),
        dataset.assign_split(F.col("o_orderkey").cast("string"), PROFILE).alias("split"),
    )
    return rollups.heldout_operators(c)


def dataset_hash(spark, sf):
    """Over the sha256 of each member's steps in their order."""
    return dataset.dataset_hash(v.built(spark, sf, dataset.ordered_hash)[1], ",".join(OBS + ACT))


def manifest(spark, sf):
    """The manifest, flat: columns with their places, normalisation, exclusions, splits, filters and the hash."""
    built, members = v.built(spark, sf)
    made = v.keep(dataset.manifest(built, members, OBS, ACT, PROFILE))
    parts = [
        ("observation", made.select(F.posexplode("obs_columns").alias("x", "name"))),
        ("action", made.select(F.posexplode("action_columns").alias("x", "name"))),
        ("norm", made.select(F.inline("norm")).toDF("name", "x", "y")),
        ("excluded", made.select(F.inline("excluded")).toDF("name", "x")),
        ("split", made.select(F.inline("splits")).toDF("name", "x", "y", "z")),
        ("filters", made.select(F.col("filters").alias("name"))),
        ("hash", made.select(F.col("dataset_hash").alias("name"))),
    ]
    number = lambda df, c: (F.col(c) if c in df.columns else F.lit(None)).cast("double").alias(c)
    flat = [df.select(F.lit(kind).alias("kind"), "name", *(number(df, c) for c in "xyz")) for kind, df in parts]
    return rounded(reduce(DataFrame.unionAll, flat), 5)


def action_chunks(spark, sf):
    w = _windows(v.built(spark, sf)[0])
    return w.groupBy(*KEYS).agg(
        F.count("*").alias("n_windows"),
        F.round(F.sum(F.expr("aggregate(transform(actions, a -> a[0] + a[1] + a[2]), 0D, (s, x) -> s + x)")), 4).alias("total"),
    )


def conversation_windows(spark, sf):
    """Windows of three turns that never leave a conversation."""
    c = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("session_id"),
        F.lit("c").alias("episode_id"),
        F.col("turn").alias("step"),
        F.col("turn").alias("t_us"),
        F.length("text").cast("double").alias("chars"),
    )
    w = dataset.action_chunks(c, ["chars"], 3)
    return w.select("session_id", "window", F.expr("aggregate(actions, 0D, (s, x) -> s + x[0])").alias("chars"))


def baselines(spark, sf):
    return rounded(
        _predicted(spark, sf).groupBy("d", "k").agg(
            F.count("*").alias("n"),
            F.avg("truth").alias("truth"),
            F.avg("train_mean").alias("train_mean"),
            F.avg("persistence").alias("persistence"),
        ),
        5,
    )


def baseline_errors(spark, sf):
    return rounded(evaluate.baseline_errors(_predicted(spark, sf)), 5)


def mae_by_offset(spark, sf):
    return rounded(evaluate.mae_by_offset(_predicted(spark, sf)), 5)


def policy_errors(spark, sf):
    return rounded(evaluate.policy_errors(_policy(spark, sf), "policy", 2), 5)


def joint_errors(spark, sf):
    return rounded(evaluate.joint_errors(_policy(spark, sf), "policy"), 5)


def skill(spark, sf):
    p = (*evaluate.PREDICTORS, "policy")
    return rounded(evaluate.skill(evaluate.baseline_errors(_policy(spark, sf), p), "policy"), 5)


def offset_curve(spark, sf):
    return rounded(evaluate.offset_curve(_policy(spark, sf, True), "policy"), 5)


def fitted_errors(spark, sf):
    """Errors and skill of the fitted policy."""
    p = _fitted_predictions(spark, sf)
    gain = evaluate.skill(evaluate.baseline_errors(p, (*evaluate.PREDICTORS, "policy")), "policy")
    return evaluate.policy_errors(p, "policy", 2).join(gain)  # one row each


def fitted_joint_errors(spark, sf):
    return evaluate.joint_errors(_fitted_predictions(spark, sf), "policy")


def fitted_curve(spark, sf):
    return evaluate.offset_curve(_fitted_predictions(spark, sf), "policy")


def fitted_interval(spark, sf):
    """Interval of the fitted policy's next-step error, resampling episodes."""
    p = _fitted_predictions(spark, sf).filter("k = 0").withColumn("error", F.abs(F.col("policy") - F.col("truth")))
    return evaluate.bootstrap(p, KEYS, "error", PROFILE.bootstrap_samples, PROFILE.seed)


def cluster_bootstrap(spark, sf):
    return rounded(
        evaluate.cluster_bootstrap(table(spark, sf, "supplier"), ["s_nationkey"], "s_acctbal", PROFILE.bootstrap_samples, PROFILE.seed),
        4,
    )


def rollout_starts(spark, sf):
    return evaluate.rollout_starts(v.steps(spark, sf).groupBy(*KEYS).agg(F.count("*").alias("length")), 8)


def persistence_drift(spark, sf):
    built, _ = v.built(spark, sf)
    return rounded(evaluate.persistence_drift(built, PROFILE.joints("q"), ACT, PROFILE.rollout_horizons), 4)


def rollout_drift(spark, sf):
    """Mean open-loop drift of the fitted policy after each horizon."""
    built, _, model, history = _fitted(spark, sf)
    weights, val = evaluate.choose(model, history), built.filter("split = 'val'")
    parts = [
        evaluate.rollout_drift(val, model, weights, n, PROFILE.horizon).agg(
            F.lit(n).alias("horizon"),
            F.avg("drift").alias("drift"),
            F.count("*").alias("n_rollouts"),
        ) for n in PROFILE.rollout_horizons
    ]
    return reduce(DataFrame.unionAll, parts)


def smooth_l1(spark, sf):
    e = evaluate.smooth_l1(F.col("l_discount") - F.col("l_tax") * 2)
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.avg(e), 6).alias("loss"))


def gram(spark, sf):
    """Sums of products of all 64 components, the last one as the outcome."""
    wide = table(spark, sf, "embeddings").select(*(F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)))
    return rounded(evaluate.gram(wide, [f"e{i}" for i in range(63)], ["e63"]), 4)


def fit_policy(spark, sf):
    """Validation loss of each ridge candidate of the chunk policy, and which one is chosen."""
    return _fitted(spark, sf)[3]


def retry_ledger(spark, sf):
    from strandflow.streaming.loop import retry_ledger as ledger

    o = table(spark, sf, "orders")
    s = lambda c: o.filter(c).select(F.col("o_custkey").cast("string").alias("session_id"))
    return ledger(s("o_orderstatus = 'O'"), s("o_orderstatus = 'P'"), s("o_orderpriority = '1-URGENT'"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    helpers = {"rounded", "table", "queries"}
    return {
        k: f for k, f in globals().items() if callable(f) and getattr(f, "__module__", "") == __name__ and not k.startswith("_") and k not in helpers
    }
