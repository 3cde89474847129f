"""How often the judgement of episodes and the evaluation go over the steps, and that it changes no result."""

import math

import numpy as np
from pyspark.sql import functions as F

from strandflow.operators import dataset, evaluate, metrics, validate
from strandflow.plans import driver_views as v
from strandflow.sources.layout import scratch_layout

SF = "/root/testdata/sf0.001"


def test_episodes_are_judged_in_one_pass_that_stores_no_steps(spark):
    before = {t.name for t in spark.catalog.listTables()}
    steps, episodes, quality, validation = v.judged(spark, SF)
    assert {t.name for t in spark.catalog.listTables()} == before
    apart = metrics.score(metrics.metrics(steps, episodes, v.PROFILE), v.PROFILE).select(*v.KEYS, F.round("score", 6).alias("score"), "tier")
    row = lambda df: sorted(tuple(r) for r in df.collect())
    assert row(quality.select(*v.KEYS, F.round("score", 6).alias("score"), "tier")) == row(apart)
    assert row(validation.select(*v.KEYS, "ok")) == row(validate.validate(steps, v.PROFILE).select(*v.KEYS, "ok"))


def test_drift_of_all_horizons_from_one_pass(spark):
    lengths, horizons = {"a": 12, "b": 3, "c": 1}, (1, 2, 5)
    rows = [("s", e, k, float(k * k % 7), float(k % 3) - 1) for e, n in lengths.items() for k in range(n)]
    table = spark.createDataFrame(rows, "session_id string, episode_id string, step int, q_0 double, act_q_0 double")
    found = evaluate.persistence_drift(table, ["q_0"], ["act_q_0"], horizons)
    got = {r["horizon"]: (r["drift"], r["n_rollouts"]) for r in found.collect()}
    for n in horizons:
        off = []
        for e, length in lengths.items():
            own = [r for r in rows if r[1] == e]
            for at in {int(x * (length - n - 1) / 4) for x in range(5)} if length > n else ():
                off.append(abs(own[at][3] + n * own[max(at - 1, 0)][4] - own[at + n][3]))
        assert got[n][1] == len(off) and math.isclose(got[n][0], sum(off) / len(off))


def test_an_episode_is_hashed_once_in_a_build(spark):
    stored = []

    def keep(df):
        stored.append(df._jdf.queryExecution().optimizedPlan().toString())
        return v.keep(df)

    made = v.wide(spark, SF)
    once = dataset.content_hash(v.steps(spark, SF, made), v.PROFILE.channels())._jdf.queryExecution().optimizedPlan().toString().count("md5(")
    dataset.build(v.steps(spark, SF, made), v.keep(v.gated(spark, SF, made)), v.OBS, v.ACT, v.PROFILE, keep=keep)
    assert once and [p.count("md5(") for p in stored] == [once] + [0] * (len(stored) - 1)


def test_steps_are_dealt_into_as_many_tasks_as_buckets(spark, monkeypatch):
    laid_out = []
    monkeypatch.setattr(v, "scratch_layout", lambda df, name: laid_out.append(df) or scratch_layout(df, name))
    v.built(spark, SF)
    plan = laid_out[0]._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and laid_out[0].rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_metrics_and_rules_look_at_rows_in_order_through_one_window(spark):
    made = v.wide(spark, SF).limit(0).localCheckpoint()
    windows = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Window [")
    assert windows(metrics.with_neighbours(made, v.PROFILE, validate.intervals())) == windows(metrics.with_neighbours(made, v.PROFILE))


def test_whole_numbers_are_those_of_round(spark):
    xs = [0.0, -0.0, 0.49999999999999994, 0.5, -0.5, 1.5, 2.5, -2.5, 1e6 / 3, -1e6 / 3, 4503599627370495.5, 12345678.499999998, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select(dataset.nearest(F.col("x")).alias("n"), F.round("x").cast("long").alias("r"))
    assert all(r["n"] == r["r"] for r in df.collect()) and "round(" not in dataset.digest_sums(
        spark.range(1).selectExpr("'s' as session_id", "'e' as episode_id", "0 as step", "0L as t_us", "0.5D as x"), ["x"]
    )._jdf.queryExecution().optimizedPlan().toString()


def test_held_out_windows_become_sums_within_tasks(spark):
    model = {"obs": ["a"], "act": ["u"], "obs_mean": np.zeros(1), "obs_std": np.ones(1), "act_mean": np.zeros(1), "act_std": np.ones(1)}
    model["weights"] = {1.0: np.array([[1.0, 0.0], [0.0, 0.5]]), 2.0: np.array([[0.5, 0.0], [0.0, 0.0]])}
    windows = spark.createDataFrame([([2.0], [[2.05], [1.5]]), ([4.0], [[3.0], [None]])], "obs array<double>, actions array<array<double>>")
    history = evaluate.fit_history(windows, model)
    assert "explode" not in history._jdf.queryExecution().optimizedPlan().toString()
    got = {r["ridge"]: (r["chunk_mae"], r["loss"], r["chosen"]) for r in history.collect()}
    off = {1.0: [0.05, 1.0, 1.0], 2.0: [1.05, 1.5, 1.0]}
    for ridge, e in off.items():
        loss = [x * x / 0.2 if x < 0.1 else x - 0.05 for x in e]
        assert math.isclose(got[ridge][0], sum(e) / 3) and math.isclose(got[ridge][1], sum(loss) / 3) and got[ridge][2] == (ridge == 1.0)
