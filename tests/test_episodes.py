"""One defect per test on a hand-built clean episode, as the operators must see it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandflow.operators import canonical, dataset, evaluate, metrics, resample, rollups, validate
from strandflow.profile import Profile

P = Profile()
SPEED = [0.004, 0.003, 0.005, 0.002, 0.006, 0.001, 0.003]  # of each joint, there and back


def clean(n=150, turn=40):
    """Joints that move at a constant speed from a place inside their limits and turn back every `turn` steps; the gripper closes once."""
    middle = [0.4 * lo + 0.6 * up for lo, up in zip(P.lower, P.upper, strict=True)]
    there = [min(k % (2 * turn), 2 * turn - k % (2 * turn)) for k in range(n)]
    rows = []
    for k in range(n):
        row = {
            "session_id": "s",
            "episode_id": "s__e",
            "step": k,
            "t_us": k * P.dt_us,
            "grip": 0.9 if 3 * k < n else 0.1,
            "act_grip": 0.2,
            "ee_x": 0.3,
            "ee_y": -0.2,
            "ee_z": 0.5,
            "ee_qx": 0.6,
            "ee_qy": 0.0,
            "ee_qz": 0.8,
            "ee_qw": 0.0,
        }
        ahead = there[k + 1] if k + 1 < n else there[k]
        row |= {f"q_{j}": middle[j] + v * there[k] for j, v in enumerate(SPEED)} | {
            f"act_q_{j}": v * (ahead - there[k]) for j, v in enumerate(SPEED)
        }
        rows.append(row)
    return rows


def steps(spark, rows):
    names = ["session_id", "episode_id", "step", "t_us", *(c for c in P.channels() if not c.startswith("dq"))]
    kinds = {"session_id": "string", "episode_id": "string", "step": "int", "t_us": "long"}
    df = spark.createDataFrame([[r.get(c) for c in names] for r in rows], ", ".join(f"{c} {kinds.get(c, 'double')}" for c in names))
    return canonical.coerce(df, P)


def measured(spark, rows):
    return metrics.step_metrics(steps(spark, rows), P).first()


def codes(spark, rows):
    r = validate.validate(steps(spark, rows), P).first()
    return r["ok"], {i["code"] for i in r["issues"]}


def test_clean_episode_passes(spark):
    assert codes(spark, clean()) == (True, set())
    m = measured(spark, clean())
    assert m["dropped"] == 0 and m["nan_fraction"] == 0 and m["grip_changes"] == 1 and m["tracking_error"] < 1e-12 and m["idle_fraction"] < 0.05 and m["action_saturation"] == 0


def test_dropped_frames(spark):
    rows = clean()
    for r in rows[::8]:
        r["q_0"] = None
    assert measured(spark, rows)["dropped"] >= 0.12


def test_gripper_noise_and_chatter(spark):
    rows = clean()
    for k, r in enumerate(rows):
        r["grip"] = 0.5 + 0.03 * (-1) ** k
    assert measured(spark, rows)["grip_changes"] == 0
    for k, r in enumerate(rows):
        r["grip"] = float(k % 2)
    assert measured(spark, rows)["grip_changes"] == 149


def test_jerk_spike_and_saturation(spark):
    rows = clean()
    for k, r in enumerate(rows):
        r["act_q_0"] += 1e-4 * (k % 3)
    calm = measured(spark, rows)["jerk_spike_rate"]
    rows[100]["act_q_0"] = 0.5
    assert measured(spark, rows)["jerk_spike_rate"] > calm
    for r in rows:
        r["act_q_0"] = P.action_limit
    assert measured(spark, rows)["action_saturation"] == 1


@pytest.mark.parametrize(
    "defect, code, ok",
    [
        ("short", "too_short", False),
        ("time", "time_not_increasing", False),
        ("unit", "joint_limit_violation", False),
        ("quaternion", "quaternion_not_unit", True),
        ("absent", "columns_absent", True),
        ("holes", "excess_nan", False),
    ],
)
def test_validation_defects(spark, defect, code, ok):
    rows = clean()
    if defect == "short":
        rows = rows[:5]
    elif defect == "time":
        rows[50]["t_us"] = rows[10]["t_us"]
    elif defect == "unit":
        rows[20]["q_0"] = 99.0
    for k, r in enumerate(rows):
        if defect == "quaternion":
            r["ee_qw"] = 5.0
        elif defect == "absent":
            r["ee_x"] = None
        elif defect == "holes" and k % 2:
            r["q_1"] = float("nan")
    got = codes(spark, rows)
    assert code in got[1] and got[0] == ok


def test_gap_is_not_bridged(spark):
    times = [k * 50_000 for k in range(20)] + [3_000_000 + k * 50_000 for k in range(20)]
    raw = spark.createDataFrame(
        [("s", "e", t, float(i)) for i, t in enumerate(times)],
        "session_id string, episode_id string, t_us long, q_0 double",
    )
    grid = {r["t_us"]: r["q_0"] for r in resample.resample(raw, ["q_0"], 20.0, 250_000).collect()}
    assert len(grid) == 80 and grid[950_000] == 19 and grid[1_000_000] is None and grid[2_950_000] is None and grid[3_000_000] == 20
    timing = resample.raw_timing(raw, 250_000).first()
    assert timing["raw_gap_fraction"] == pytest.approx(2.05 / 3.95)


def test_late_steps(spark):
    times = [0, 50_000, 100_000, 300_000, 300_001, 300_002]
    raw = spark.createDataFrame([("s", "e", t) for t in times], "session_id string, episode_id string, t_us long")
    assert resample.late_steps(raw, 50_000).first()["late_steps"] == 3


def test_names():
    assert [
        canonical.canonical_name(c) for c in (" TimeStamp", "joint_0", "jpos3", "vel_2", "cmd_1", "Target4", "gripper_cmd", "WeirdSensor")
    ] == ["t", "q_0", "q_3", "dq_2", "act_q_1", "act_q_4", "act_grip", "weirdsensor"]
    with pytest.raises(ValueError):
        dataset.select_columns(["nope"], P)


def test_split_is_stable_and_fair(spark):
    ids = spark.range(4000).selectExpr("cast(id as string) as session_id")
    p = Profile(val_fraction=0.25)
    share = ids.select((dataset.assign_split(ids["session_id"], p) == "val").cast("double").alias("v")).groupBy().avg("v").first()[0]
    assert abs(share - 0.25) < 0.02


def test_chunks_never_cross_episodes(spark):
    rows = [("s", e, k, k * 10, float(k)) for e, n in (("a", 5), ("b", 2)) for k in range(n)]
    w = dataset.action_chunks(
        spark.createDataFrame(rows, "session_id string, episode_id string, step int, t_us long, a double"),
        ["a"],
        3,
    ).collect()
    assert {(r["episode_id"], r["window"]) for r in w} == {("a", 0), ("a", 1), ("a", 2)}
    assert next(r for r in w if r["window"] == 0)["prev_action"] == [0.0]


def test_norm_stats_and_duplicates(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (3.0, 5.0)], "a double, b double")
    s = {r["column"]: (r["mean"], r["std"]) for r in dataset.norm_stats(df, ["a", "b"]).collect()}
    assert s["a"][0] == 2 and s["b"] == (5.0, 1e-6)
    e = spark.createDataFrame(
        [("1", "a", "h"), ("2", "b", "h"), ("3", "c", ""), ("4", "d", "")],
        "session_id string, episode_id string, content_hash string",
    )
    assert {r["session_id"] for r in dataset.dedupe(e).filter("duplicate").collect()} == {"2"}


def test_idle_and_tracking(spark):
    rows = clean()
    for r in rows[60:]:
        r |= {f"q_{j}": rows[59][f"q_{j}"] for j in range(7)}
    got = measured(spark, rows)
    assert got["idle_fraction"] > 0.5 and got["tracking_error"] > 10 * measured(spark, clean())["tracking_error"]


def test_duration_outlier_and_small_populations(spark):
    rows = [("t", str(i), 8.0 + 0.1 * i) for i in range(9)] + [("t", "x", 30.0), ("u", "y", 1.0), ("u", "z", 99.0), (None, "n", 2.0)]
    got = {
        r["episode_id"]: r["duration_zabs"] for r in metrics.duration_zabs(
            spark.createDataFrame(rows, "task_id string, episode_id string, duration_s double"),
            ["task_id"],
        ).collect()
    }
    values = np.array([r[2] for r in rows if r[0] == "t"])
    scale = 1.4826 * np.median(np.abs(values - np.median(values)))
    assert got["x"] == pytest.approx((30 - np.median(values)) / scale) and got["x"] > 5
    assert got["y"] == got["z"] == got["n"] == 0 and len(got) == 13


def test_penalties_clamp_and_hard_rejects_override(spark):
    value = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,), (9.0,)], "x double")
    anchor = metrics.Anchor(1, 0, 1, 1)
    assert [r[0] for r in value.select(metrics.penalty(F.col("x"), anchor)).collect()] == [0, 0, 0.5, 1, 1]
    assert [r[0] for r in value.select(metrics.penalty(F.col("x"), metrics.Anchor(1, 0.5, 0.5, 1))).collect()] == [0, 0, 0, 1, 1]
    fine = {m: 0.0 for m in P.anchors} | {"n_steps": 100}
    rows = [fine, fine | {"nan_fraction": 0.2}, fine | {"dropped_frame_rate": 0.3}, fine | {"n_steps": 5}, fine | {"timing_jitter": None}]
    table = spark.createDataFrame(
        [[r[c] for c in fine] for r in rows],
        ", ".join(f"{c} {'int' if c == 'n_steps' else 'double'}" for c in fine),
    )
    got = [(r["tier"], list(r["hard_reject_reasons"]), r["score"]) for r in metrics.score(table, P).collect()]
    assert [g[0] for g in got] == ["gold", "reject", "reject", "reject", "gold"] and got[3][1] == ["n_steps"] and got[1][2] > P.silver


def test_every_rule_and_flag_has_something_to_find(spark):
    from strandflow.plans import driver_views as v

    _, _, quality, validation = v.judged(spark, "/root/testdata/sf0.01")
    found = {r["code"] for r in rollups.issue_counts(validation).collect()}
    assert found == {
        "too_short",
        "too_long",
        "nonfinite_time",
        "time_not_increasing",
        "dt_mismatch",
        "columns_absent",
        "excess_nan",
        "joint_limit_violation",
        "joint_limit_grazed",
        "quaternion_not_unit",
        "gripper_out_of_range",
        "action_over_limit",
    }
    assert {r["flag"] for r in rollups.flag_counts(quality).collect()} == set(v.PROFILE.anchors)
    assert {r["tier"] for r in rollups.tier_counts(quality).filter("n > 0").collect()} == {"gold", "silver", "reject"}


def test_missing_columns_are_told_from_the_header():
    assert validate.missing_columns(["t_us", *P.channels()], P) == []
    assert validate.missing_columns(["t_us", *(c for c in P.channels() if c not in ("q_3", "grip"))], P) == ["grip", "q_3"]


def test_time_without_a_value(spark):
    rows = clean()
    df = steps(spark, rows).withColumn("t_us", F.when(F.col("step") == 7, None).otherwise(F.col("t_us")))
    (got,) = validate.validate(df, P).collect()
    assert not got["ok"] and "nonfinite_time" in {i["code"] for i in got["issues"]}
    kept, failed = validate.quarantine(df, validate.validate(df, P))
    assert kept.count() == 0 and failed.count() == 150 and failed.first()["issues"]


@pytest.mark.parametrize(
    "hz, times",
    [(30.0, [0, 40_000, 70_000, 160_000]), (20.0, [0, 50_000, 125_000]), (29.97, [5, 100_005]), (20.0, [3])],
)
def test_grid_follows_the_rate_of_the_session(spark, hz, times):
    rows = [("s", "e", t, float(t * t % 1000), hz) for t in times]
    raw = spark.createDataFrame(rows, "session_id string, episode_id string, t_us long, q_0 double, hz double")
    got = [
        (
            r["step"],
            r["t_us"],
            r["q_0"],
            r["off_grid"],
        ) for r in resample.resample(raw, ["q_0"], F.col("hz"), 10**9).orderBy("step").collect()
    ]
    t, want, k = np.array(times), [], 0
    while (g := int(np.floor(k * 1e6 / hz + 1e-3))) < times[-1] - times[0] + 5e5 / hz:
        near = np.abs(t - times[0] - g).min()
        want.append((k, g, pytest.approx(float(np.interp(g + times[0], t, [r[3] for r in rows]))), bool(near > 5e5 / hz)))
        k += 1
    assert got == want


def test_pose_needs_six_joints(spark):
    q = [0.3, -0.4, 0.0, 0.7, 0.0, 1.1]
    df = spark.createDataFrame([tuple(q)], ", ".join(f"q_{i} double" for i in range(6)))
    got = canonical.with_pose(df).first()
    assert np.allclose(
        [got["ee_x"], got["ee_y"], got["ee_z"]],
        [0.30 + 0.25 * np.sin(0.3) * np.cos(-0.4), 0.25 * np.sin(-0.4) * np.sin(0.3), 0.40 + 0.20 * np.cos(0.3)],
    )
    assert sum(
        got[c] ** 2 for c in ("ee_qx", "ee_qy", "ee_qz", "ee_qw")
    ) == pytest.approx(1) and got["ee_qx"] == pytest.approx(np.sin(0.55))
    with pytest.raises(ValueError, match="6 joints"):
        canonical.with_pose(df.drop("q_5"))


def test_orphans_are_kept_while_their_folder_is_there(spark):
    store, declared, folders = (spark.createDataFrame([(x,) for x in ids], "session_id string") for ids in ("abc", "a", "b"))
    assert {
        r["session_id"]: r["keep"] for r in rollups.prune_orphans(store, declared, folders).collect()
    } == {"a": True, "b": True, "c": False}


def test_gate_falls_back_to_the_stored_tier(spark):
    episodes = spark.createDataFrame(
        [
            ("s", x, t, ok) for x, t, ok in (
                ("a", "gold", True),
                ("b", None, True),
                ("c", "reject", True),
                ("d", "gold", False),
                ("e", "reject", True),
                ("f", "gold", True),
            )
        ],
        "session_id string, episode_id string, quality_tier string, success boolean",
    )
    quality = spark.createDataFrame([("s", "e", "silver", 70.0)], "session_id string, episode_id string, tier string, score double")
    validation = spark.createDataFrame([("s", "f", False)], "session_id string, episode_id string, ok boolean")
    got = {r["episode_id"]: r["exclude_reason"] for r in dataset.gate(episodes, quality, validation, P).collect()}
    assert got == {"a": None, "b": "unscored", "c": "tier:reject", "d": "failed", "e": None, "f": "invalid"}


def _policy_fixture(spark):
    rng = np.random.RandomState(3)
    obs, act, rows = ["q_0", "prev_act_q_0", "grip"], ["act_q_0"], []
    for e in range(6):
        a = np.convolve(rng.randn(30), np.ones(4) / 4, "same") * 0.1
        q = np.cumsum(np.append(0, a[:-1])) + rng.randn()
        rows += [
            (
                "s",
                str(e),
                "val" if e > 3 else "train",
                k,
                k * 50_000,
                float(q[k]),
                float(a[max(k - 1, 0)]),
                float(rng.rand()),
                float(a[k]),
            ) for k in range(30)
        ]
    table = spark.createDataFrame(
        rows,
        "session_id string, episode_id string, split string, step int, t_us long, q_0 double, prev_act_q_0 double, grip double, act_q_0 double",
    )
    return obs, act, table, dataset.action_chunks(table, act, 3, obs)


def test_policy_is_fitted_on_normalised_windows_and_chosen(spark):
    obs, act, table, windows = _policy_fixture(spark)
    stats = {r["column"]: (r["mean"], r["std"]) for r in dataset.norm_stats(table.filter("split = 'train'"), [*obs, *act]).collect()}
    model = evaluate.fit_policy(windows.filter("split = 'train'"), stats, obs, act, (1e-3, 1.0, 1e3))
    rows = windows.filter("split = 'train'").collect()
    x, y = np.array([r["obs"] for r in rows]), np.array([r["actions"] for r in rows]).reshape(len(rows), -1)
    z = np.hstack([(x - [stats[c][0] for c in obs]) / [stats[c][1] for c in obs], np.ones((len(x), 1))])
    mean, std = stats["act_q_0"]
    for ridge, weights in model["weights"].items():
        want = np.linalg.solve(z.T @ z + ridge * np.diag([1, 1, 1, 0]), z.T @ ((y - mean) / std))
        assert np.allclose(weights, want, atol=1e-8)
    history = evaluate.fit_history(windows.filter("split = 'val'"), model).collect()
    for r in history:
        p = evaluate.predict(windows.filter("split = 'val'"), model, model["weights"][r["ridge"]]).collect()
        off = np.abs(np.array([v["actions"] for v in p]) - np.array([v["predicted"] for v in p]))
        assert r["chunk_mae"] == pytest.approx(off.mean()) and r["loss"] == pytest.approx(
            np.where(off < 0.1, off**2 / 0.2, off - 0.05).mean()
        )
    assert [r["chosen"] for r in history] == [r["loss"] == min(h["loss"] for h in history) for r in history]
    evaluate.check_layout(model["obs"], obs)
    with pytest.raises(ValueError):
        evaluate.check_layout(model["obs"], obs[::-1])
    assert evaluate.hash_note("a", "a") is None and "b" in evaluate.hash_note("a", "b")


def test_refitted_policy_minimises_the_robust_loss(spark):
    rng = np.random.default_rng(7)
    n, beta = 600, 0.1
    x = rng.standard_normal((n, 2))
    y = np.stack([x @ [1.0, -2.0] + 0.5, x @ [0.3, 0.1]], axis=1) + 0.02 * rng.standard_normal((n, 2))
    y[::9] += rng.choice([-6.0, 9.0], (len(y[::9]), 2))  # outliers pull the squares away
    rows = [(a.tolist(), [[float(c)] for c in b]) for a, b in zip(x, y, strict=True)]
    windows = spark.createDataFrame(rows, "obs array<double>, actions array<array<double>>").repartition(3)
    stats = {"a": (0.2, 1.5), "b": (0.0, 0.5), "u": (0.1, 2.0)}
    ridge = evaluate.fit_policy(windows, stats, ["a", "b"], ["u"], (1e-6, 5.0))
    model = evaluate.refit(windows, ridge, beta, rounds=40, tolerance=1e-9)
    z = np.hstack([(x - [0.2, 0.0]) / [1.5, 0.5], np.ones((n, 1))])
    t = (y - 0.1) / 2.0
    loss = lambda w: np.where((e := np.abs(t - z @ w)) < beta, e * e / (2 * beta), e - beta / 2).sum()
    free = np.array([[1.0], [1.0], [0.0]])
    for r in (1e-6, 5.0):
        w = ridge["weights"][r].copy()
        for _ in range(len(model["losses"][r])):  # the same, restated
            u = 1 / np.maximum(np.abs(t - z @ w), beta)
            w = np.stack([np.linalg.solve((z * u[:, [o]]).T @ z + r / beta * np.diag([1, 1, 0]), z.T @ (u[:, o] * t[:, o])) for o in range(2)], axis=1)
        assert np.allclose(model["weights"][r], w, atol=1e-8)
        whole = lambda v, r=r: loss(v) + r / beta / 2 * (v**2 * free).sum()
        assert model["losses"][r][0] == pytest.approx(whole(ridge["weights"][r])) and (np.diff(model["losses"][r]) <= 1e-9).all()
        best = whole(model["weights"][r])
        assert all(whole(model["weights"][r] + 1e-3 * rng.standard_normal(w.shape)) >= best - 1e-6 for _ in range(20))
    assert loss(model["weights"][1e-6]) < 0.9 * loss(ridge["weights"][1e-6])
    assert np.allclose(model["weights"][1e-6] * 2.0 / [[1.5], [0.5], [1.0]], [[1.0, 0.3], [-2.0, 0.1], [0.2, 0.06 - 0.1]], atol=5) and len(model["losses"][1e-6]) > 3


def test_bootstrap_draws_whole_groups(spark):
    rng = np.random.default_rng(3)
    groups = 100_000
    s = rng.gamma(2.0, 1.0, groups)
    df = spark.range(groups).select("id", (F.sin(F.col("id") * 12.9898) * 3 + F.when(F.col("id") % 10 == 0, 5).otherwise(0)).alias("x"))
    x = np.array([r["x"] for r in df.orderBy("id").collect()])
    row = evaluate.bootstrap(df, ["id"], "x", 400, 11).first()
    deviation = x.std() / np.sqrt(groups)
    assert abs(row["mean"] - x.mean()) < 5 * deviation / np.sqrt(400) and abs(row["deviation"] / deviation - 1) < 0.15
    assert row["low"] < x.mean() < row["high"] and abs((row["high"] - row["low"]) / (2 * 1.96 * deviation) - 1) < 0.2
    assert row == evaluate.bootstrap(df.repartition(7), ["id"], "x", 400, 11).first()
    few = spark.createDataFrame([("a", k, 1.0) for k in range(3)] + [("b", 0, 5.0), (None, 1, 2.0), ("c", 1, None)], "g string, k int, x double")
    row, n, v = evaluate.bootstrap(few, ["g"], "x", 3000, 2).first(), np.array([3, 1, 1, 0]), np.array([3.0, 5.0, 2.0, 0.0])
    picks = rng.integers(0, 4, (3000, 4))
    total = n[picks].sum(1)
    want = (v[picks].sum(1)[total > 0] / total[total > 0]).std()
    assert abs(row["deviation"] / want - 1) < 0.1 and s.mean() > 0
    assert evaluate.bootstrap(few.filter("g = 'a'"), ["g"], "x", 50, 2).first()["low"] is None
    assert evaluate.bootstrap(few.limit(0), ["g"], "x", 50, 2).first()["low"] is None


def test_appended_steps_extend_a_hash(spark):
    df = spark.range(50).select(F.lit("s").alias("session_id"), (F.col("id") % 2).cast("string").alias("episode_id"), F.col("id").alias("step"), (F.col("id") * 7).alias("t_us"), F.when(F.col("id") % 5 > 0, F.col("id") * 0.1).alias("x"))
    whole = {r["episode_id"]: r["content_hash"] for r in dataset.content_hash(df, ["x"]).collect()}
    first, rest = (dataset.digest_sums(df.filter(c), ["x"]) for c in ("step < 31", "step >= 31"))
    assert {r["episode_id"]: r["content_hash"] for r in dataset.hash_of(dataset.add_sums(first, rest)).collect()} == whole
    import hashlib

    for e, own in whole.items():
        lines = [f"{k},{7 * k},{round(k * 0.1 * 1e6) if k % 5 else '-'}" for k in range(50) if k % 2 == int(e)]
        assert own == f"{sum(int(hashlib.md5(x.encode()).hexdigest(), 16) for x in lines) % 2**128:032x}"
    moved = df.withColumn("t_us", F.when(F.col("step") == 4, F.lit(None)).otherwise(F.col("t_us")))
    assert {r["episode_id"]: r["content_hash"] == whole[r["episode_id"]] for r in dataset.content_hash(moved, ["x"]).collect()} == {"0": False, "1": True}


def test_rollouts_against_single_steps(spark):
    obs, act, table, windows = _policy_fixture(spark)
    stats = {r["column"]: (r["mean"], r["std"]) for r in dataset.norm_stats(table, [*obs, *act]).collect()}
    model = evaluate.fit_policy(windows, stats, obs, act, (1.0,))
    weights, data = model["weights"][1.0], {}
    for r in table.orderBy("episode_id", "step").collect():
        data.setdefault(r["episode_id"], []).append([r[c] for c in obs])
    for n in (1, 4, 40):
        want = {}
        for e, own in data.items():
            for k in range(5):
                start = int(np.floor(k * (len(own) - n - 1) / 4))
                if len(own) > n:
                    state = list(own[start])
                    for step in range(n):
                        if step % 3 == 0:
                            z = [*((s - stats[c][0]) / stats[c][1] for s, c in zip(state, obs, strict=True)), 1.0]
                            chunk = np.array(z) @ weights * stats["act_q_0"][1] + stats["act_q_0"][0]
                        state[0] += chunk[step % 3]
                        state[1] = chunk[step % 3]
                    want[e, start] = abs(state[0] - own[start + n][0])
        got = {(r["episode_id"], r["start"]): r["drift"] for r in evaluate.rollout_drift(table, model, weights, n, 3).collect()}
        assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}


def test_skill_and_curve_use_the_right_baselines(spark):
    # persistence is best over the chunk, zero at the next step
    rows = [("s", "e", w, k, 0, 1.0, z, 5.0, q, 0.7) for w in range(3) for k, (z, q) in enumerate([(0.9, 0.6), (0.0, 0.8)])]
    p = spark.createDataFrame(
        rows,
        "session_id string, episode_id string, window int, k int, d int, truth double, zero double, train_mean double, persistence double, policy double",
    )
    got = evaluate.skill(evaluate.baseline_errors(p, (*evaluate.PREDICTORS, "policy")), "policy").first()
    assert got["best_baseline"] == "persistence" and got["chunk_skill"] == pytest.approx(1 - 0.3 / 0.3) and got["next_step_skill"] == pytest.approx(1 - 0.3 / 0.1)
    curve = {r["k"]: (r["best"], r["winner"], r["loses_everywhere"]) for r in evaluate.offset_curve(p, "policy").collect()}
    assert curve == {0: (pytest.approx(0.4), "policy", False), 1: (pytest.approx(0.2), "persistence", False)}


def test_hashes_and_duplicates_do_not_depend_on_the_layout(spark):
    rows = [(s, "e", k, k * 10, 0.5 * k + (s == "c") * 1e-3) for s in "abc" for k in range(5)]
    df = spark.createDataFrame(rows, "session_id string, episode_id string, step int, t_us long, x double")
    one, two = (
        {
            r["session_id"]: r["content_hash"] for r in dataset.content_hash(x, ["x"]).collect()
        } for x in (df, df.orderBy(F.rand(3)).repartition(7))
    )
    assert one == two and one["a"] == one["b"] != one["c"]
    e = spark.createDataFrame(
        [(s, "e", h) for s, h in (*one.items(), ("d", None), ("f", None))],
        "session_id string, episode_id string, content_hash string",
    )
    assert {r["session_id"] for r in dataset.dedupe(e).filter("duplicate").collect()} == {"b"}
