"""From raw folders to split tables, on recordings of operators whose care is known to the test alone."""

import json
import random

import pytest
from pyspark.sql import functions as F

from strandflow.operators import canonical, dataset, metrics, rollups, validate
from strandflow.profile import Profile
from strandflow.sources import layout, sessions, store
from strandflow.streaming import onboard

KEYS = list(canonical.KEYS)
P = Profile(n_joints=1, lower=(-9.0,), upper=(9.0,), min_steps=20, max_nan_fraction=0.3, hard_max_nan=0.4, hard_max_dropped=0.5, val_fraction=0.4, min_tier="silver")
OBS, ACT = ["q_0", "grip", "prev_act_q_0"], ["act_q_0"]
#: Share of rows without a joint, of the time that the arm stands still, and of steps at which the gripper flutters.
CARE = {"steady": (0.0, 0.0, 0.0), "hasty": (0.04, 0.35, 0.05), "careless": (0.12, 0.7, 0.4)}


def recording(care, rng, n=80):
    holes, idle, flutter = care
    lines, q, grip = ["timestamp,joint_0,gripper"], rng.uniform(-1, 1), 1.0
    for k in range(n):
        if k / n >= idle:
            q += 0.02 if k % 40 < 20 else -0.02
        grip = 1.0 - grip if rng.random() < flutter else grip
        lines.append(f"{k / 20:.3f},{'' if 0 < k < n - 1 and rng.random() < holes else round(q, 4)},{grip}")
    return "\n".join(lines) + "\n"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("corpus")
    rng = random.Random(4)
    names = []
    for operator, care in CARE.items():
        for k in range(4):
            name = f"{operator}_{k}"
            folder = base / "raw" / name
            folder.mkdir(parents=True)
            for e in range(3):
                (folder / f"e{e}_{'fail' if e == 2 and k == 0 else 'ok'}.csv").write_text(recording(care, rng, 60 + 10 * e))
            meta = {"session_id": name, "operator_id": operator, "robot_id": "r", "task_id": f"t{k % 2}", "control_hz": 20.0, "n_joints": 1, "recorded_at": "2024-01-01T00:00:00Z"}
            (folder / "session.json").write_text(json.dumps(meta))
            names.append(name)
    path = str(base / "store")
    told = [onboard.onboard(spark, str(base / "raw"), P, path, own).collect() for own in (names[:5], names[5:])]
    assert sum(r["episodes"] for part in told for r in part) == 36 and all(r["error"] is None for part in told for r in part)
    return base, path


def build(spark, path):
    steps, episodes = store.read(spark, path, "steps"), store.read(spark, path, "episodes")
    gated = dataset.gate(episodes.drop("score", "tier"), episodes, validate.validate(steps, P), P)
    return dataset.build(steps, gated, OBS, ACT, P, check=True, keep=lambda df: sessions.cut(df, "kept"))


def test_scores_rank_the_operators_by_their_care(spark, corpus):
    _, path = corpus
    everything = store.read(spark, path, "episodes").select("operator_id", "score", "tier", "flags").unionByName(store.read(spark, path, "quarantine").select("operator_id", "score", "tier", "flags"))
    rows = rollups.operator_rollup(everything).collect()
    assert [r["operator_id"] for r in rows] == ["careless", "hasty", "steady"] and all(0 <= r["mean"] <= 100 for r in rows)


def test_a_store_is_scored_anew_as_a_whole(spark, corpus):
    _, path = corpus
    before = {r["episode_id"]: r for r in store.read(spark, path, "episodes").collect()}
    n_steps, commits = store.read(spark, path, "steps").count(), len(store.commits(spark, path))
    onboard.rescore(spark, path, P)
    after = {r["episode_id"]: r for r in store.read(spark, path, "episodes").collect()}
    assert set(after) == set(before) and store.read(spark, path, "steps").count() == n_steps and len(store.commits(spark, path)) == commits + 1
    steps, episodes = store.read(spark, path, "steps"), store.read(spark, path, "episodes")
    want = metrics.duration_zabs(episodes.drop("duration_zabs"), ["task_id"]).collect()
    assert {r["episode_id"]: pytest.approx(r["duration_zabs"], rel=1e-5) for r in want} == {k: r["duration_zabs"] for k, r in after.items()}
    assert any(abs(after[k]["score"] - before[k]["score"]) > 1e-6 for k in after)  # durations meet the whole task now
    assert store.read(spark, path, "episodes", as_of=commits).count() == len(before) and steps.count() == n_steps
    gone = store.vacuum(spark, path)
    assert {g.split("/")[0] for g in gone} == {"episodes"} and {r["episode_id"]: r["score"] for r in store.read(spark, path, "episodes").collect()} == {k: r["score"] for k, r in after.items()}


def test_splits_exclusions_and_the_manifest(spark, corpus):
    base, path = corpus
    table, members = build(spark, path)
    made = dataset.manifest(table, members, OBS, ACT, P).first()
    sides = {s: {r["session_id"] for r in table.filter(F.col("split") == s).select("session_id").distinct().collect()} for s in ("train", "val")}
    assert sides["train"] and sides["val"] and not sides["train"] & sides["val"]
    rows = {r["episode_id"]: r for r in members.collect()}
    kept = {r["episode_id"] for r in table.select("episode_id").distinct().collect()}
    assert all(rows[e]["success"] and rows[e]["tier"] != "reject" for e in kept)
    failed = [e for e, r in rows.items() if not r["success"]]
    assert failed and all(rows[e]["exclude_reason"] in ("failed", "tier:reject") for e in failed)
    assert kept == {e for e, r in rows.items() if r["split"]} and {x["split"]: x["n_episodes"] for x in made["splits"]} == {s: sum(r["split"] == s for r in rows.values()) for s in sides}
    again = dataset.manifest(*build(spark, path), OBS, ACT, P).first()
    assert again["dataset_hash"] == made["dataset_hash"]
    train = table.filter("split = 'train'").agg(*(f(c).alias(f"{c}_{i}") for c in [*OBS, *ACT] for i, f in enumerate((F.avg, F.stddev_pop)))).first()
    for x in made["norm"]:
        assert x["mean"] == pytest.approx(train[f"{x['column']}_0"]) and x["std"] == pytest.approx(max(train[f"{x['column']}_1"], 1e-6))
    other = Profile(**{**P.__dict__, "seed": 3})
    assert dataset.manifest(table, members, OBS, ACT, other).first()["dataset_hash"] != made["dataset_hash"]
    version = sessions.write_dataset(table, dataset.manifest(table, members, OBS, ACT, P), str(base / "out"))
    assert version == 1 and store.read_snapshot(spark, str(base / "out"), "manifest").first()["dataset_hash"] == made["dataset_hash"]


def test_a_layout_by_episode_needs_no_exchange(spark, corpus):
    _, path = corpus
    steps, episodes = layout.lay_out_store(spark, path, "corpus", 4)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    per_step = metrics.step_metrics(steps, P)
    assert "Exchange" not in plan(per_step) and "Exchange" not in plan(validate.validate(steps, P))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = episodes.select(*KEYS, "duration_s").join(per_step, KEYS)
        assert "Exchange" not in plan(joined) and joined.count() == episodes.count()
        assert "Exchange" not in plan(dataset.content_hash(steps, P.channels()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    whole = store.read(spark, path, "steps")
    a, b = ({r["episode_id"]: r["tracking_error"] for r in metrics.step_metrics(df, P).collect()} for df in (steps, whole))
    assert a == {k: pytest.approx(v) for k, v in b.items()}
