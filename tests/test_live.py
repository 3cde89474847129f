"""A live stream is resampled as the whole recording would be, however it is cut up."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandflow.operators import resample
from strandflow.streaming import live, state

CHANNELS = ["q_0", "grip"]
START = 1_700_000_000_000_000
SCHEMA = "session_id string, episode_id string, ts timestamp, rate double, q_0 double, grip double"


def recordings(seed):
    """(session, episode, t_us, rate, q_0, grip) with jitter, gaps, holes, equal times, and lone samples."""
    rng = random.Random(seed)
    out = []
    for s, (rate, n) in enumerate(((20.0, 60), (30.0, 80), (7.3, 25), (20.0, 1), (20.0, 2), (50.0, 40))):
        t = START + rng.randint(0, 2_000_000)
        for k in range(n):
            hole = lambda v: None if rng.random() < 0.1 else v
            out.append((f"s{s}", f"e{s % 2}", t, rate, hole(rng.random()), hole(float(k % 2))))
            if rng.random() > 0.05:  # else the next one has the same time
                t += int(1_000_000 / rate * rng.uniform(0.2, 1.8)) + (700_000 if rng.random() < 0.06 else 0)
    return out


def written(folder, rows, number):
    body = "".join(
        json.dumps({"session_id": s, "episode_id": e, "ts": f"{np.datetime64(t, 'us')}Z", "rate": r, "q_0": q, "grip": g}) + "\n" for s, e, t, r, q, g in rows
    )
    file = folder / f"{number:04d}.json"
    file.write_text(body)
    os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))  # files are taken in this order


def streamed(spark, folder, tmp_path, name, late="2 seconds", idle_us=3_000_000):
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
    made = live.resample_stream(source, "ts", CHANNELS, 250_000, late, idle_us)
    return state.append_available(made, str(tmp_path / name), str(tmp_path / f"cp_{name}")).collect()


def close(a, b):
    return (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-9 * max(1, abs(a)))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_what_the_whole_gives(spark, tmp_path, seed):
    rows = recordings(seed)
    rng = random.Random(seed + 10)
    order = sorted(rows, key=lambda r: r[2] + rng.randint(0, 900_000))  # out of order, within the lateness
    folder = tmp_path / "in"
    folder.mkdir()
    cuts = sorted({0, len(order), *(rng.randint(0, len(order)) for _ in range(5))})
    for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
        written(folder, order[a:b], number)
    far = [("end", "e", START + 10**9, 20.0, 0.0, 0.0)]
    written(folder, far, 9998)
    written(folder, [("s0", "e0", START, 20.0, 9.0, 9.0)], 9999)  # older than the watermark: left out
    got = streamed(spark, folder, tmp_path, f"live{seed}")
    raw = spark.createDataFrame([(s, e, t, r, q, g) for s, e, t, r, q, g in rows], "session_id string, episode_id string, t_us long, rate double, q_0 double, grip double")
    whole = resample.resample(raw, CHANNELS, F.col("rate"), 250_000, CHANNELS)
    want = {(r["session_id"], r["step"]): r for r in whole.collect()}
    points = {(r["session_id"], r["step"]): r for r in got if r["step"] is not None}
    assert set(points) == set(want) and sum(r["step"] is not None for r in got) == len(want)
    for k, r in want.items():
        p = points[k]
        assert (p["t_us"], p["off_grid"], p["n_raw"]) == (r["t_us"], r["off_grid"], None) and all(close(p[c], r[c]) for c in CHANNELS), (k, p, r)
    ended = {r["session_id"]: r for r in got if r["step"] is None}
    for r in resample.episodes_of(whole).collect():
        e = ended.pop(r["session_id"])
        assert (e["n_raw"], e["n_steps"], e["duration_us"]) == (r["n_raw"], r["n_steps"], round(r["duration_s"] * 1e6))
        assert all(close(e[c], r[c]) for c in ("interp_fraction", "raw_dt_jitter", "raw_gap_fraction")), (e, r)
    assert not ended


def test_an_idle_episode_ends_and_another_begins(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    first, second = START, START + 20_000_000
    rows = [("a", "e", t0 + 50_000 * k, 20.0, float(k), None) for t0 in (first, second) for k in range(4)]
    written(folder, rows, 0)  # both in one micro-batch
    written(folder, [("b", "e", START + 10**8, 20.0, 0.0, 0.0)], 1)
    written(folder, [("b", "e", START + 2 * 10**8, 20.0, 0.0, 0.0)], 2)
    got = [r for r in streamed(spark, folder, tmp_path, "idle") if r["session_id"] == "a"]
    assert sorted((r["step"], r["q_0"]) for r in got if r["step"] is not None) == [(k, float(k)) for k in range(4) for _ in range(2)]
    assert [(r["n_raw"], r["n_steps"], r["duration_us"], r["raw_dt_jitter"]) for r in got if r["step"] is None] == [(4, 4, 150_000, 0.0)] * 2


def test_episodes_that_share_a_group_stay_apart(spark, tmp_path):
    rows = recordings(3)
    order = sorted(rows, key=lambda r: r[2])
    folder = tmp_path / "in"
    folder.mkdir()
    for number in range(3):
        written(folder, order[number * len(order) // 3 : (number + 1) * len(order) // 3], number)
    written(folder, [("end", "e", START + 10**9, 20.0, 0.0, 0.0)], 9998)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
    made = live.resample_stream(source, "ts", CHANNELS, 250_000, "1 second", 3_000_000, groups=1)
    got = state.append_available(made, str(tmp_path / "shared"), str(tmp_path / "cp_shared")).collect()
    raw = spark.createDataFrame(rows, "session_id string, episode_id string, t_us long, rate double, q_0 double, grip double")
    whole = resample.resample(raw, CHANNELS, F.col("rate"), 250_000, CHANNELS)
    want = {(r["session_id"], r["step"]): r for r in whole.collect()}
    points = [r for r in got if r["step"] is not None]
    assert sorted((r["session_id"], r["step"]) for r in points) == sorted(want)
    assert all(close(p[c], want[p["session_id"], p["step"]][c]) for p in points for c in CHANNELS)
    assert len(got) - len(points) == 6
