"""Raw session folders, the store and the incremental loop."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from strandflow.operators import dataset
from strandflow.profile import Profile
from strandflow.sources import session_files, sessions, store
from strandflow.streaming import loop, onboard

SMALL = Profile(n_joints=1, lower=(-9.0,), upper=(9.0,), min_steps=3, hard_min_steps=3, hard_max_nan=0.5)


def session(root, name, n_joints=1, text=None, files=(), hz=20.0, declared=None):
    d = root / name
    d.mkdir(parents=True, exist_ok=True)
    meta = {
        "session_id": declared or name,
        "operator_id": "o",
        "robot_id": "r",
        "task_id": "t",
        "recorded_at": "2024-01-01T00:00:00Z",
        "control_hz": hz,
        "n_joints": n_joints,
    }
    for f, body in files:
        (d / f).write_text(body)
    (d / "session.json").write_text(text or json.dumps(meta))


def recording(n=20, jump=0.0):
    return "timestamp,joint_0,gripper\n" + "".join(f"{k / 20},{0.01 * (k % 7) + (jump if k == 5 else 0)},1\n" for k in range(n))


def test_mixed_headers_and_bad_metadata(spark, tmp_path):
    raw = tmp_path / "raw"
    session(
        raw,
        "a",
        files=[
            ("episode_0_ok.csv", "timestamp,joint_0\n0.0,1.5\n"),
            ("episode_1_FAIL.csv", "joint_0,Odd,timestamp\n2.5,x,1.0\n"),
            ("notes.txt", "x"),
        ],
    )
    session(raw, "b", n_joints=4, files=[("episode_0.jsonl", '{"secs": 3.0, "jpos0": 4.5}\n\n{"secs": 3.5, "jpos0": "x"}')])
    session(raw, "c", text="{broken", files=[("episode_0.NDJSON", '{"timestamp": 1.0, "q_0": 1.0}\n')])
    session(raw, "d")
    (raw / "e").mkdir()
    rows, errors, skipped = sessions.read_episodes(spark, str(raw), 1)
    got = {(r["directory"], r["stem"], r["t"]): (r["q_0"], (r["extra"] or {}).get("odd"), r["success"]) for r in rows.collect()}
    assert got == {
        ("a", "episode_0_ok", 0.0): (1.5, None, True),
        ("a", "episode_1_FAIL", 1.0): (2.5, "x", False),
        ("b", "episode_0", 3.0): (4.5, None, True),
        ("b", "episode_0", 3.5): (None, None, True),
        ("c", "episode_0", 1.0): (1.0, None, True),
    }
    assert {(r["directory"], r["reason"]) for r in skipped.collect()} == {("a", "unsupported suffix")}
    assert {(r["directory"], r["reason"]) for r in errors.collect()} == {("d", "no episode files"), ("e", "no episode files")}
    reasons = {r["directory"]: r["reason"] for r in sessions.read_sessions(spark, str(raw), 1).collect()}
    assert reasons == {"a": None, "b": "n_joints", "c": "unreadable", "d": None, "e": "no session.json"}


def test_parquet_layouts_are_all_read(spark, tmp_path):
    raw = tmp_path / "raw"
    for name, columns in (
        ("a", "1.0D as timestamp, 2.0D as joint_0"),
        ("b", "3 as secs, 4.0D as jpos0"),
        ("c", "5.0D as secs, 6 as joint_0"),
        ("d", "'7.5' as secs, array(1) as WeirdSensor, 8L as joint_0"),
    ):
        session(raw, name)
        spark.sql(f"select {columns}").coalesce(1).write.parquet(str(tmp_path / name))
        (file,) = (tmp_path / name).glob("*.parquet")
        shutil.copy(file, raw / name / "episode_0.parquet")
    rows, errors, _ = sessions.read_episodes(spark, str(raw), 1)
    assert {(r["directory"], r["t"], r["q_0"]) for r in rows.collect()} == {("a", 1.0, 2.0), ("b", 3.0, 4.0), ("c", 5.0, 6.0), ("d", 7.5, 8.0)}
    assert errors.count() == 0


BAD = {
    "two.csv": ("t,timestamp,q_0\n1,2,3\n", "several columns are t"),
    "two.jsonl": ('{"t": 1, "q_0": 2}\n{"time": 2, "q_0": 3}\n', "several columns are t"),
    "again.csv": ("t,q_0,q_0\n1,2,3\n", "several columns are q_0"),
    "clock.csv": ("clock,q_0\n1,2\n", "no recognisable time column"),
    "clock.jsonl": ('{"clock": 1, "q_0": 2}\n', "no recognisable time column"),
    "foo.csv": ("timestamp,foo\n1,2\n", "missing required column(s): q_0"),
    "empty.csv": ("", "empty file"),
    "empty.jsonl": ("", "no recognisable time column"),
    "header.csv": ("t,q_0\n", "no row with a time"),
    "untimed.csv": ("t,q_0\nx,1\n,2\n", "no row with a time"),
    "ragged.csv": ("t,q_0\n1,2\n3,4,5\n", "line 3 has more cells than the header"),
    "broken.jsonl": ('{"t": 1, "q_0": 2}\n{"t": ', "unreadable: JSONDecodeError"),
    "list.jsonl": ("[1, 2]\n", "line 1 is no object"),
    "broken.parquet": ("PAR1 no parquet", "unreadable: ArrowInvalid"),
    "latin.csv": (b"t,q_0\n1,2\n\xff\xfe,3\n", "unreadable: UnicodeDecodeError"),
}


def test_each_bad_file_is_an_error_of_its_own(spark, tmp_path):
    raw = tmp_path / "raw"
    session(raw, "good", files=[("e_ok.csv", recording())])
    for name, (body, _) in BAD.items():
        session(raw, name.replace(".", "_"))
        (raw / name.replace(".", "_") / name).write_bytes(body if isinstance(body, bytes) else body.encode())
    rows, errors, _ = sessions.read_episodes(spark, str(raw), 1)
    got = {r["source_file"].rpartition("/")[2]: r["reason"] for r in errors.collect()}
    assert set(got) == set(BAD) and all(got[k].startswith(said) for k, (_, said) in BAD.items()), got
    assert rows.filter("directory = 'good'").count() == 20


def test_only_the_asked_folders_are_read(spark, tmp_path):
    raw = tmp_path / "raw"
    for name in ("a", "b", "c"):
        session(raw, name, files=[("e_ok.csv", recording(3)), ("f_ok.csv", recording(3))])
    (raw / "b" / "bad.csv").write_text("")
    reader = session_files.EpisodeReader({"root": str(raw), "directories": '["c"]', "n_joints": "1"}, None)
    assert [f for p in reader.partitions() for f in p.files] == [("c", f"{raw}/c/{n}") for n in ("e_ok.csv", "f_ok.csv")]
    rows, errors, _ = sessions.read_episodes(spark, str(raw), 1, ["c", "gone"])
    assert rows.groupBy("source_file").count().count() == 2 and [(r["directory"], r["reason"]) for r in errors.collect()] == [("gone", "no episode files")]
    meta = sessions.read_sessions(spark, str(raw), 1, ["a", "gone"]).collect()
    assert {r["directory"]: r["reason"] for r in meta} == {"a": None, "gone": "no session.json"}


def test_small_files_share_a_partition(monkeypatch):
    monkeypatch.setattr(session_files, "PARTITION_BYTES", 100_000)
    parts = session_files._shared([("a", "x", 200_000), ("a", "y", 10), ("b", "z", 10), ("b", "w", 300_000)])
    assert [[f for _, f in p.files] for p in parts] == [["x"], ["y", "z"], ["w"]]


def stored(spark, path, table="episodes"):
    df = store.read(spark, str(path), table)
    return [] if df is None else sorted((r["session_id"], r["episode_id"]) for r in df.select("session_id", "episode_id").distinct().collect())


def rows_of(spark, *sessions_of):
    steps = spark.createDataFrame([(s, "e", k, 0.1 * k) for s in sessions_of for k in range(3)], "session_id string, episode_id string, step int, q_0 double")
    return steps, steps.select("session_id", "episode_id").distinct()


def test_a_commit_replaces_whole_sessions_and_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "store")
    assert store.live(spark, path) is None and store.read(spark, path, "steps") is None
    sessions.write_episodes(*rows_of(spark, "1", "2"), path)
    steps, episodes = rows_of(spark, "2")
    sessions.write_episodes(steps.filter("step < 2"), episodes, path)
    got = store.read(spark, path, "steps")
    assert {(r["session_id"], r["n"]) for r in got.groupBy("session_id").agg(F.count("*").alias("n")).collect()} == {("1", 3), ("2", 2)}
    assert dict(got.dtypes)["q_0"] == "float" and store.read(spark, path, "episodes").count() == 2
    assert store.read(spark, path, "steps", as_of=1).count() == 6
    none = steps.limit(0)
    store.commit(path, episodes.select("session_id"), {"steps": none, "episodes": episodes.limit(0)})  # its tables became empty
    assert stored(spark, path) == stored(spark, path, "steps") == [("1", "e")]
    store.remove(path, spark.createDataFrame([("1",)], "session_id string"))
    assert stored(spark, path) == [] and {r["session_id"] for r in store.live(spark, path).collect()} == {"2"}
    sessions.write_episodes(*rows_of(spark, "1"), path)
    assert stored(spark, path) == [("1", "e")]


def test_a_broken_off_commit_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    sessions.write_episodes(*rows_of(spark, "1", "2"), path)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_finish", crash)  # every table is written, and the last rename never comes
        with pytest.raises(OSError):
            sessions.write_episodes(*(df.limit(1) for df in rows_of(spark, "2", "3")), path)
    assert store.commits(spark, path) == [1] and stored(spark, path) == [("1", "e"), ("2", "e")] and store.read(spark, path, "steps").count() == 6
    sessions.write_episodes(*rows_of(spark, "3"), path)  # writes over what was left
    assert stored(spark, path) == [("1", "e"), ("2", "e"), ("3", "e")]
    with pytest.raises(RuntimeError, match="another writer"):
        store._finish(spark, path, 2)


def test_vacuum_keeps_what_is_needed(spark, tmp_path):
    path = str(tmp_path / "store")
    for own in (("1",), ("2",), ("1",)):
        sessions.write_episodes(*rows_of(spark, *own), path)
    assert store.vacuum(spark, path) == ["episodes/version=1", "steps/version=1"]
    assert stored(spark, path) == [("1", "e"), ("2", "e")] and store.vacuum(spark, path) == []


def test_dataset_and_manifest_are_written(spark, tmp_path):
    table = spark.createDataFrame(
        [("s", "a", "train", 0, 1.0, 0.5), ("s", "a", "train", 1, 3.0, 0.5), ("v", "b", "val", 0, 9.0, 0.5)],
        "session_id string, episode_id string, split string, step int, q_0 double, act_q_0 double",
    )
    members = spark.createDataFrame(
        [("s", "a", "train", "h", None), ("v", "b", "val", "i", None), ("w", "c", None, "j", "failed")],
        "session_id string, episode_id string, split string, content_hash string, exclude_reason string",
    )
    made = dataset.manifest(table, members, ["q_0"], ["act_q_0"], SMALL)
    sessions.write_dataset(table, made, str(tmp_path / "out"))
    (row,) = store.read_snapshot(spark, str(tmp_path / "out"), "manifest").collect()
    assert store.read_snapshot(spark, str(tmp_path / "out"), "steps", F.col("split") == "val").count() == 1
    assert {n["column"]: (n["mean"], n["std"]) for n in row["norm"]} == {"q_0": (2.0, 1.0), "act_q_0": (0.5, 1e-6)}
    assert [(x["exclude_reason"], x["n"]) for x in row["excluded"]] == [("failed", 1)] and len(row["dataset_hash"]) == 16
    assert {(x["split"], x["n_episodes"], x["n_steps"]) for x in row["splits"]} == {("train", 1, 2), ("val", 1, 1)}
    other = members.withColumn("content_hash", F.when(F.col("session_id") == "s", "k").otherwise(F.col("content_hash")))
    assert dataset.manifest(table, other, ["q_0"], ["act_q_0"], SMALL).first()["dataset_hash"] != row["dataset_hash"]
    dataset.check_split(members)
    for lacking, said in (("train", "train split"), ("val", "val split")):
        with pytest.raises(ValueError, match=said):
            dataset.check_split(members.filter(f"split is null or split <> '{lacking}'"))
    with pytest.raises(ValueError, match="no episode"):
        dataset.check_split(members.filter("split is null"))


def test_loop_retries_on_every_run(spark, tmp_path):
    raw, seen, fail = tmp_path / "raw", [], {"b"}
    session(raw, "a")
    session(raw, "b")

    def process(work, batch_id):
        ids = sorted(r["directory"] for r in work.collect())
        seen.append(ids)
        error = F.when(F.col("directory").isin(list(fail)), F.concat(F.lit("bad "), "directory")) if fail else F.lit(None).cast("string")
        return work.select("directory", F.col("directory").alias("session_id"), error.alias("error")).filter("directory <> 'lost'")

    def go(**k):
        loop.run(spark, str(raw), process, str(tmp_path / "cp"), str(tmp_path / "outcomes"), **k)
        return {r["directory"]: (r["status"], r["attempts"], r["error"]) for r in loop.known_sessions(spark, str(tmp_path / "cp")).collect()}

    assert go() == {"a": ("waiting", 1, None), "b": ("waiting", 1, None)}  # the next run takes up what became of them
    assert go()["b"] == ("waiting", 2, "bad b")  # nothing new, and still tried again
    assert seen == [["a", "b"], ["b"]]
    session(raw, "lost")
    fail.clear()
    go()
    assert seen[2] == ["b", "lost"]
    known = go()
    assert known["b"] == ("done", 3, None) and known["a"] == ("done", 1, None) and known["lost"][:2] == ("waiting", 2)
    loop.again(spark, str(tmp_path / "outcomes"), ["a"])
    fail.add("a")
    assert go(attempts=3)["a"][:2] == ("waiting", 2)
    assert go(attempts=3)["lost"] == ("given up", 3, "nothing was said of it") and seen[-1] == ["a"]


@pytest.fixture
def corpus(spark, tmp_path):
    raw, place = tmp_path / "raw", tmp_path / "store"
    raw.mkdir()
    process = onboard.processor(str(raw), SMALL, str(place), str(tmp_path / "runs"))

    def go():
        loop.run(spark, str(raw), process, str(tmp_path / "cp"), str(tmp_path / "outcomes"))
        return {r["directory"]: (r["status"], r["attempts"]) for r in loop.known_sessions(spark, str(tmp_path / "cp")).collect()}

    return raw, place, go


def test_a_session_is_stored_quarantined_and_summed_up(spark, tmp_path, corpus):
    raw, place, go = corpus
    session(
        raw,
        "a",
        declared="real",
        files=[("e0_ok.csv", recording()), ("e1_ok.csv", recording(2)), ("e2_fail.csv", recording(jump=50.0))],
    )
    session(raw, "b")
    go()
    assert stored(spark, place) == [("real", "real__e0_ok")] and store.read(spark, str(place), "episodes").first()["n_steps"] == 20
    bad = store.read(spark, str(place), "quarantine")
    assert {
        r["episode_id"]: {i["code"] for i in r["issues"]} & {"too_short", "joint_limit_violation"} for r in bad.collect()
    } == {"real__e1_ok": {"too_short"}, "real__e2_fail": {"joint_limit_violation"}}
    assert stored(spark, place, "quarantine_steps") == stored(spark, place, "quarantine")
    runs = spark.read.schema(onboard.RUN).parquet(str(tmp_path / "runs"))
    row = onboard.run_summary(runs).collect()[0]
    assert (row["sessions"], row["episodes"], row["accepted"], row["quarantined"], row["failed"], row["alarm"]) == (2, 3, 1, 2, 1, True)
    assert row["errors"] == {"b": "no episode files"} and all(n > 0 for n in row["flags"].values())
    (said,) = store.read(spark, str(place), "sessions").collect()
    assert (said["session_id"], said["directory"], said["episodes"], said["accepted"]) == ("real", "a", 3, 1)
    assert go()["b"][0] == "waiting"


def test_a_bad_session_keeps_no_other_from_the_store(spark, tmp_path, corpus):
    raw, place, go = corpus
    session(raw, "fine", files=[("e_ok.csv", recording())])
    session(raw, "twice", files=[("e_ok.csv", "t,timestamp,q_0\n1,2,3\n")])
    session(raw, "lost", files=[("e0_ok.csv", recording()), ("e1_ok.csv", "clock,joint_0\n1,2\n")])
    session(raw, "foo", files=[("e_ok.csv", "timestamp,foo\n1,2\n")])
    session(raw, "other", n_joints=3, files=[("e_ok.csv", recording())])
    session(raw, "same1", declared="same", files=[("e_ok.csv", recording())])
    session(raw, "same2", declared="same", files=[("e_ok.csv", recording())])
    go()
    assert stored(spark, place) == [("fine", "fine__e_ok")] and stored(spark, place, "quarantine") == []
    runs = spark.read.schema(onboard.RUN).parquet(str(tmp_path / "runs"))
    errors = {r["directory"]: r["error"] for r in runs.collect()}
    twice = "several folders declare this session_id"
    assert errors == {
        "fine": None, "twice": "e_ok.csv: several columns are t", "lost": "e1_ok.csv: no recognisable time column",
        "foo": "e_ok.csv: missing required column(s): q_0", "other": "n_joints", "same1": twice, "same2": twice,
    }
    (raw / "lost" / "e1_ok.csv").write_text(recording())
    known = go()
    assert known["fine"] == ("done", 1) and known["twice"] == ("waiting", 2) and stored(spark, place) == [("fine", "fine__e_ok"), ("lost", "lost__e0_ok"), ("lost", "lost__e1_ok")]


def test_an_episode_that_turns_bad_leaves_the_store(spark, tmp_path):
    raw, place = tmp_path / "raw", tmp_path / "store"
    for body, sides in ((recording(), (1, 0)), (recording(jump=50.0), (0, 1)), (recording(), (1, 0))):
        session(raw, "a", files=[("e_ok.csv", body)])
        onboard.onboard(spark, str(raw), SMALL, str(place), ["a"])
        for table, n in (("episodes", sides[0]), ("steps", sides[0]), ("quarantine", sides[1]), ("quarantine_steps", sides[1])):
            assert stored(spark, place, table) == [("a", "a__e_ok")] * n, table


def test_a_session_that_breaks_the_job_stands_alone(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    for name in ("a", "b", "c", "d", "e"):
        session(raw, name, files=[("e_ok.csv", recording())])
    whole = onboard.onboard

    def onboard_or_break(spark, root, profile, place, directories, carry):
        if "d" in directories:
            raise ArithmeticError("no luck with d\nand more")
        return whole(spark, root, profile, place, directories, carry)

    monkeypatch.setattr(onboard, "onboard", onboard_or_break)
    process = onboard.processor(str(raw), SMALL, str(tmp_path / "store"), str(tmp_path / "runs"))
    work = spark.createDataFrame([(x,) for x in "abcde"], "directory string")
    assert {r["directory"]: r["error"] for r in process(work, 0).collect()} == {"a": None, "b": None, "c": None, "e": None, "d": "ArithmeticError: no luck with d"}
    assert [s for s, _ in stored(spark, tmp_path / "store")] == ["a", "b", "c", "e"]


def test_gaps_on_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("".join(json.dumps({"ts": f"2024-01-01T00:0{m}:00Z", "k": "x"}) + "\n" for m in (0, 1, 5, 6)))
    (src / "b.json").write_text(json.dumps({"ts": "2024-01-02T00:00:00Z", "k": "x"}) + "\n")
    stream = spark.readStream.schema("ts timestamp, k string").option("maxFilesPerTrigger", 1).json(str(src))
    query = loop.gap_sessions(
        stream,
        "ts",
        ["k"],
        "2 minutes",
        "1 minute",
    ).writeStream.format("memory").queryName("stretches").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["n"] for r in spark.table("stretches").collect()) == [2, 2]
