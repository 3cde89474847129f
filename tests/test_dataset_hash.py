"""The dataset's hash is over all steps of its members, each in its place."""

import hashlib
import math

from pyspark.sql import functions as F

from strandflow.operators import dataset
from strandflow.plans import driver_views as v, queries

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line(row, channels):
    """A row as text: step, time, and values in millionths, halves away from zero."""
    whole = lambda x: int(math.copysign(math.floor(abs(x)) + (abs(x) - math.floor(abs(x)) >= 0.5), x))
    cells = ["-" if row[c] is None else str(whole(row[c] * 1e6)) for c in channels]
    return ",".join(["-" if row[c] is None else str(row[c]) for c in ("step", "t_us")] + cells)


def test_an_ordered_hash_takes_each_step_in_its_place(spark):
    kind = "session_id string, episode_id string, step int, t_us long, x double, y double"
    rows = [("s", "e", k, None if k == 3 else 10 * k, k / 3, None if k % 2 else -0.5e-6) for k in range(12)]
    want = sha(";".join(line(dict(zip(("step", "t_us", "x", "y"), r[2:])), ("x", "y")) for r in rows))
    for given in (rows, rows[::-1]):
        (found,) = dataset.ordered_hash(spark.createDataFrame(given, kind).repartition(3), ["x", "y"]).collect()
        assert found["content_hash"] == want
    for i, c in ((3, "step"), (3, "t_us"), (5, "x"), (5, "y")):
        other = spark.createDataFrame(rows, kind).withColumn(c, F.when(F.col("step") == i, 77).otherwise(F.col(c)))
        assert dataset.ordered_hash(other, ["x", "y"]).first()["content_hash"] != want


def test_the_query_hashes_all_steps_of_all_members(spark):
    members = [r for r in v.built(spark, SF)[1].collect() if r["split"]]
    channels, texts = v.PROFILE.channels(), {}
    for r in sorted(v.steps(spark, SF).collect(), key=lambda r: r["step"]):
        texts.setdefault((r["session_id"], r["episode_id"]), []).append(line(r, channels))
    digests = sorted(sha(":".join((m["split"], *k, sha(";".join(texts[k]))))) for m in members for k in [(m["session_id"], m["episode_id"])])
    groups = {}
    for d in digests:
        groups.setdefault(d[:4], []).append(d)
    whole = sha("|".join(sorted(sha("|".join(g)) for g in groups.values())))
    selection = ",".join(v.OBS + v.ACT)
    assert members and queries.dataset_hash(spark, SF).first()["dataset_hash"] == sha(f"{selection}|{whole}")[:16]
