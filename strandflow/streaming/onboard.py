"""Onboarding of sessions: read, resample, validate, score, store or quarantine, and what became of each.

A session is onboarded as a whole or not at all. What is wrong with one session is that session's
error and never keeps another one from the store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandflow.operators import canonical, dataset, metrics, resample, validate
from strandflow.operators.canonical import KEYS
from strandflow.profile import METRICS, Profile
from strandflow.sources import sessions as source, store as versions
from strandflow.sources.scratch import cut
from strandflow.streaming.loop import OUTCOME

FATES = ("accepted", "quarantined", "rejected")
RUN = (
    "batch long, ran_at timestamp, directory string, session_id string, episodes long, accepted long, quarantined long, rejected long, "
    "flags map<string, long>, error string"
)


def ingest(rows: DataFrame, sessions: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """(steps, episodes) of raw rows (`sessions.read_episodes`) on each session's own rate; ids are the declared ones.

    Rows without a time are left out. Rows whose folder has no usable session are left out, too.
    """
    keyed = rows.join(sessions.select("directory", "session_id", "operator_id", "task_id", "control_hz"), "directory")
    raw = keyed.withColumns(
        {"episode_id": F.concat_ws("__", "session_id", "stem"), "t_us": F.round(F.col("t") * resample.SECOND_US).cast("long")}
    ).filter("t_us is not null")
    channels = [c for c in profile.channels() if c in raw.columns]
    known = raw.withColumns({c: canonical.known(F.col(c)) for c in channels})
    carried = ["operator_id", "task_id", "success", "source_file", "control_hz"]
    grid = resample.resample(known, channels, F.col("control_hz"), profile.max_gap_us, channels, carry=carried)
    steps = canonical.coerce(canonical.derive_absent(grid, profile), profile)
    episodes = resample.episodes_of(grid, *carried)
    return steps, episodes.join(dataset.content_hash(steps, profile.channels()), list(KEYS))


def judge(steps: DataFrame, episodes: DataFrame, profile: Profile) -> DataFrame:
    """Episodes with metrics, score, tier, ok, issues and their fate; durations are compared within the session."""
    scored = metrics.score(metrics.metrics(steps, episodes, profile, ["session_id"]), profile)
    judged = scored.join(validate.validate(steps, profile), list(KEYS))
    fate = F.when(~F.col("ok"), "quarantined").when(F.col("tier") == "reject", "rejected").otherwise("accepted")
    return judged.withColumn("fate", fate)


def _counts(judged: DataFrame) -> DataFrame:
    """Per session: episodes, how many met each fate, and how often each flag was raised among the valid ones."""
    flags = F.map_from_entries(F.filter(F.array(*(
        F.struct(F.lit(m).alias("key"), F.count_if(F.col("ok") & F.array_contains("flags", m)).alias("value")) for m in METRICS
    )), lambda x: x["value"] > 0))
    fates = (F.count_if(F.col("fate") == f).alias(f) for f in FATES)
    return judged.groupBy("session_id").agg(F.count("*").alias("episodes"), *fates, flags.alias("flags"))


def usable(spark: SparkSession, root: str, profile: Profile, directories: list[str]) -> tuple[DataFrame, DataFrame]:
    """(sessions, bad): metadata of the folders that can be used, and (directory, session_id, error) of the others. An id that several folders declare is an error of each."""
    meta = cut(source.read_sessions(spark, root, profile.n_joints, directories), "sessions")
    twice = meta.filter("reason is null").groupBy("session_id").count().filter("count > 1").select("session_id", F.lit("several folders declare this session_id").alias("twice"))
    meta = meta.join(twice, "session_id", "left").withColumn("error", F.coalesce("reason", "twice"))
    return meta.filter("error is null").drop("reason", "twice", "error"), meta.filter("error is not null").select("directory", "session_id", "error")


def onboard(spark: SparkSession, root: str, profile: Profile, store: str, directories: list[str], carry: dict[str, object] | None = None) -> DataFrame:
    """Onboard these folders in one commit of the store; (directory, session_id, episodes, accepted, quarantined, rejected, flags, error) of each.

    The store's tables: steps and episodes hold the accepted ones, with score and tier, quarantine_steps and
    quarantine the others with their reasons. Only the folders' own files are read.
    """
    sessions, bad = usable(spark, root, profile, directories)
    rows, errors, _ = source.read_episodes(spark, root, profile.n_joints, directories)
    text = F.concat_ws(": ", F.element_at(F.split("source_file", "/"), -1), "reason")
    failed = errors.groupBy("directory").agg(F.array_join(F.sort_array(F.collect_list(text)), "; ").alias("error"))
    failed = cut(sessions.select("directory", "session_id").join(failed, "directory"), "failed")
    good = sessions.join(failed, "directory", "left_anti")
    steps, episodes = ingest(rows, good, profile)
    steps = cut(steps, "steps")
    judged = cut(judge(steps, episodes, profile), "judged")
    counts = cut(_counts(judged).join(good.select("session_id", "directory"), "session_id"), "counts")
    if not counts.isEmpty():
        accepted, others = judged.filter("fate = 'accepted'"), judged.filter("fate <> 'accepted'")
        versions.commit(
            store,
            counts.withColumns({k: F.lit(v) for k, v in (carry or {}).items()}),
            {
                "steps": steps.join(accepted, list(KEYS), "left_semi"),
                "episodes": accepted.drop("ok", "issues", "fate", "hard_reject_reasons"),
                "quarantine_steps": steps.join(others, list(KEYS), "left_semi"),
                "quarantine": others.drop("ok"),
            },
        )
    nothing = good.join(counts, "directory", "left_anti").select("directory", "session_id", F.lit("no episode").alias("error"))
    told = failed.select("directory", "session_id", "error").unionByName(bad).unionByName(nothing)
    return counts.unionByName(told, allowMissingColumns=True)


def rescore(spark: SparkSession, store: str, profile: Profile) -> int | None:
    """Score the whole store anew, durations compared within each task of the corpus, and commit the episodes with their new score, tier and flags; steps stay as they are. None if there is nothing."""
    steps, episodes = (versions.read(spark, store, t) for t in ("steps", "episodes"))
    if steps is None or episodes is None:
        return None
    own = [c for c in episodes.columns if c not in (*METRICS, "score", "tier", "flags", "metrics")]
    scored = metrics.score(metrics.metrics(steps, episodes.select(*own), profile), profile)
    scored = cut(scored.drop("hard_reject_reasons"), "rescored")
    return versions.commit(store, scored.select("session_id").distinct(), {"episodes": scored})


def _apart(directories: list[str], work: Callable[[list[str]], DataFrame]) -> list[DataFrame]:
    """Results of `work`; where it raises, its folders are halved until the one that brings it about stands alone."""
    try:
        return [work(directories)]
    except Exception as e:  # whatever went wrong with one session is that session's error
        if len(directories) == 1:
            spark = SparkSession.active()
            message = f"{type(e).__name__}: {e}".strip().split("\n")[0][:500]
            return [spark.createDataFrame([(directories[0], None, message)], OUTCOME)]
        half = len(directories) // 2
        return _apart(directories[:half], work) + _apart(directories[half:], work)


def processor(root: str, profile: Profile, store: str, runs: str) -> Callable[[DataFrame, int], DataFrame]:
    """The function that onboards the folders of a batch (`loop.run`); it returns (directory, session_id, error) of each.

    Each call writes the batch's outcomes below `runs`, one row per folder (RUN). A batch may run twice.
    """

    def process(work: DataFrame, batch_id: int) -> DataFrame:
        spark = work.sparkSession
        directories = sorted(r["directory"] for r in work.select("directory").distinct().collect())  # names of one batch's folders
        parts = _apart(directories, lambda own: onboard(spark, root, profile, store, own, {"batch": batch_id}))
        found = parts[0]
        for more in parts[1:]:
            found = found.unionByName(more, allowMissingColumns=True)
        nothing = {c: F.lit(0).cast("long") for c in ("episodes", *FATES)}
        found = found.select(
            F.lit(batch_id).cast("long").alias("batch"), F.current_timestamp().alias("ran_at"), "directory", "session_id",
            *(F.coalesce(F.col(c), z).alias(c) if c in found.columns else z.alias(c) for c, z in nothing.items()),
            (F.col("flags") if "flags" in found.columns else F.lit(None)).cast("map<string, bigint>").alias("flags"),
            (F.col("error") if "error" in found.columns else F.lit(None)).cast("string").alias("error"),
        )
        found.write.mode("overwrite").parquet(f"{runs}/run={batch_id}")
        return spark.read.schema(RUN).parquet(f"{runs}/run={batch_id}")

    return process


def run_summary(runs: DataFrame, alarm: float = 0.4) -> DataFrame:
    """Per batch: sessions, episodes, accepted, quarantined, rejected, failed sessions, the error of each, the flags raised, the drop rate and whether it is alarming."""
    row = runs.groupBy("batch").agg(
        F.max("ran_at").alias("ran_at"),
        F.count("*").alias("sessions"),
        *(F.sum(c).alias(c) for c in ("episodes", *FATES)),
        F.count("error").alias("failed"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("directory", "error"))))).alias("errors"),
    )
    raised = runs.select("batch", F.explode("flags").alias("flag", "n")).groupBy("batch", "flag").agg(F.sum("n").alias("n"))
    flags = raised.groupBy("batch").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("flag", "n")))).alias("flags"))
    share = F.try_divide(F.col("quarantined") + F.col("rejected"), F.col("accepted") + F.col("quarantined") + F.col("rejected"))
    row = row.join(flags, "batch", "left").withColumn("flags", F.coalesce("flags", F.expr("cast(map() as map<string, bigint>)")))
    return row.withColumns({"drop_rate": share, "alarm": F.coalesce(share > alarm, F.lit(False))})
