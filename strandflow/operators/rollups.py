"""Corpus summaries over scored and validated episodes; every result is small."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from strandflow.operators.canonical import KEYS
from strandflow.operators.quantiles import quantiles
from strandflow.profile import METRICS
from strandflow.sources.scratch import cut


def corpus_summary(quality: DataFrame) -> DataFrame:
    """One row: number of episodes, mean, median, 10 % quantile, minimum and maximum of the score."""
    scores = cut(quality.select("score"), "scores")
    rest = scores.agg(F.count("*").alias("n_episodes"), F.avg("score").alias("mean"), F.min("score").alias("min"), F.max("score").alias("max"))
    middle = quantiles(scores, [], "score", {"median": 0.5, "p10": 0.1}).drop("size")
    return rest.join(middle).select("n_episodes", "mean", "median", "p10", "min", "max")  # one row each


def tier_counts(quality: DataFrame) -> DataFrame:
    """(tier, n, share), with rows for tiers that no episode has."""
    tiers = quality.sparkSession.createDataFrame([(t,) for t in ("gold", "silver", "reject")], "tier string")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return tiers.join(quality.groupBy("tier").agg(F.count("*").alias("n")), "tier", "left").select(
        "tier",
        n.alias("n"),
        F.try_divide(n, F.sum(n).over(W.partitionBy(F.lit(1)))).alias("share"),
    )


def flag_counts(quality: DataFrame) -> DataFrame:
    n = quality.select("*", F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))
    return n.join(F.broadcast(quality.agg(F.count("*").alias("_all")))).select(
        "flag",
        "n",
        (F.col("n") / F.col("_all")).alias("share"),
    ).orderBy(F.desc("n"), "flag")


def _order(flag: str = "flag"):
    return F.array_position(F.array(*(F.lit(m) for m in METRICS)), F.col(flag))


def operator_rollup(quality: DataFrame) -> DataFrame:
    """Per operator: episodes, mean, gold, reject, the most common flag (ties in metric order), lowest mean first."""
    flags = quality.select("operator_id", F.explode("flags").alias("flag")).groupBy("operator_id", "flag").agg(F.count("*").alias("n"))
    top = flags.withColumn(
        "rn",
        F.row_number().over(W.partitionBy("operator_id").orderBy(F.desc("n"), _order())),
    ).filter("rn = 1").select("operator_id", F.col("flag").alias("top_flag"))
    base = quality.groupBy("operator_id").agg(
        F.count("*").alias("n_episodes"),
        F.avg("score").alias("mean"),
        F.count_if(F.col("tier") == "gold").alias("gold"),
        F.count_if(F.col("tier") == "reject").alias("reject"),
    )
    return base.join(top, "operator_id", "left").orderBy("mean", "operator_id")


def task_rollup(quality: DataFrame) -> DataFrame:
    return quality.groupBy("task_id").agg(
        F.count("*").alias("n_episodes"),
        F.avg("score").alias("mean"),
        F.count_if(F.col("tier") == "reject").alias("reject"),
    )


def metric_distributions(quality: DataFrame) -> DataFrame:
    """(name, median, p90, max, mean_penalty) of each metric."""
    found = cut(quality.select(F.inline("metrics")).select("name", "value", "penalty"), "metrics")
    rest = found.groupBy("name").agg(F.max("value").alias("max"), F.avg("penalty").alias("mean_penalty"))
    return quantiles(found, ["name"], "value", {"median": 0.5, "p90": 0.9}).join(rest, "name").select("name", "median", "p90", "max", "mean_penalty")


def worst_episodes(quality: DataFrame, n: int = 10) -> DataFrame:
    return quality.orderBy("score", *KEYS).limit(n).select(*KEYS, "score", "tier")


def validation_rollup(validation: DataFrame) -> DataFrame:
    """(code, n): episodes per error code, most frequent first. An episode with an error has failed, so these are the failed ones."""
    errors = validation.select(F.inline("issues")).filter("severity = 'error'")
    return errors.groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def issue_counts(validation: DataFrame) -> DataFrame:
    """(code, severity, n): issue codes over all episodes, warnings included, most frequent first."""
    return validation.select(F.inline("issues")).groupBy("code", "severity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def validation_summary(validation: DataFrame) -> DataFrame:
    return validation.agg(
        F.count("*").alias("checked"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.count_if(F.col("ok") & (F.size("issues") > 0)).alias("warned"),
    )


def exclusions(members: DataFrame) -> DataFrame:
    return members.filter("exclude_reason is not null").groupBy("exclude_reason").agg(F.count("*").alias("n"))


def split_summary(members: DataFrame) -> DataFrame:
    """Per split: episodes, sessions, steps, sorted operators and tasks, episodes per tier, mean score."""
    kept = members.filter("split is not null")
    names = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return kept.groupBy("split").agg(
        F.count("*").alias("n_episodes"), F.countDistinct("session_id").alias("n_sessions"), F.sum("n_steps").cast("long").alias("n_steps"),
        names("operator_id").alias("operators"), names("task_id").alias("tasks"),
        *(F.count_if(F.col("tier") == t).alias(t) for t in ("gold", "silver", "reject")), F.avg("score").alias("mean_score"),
    )


def heldout_operators(members: DataFrame) -> DataFrame:
    """Operators of the val split that train has never seen."""
    side = lambda s: members.filter(F.col("split") == s).select("operator_id").distinct()
    return side("val").join(side("train"), "operator_id", "left_anti")


def ingest_summary(episodes: DataFrame) -> DataFrame:
    """Per session: episodes and mean interpolated fraction."""
    return episodes.groupBy("session_id").agg(F.count("*").alias("n_episodes"), F.avg("interp_fraction").alias("mean_interp"))


def ingest_result(episodes: DataFrame, skipped: DataFrame, pruned: DataFrame) -> DataFrame:
    """One row: sessions, episodes, skipped and pruned sessions of a run, and (reason, n) of the skipped ones."""
    done = episodes.agg(F.countDistinct("session_id").alias("sessions"), F.count("*").alias("episodes"))
    reasons = skipped.groupBy("reason").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("skipped"),
        F.sort_array(F.collect_list(F.struct("reason", "n"))).alias("reasons"),
    )
    return done.join(reasons).join(pruned.agg(F.count("*").alias("pruned")))  # one row each


def drop_rate(validation: DataFrame, quality: DataFrame, alarm: float = 0.4) -> DataFrame:
    """One row: episodes, quarantined, rejected among the rest, their share, and whether it is alarming."""
    both = validation.join(quality.select(*KEYS, "tier"), list(KEYS), "left")
    row = both.agg(
        F.count("*").alias("total"),
        F.count_if(~F.col("ok")).alias("quarantined"),
        F.count_if(F.col("ok") & (F.col("tier") == "reject")).alias("rejected"),
    )
    share = F.try_divide(F.col("quarantined") + F.col("rejected"), F.col("total"))
    return row.withColumns({"drop_rate": share, "alarm": share > alarm})


def prune_orphans(store: DataFrame, declared: DataFrame, directories: DataFrame) -> DataFrame:
    """Adds keep: whether a session's raw source is still there, by declared id or directory name (unreadable metadata never deletes)."""
    keep = declared.select("session_id").union(directories.select("session_id")).distinct().withColumn("_k", F.lit(True))
    return store.join(keep, "session_id", "left").withColumn("keep", F.col("_k").isNotNull()).drop("_k")
