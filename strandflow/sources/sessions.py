"""Raw session folders as tables, and what is written of them.

Files are read by the data sources of `session_files`, folder by folder, so the cost of a batch is
that of its own files. A file that cannot be used is an error of its session, told beside the rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strandflow.operators.canonical import success_label
from strandflow.sources import store
from strandflow.sources.scratch import cut
from strandflow.sources.session_files import SessionEpisodes, SessionMeta

SESSION = T.StructType().add("session_id", "string").add("operator_id", "string").add("robot_id", "string").add("task_id", "string").add("recorded_at", "timestamp").add("control_hz", "double").add("n_joints", "integer").add("notes", "string").add("_broken", "string")
PROBLEM = "directory string, source_file string, reason string"


def _asked(reader, root: str, directories: list[str] | None):
    reader = reader.option("root", root)
    return reader if directories is None else reader.option("directories", json.dumps(directories))


def read_sessions(spark: SparkSession, root: str, n_joints: int, directories: list[str] | None = None) -> DataFrame:
    """One row per folder under `root` (or per named one): the fields of its session.json, `directory`, and `reason` where it cannot be used (null: fine)."""
    spark.dataSource.register(SessionMeta)
    raw = _asked(spark.read.format("session_meta"), root, directories).load()
    parsed = F.from_json("body", SESSION, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    found = raw.select("directory", "body", parsed.alias("s")).select("directory", "body", "s.*")
    checked = check_sessions(found, n_joints)
    reason = F.when(F.col("body").isNull(), "no session.json").otherwise(F.col("reason"))
    return checked.withColumn("reason", reason).drop("body")


def check_sessions(sessions: DataFrame, n_joints: int) -> DataFrame:
    """Adds `reason`: why a session's metadata cannot be used (null: fine); ids are trimmed."""
    blank = lambda c: F.coalesce(F.length(F.trim(c)), F.lit(0)) == 0
    reason = F.when(F.col("_broken").isNotNull(), "unreadable") if "_broken" in sessions.columns else F.when(F.lit(False), "")
    for c in ("session_id", "operator_id", "robot_id", "task_id"):
        reason = reason.when(blank(c), f"empty {c}")
    reason = reason.when(~F.coalesce(F.col("control_hz") > 0, F.lit(False)), "control_hz").when(
        ~F.coalesce(F.col("n_joints") == n_joints, F.lit(False)),
        "n_joints",
    )
    ids = {c: F.trim(c) for c in ("session_id", "operator_id", "robot_id", "task_id")}
    return sessions.withColumn("reason", reason).withColumns(ids).drop("_broken")


def read_episodes(
    spark: SparkSession, root: str, n_joints: int, directories: list[str] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, errors, skipped) of the episode files below `root` (or below its named folders).

    rows: canonical channels as doubles (null where a cell is no number), t, `extra` (unknown columns
    by lower-cased name, as text), directory, stem, source_file and success. errors and skipped:
    (directory, source_file, reason). An error makes its session unusable: no recognisable time column, a
    missing joint, two headers of one canonical name, no row with a time, an unreadable file, a folder without episode
    files. Files of other formats are skipped. Files are read once, into a table of the shared folder, or as `keep` says.
    """
    spark.dataSource.register(SessionEpisodes)
    read = _asked(spark.read.format("session_episodes"), root, directories).option("n_joints", n_joints).load()
    read = keep(read) if keep else cut(read, "episodes")
    told = lambda c: read.filter(F.col(c).isNotNull()).select("directory", "source_file", F.col(c).alias("reason"))
    rows = read.filter("error is null and skipped is null").drop("error", "skipped")
    return rows.withColumn("success", success_label(F.col("stem"))), told("error"), told("skipped")


def write_episodes(steps: DataFrame, episodes: DataFrame, path: str) -> int:
    """Steps and the one-row-per-episode table of whole sessions, as one commit of the store (`store.commit`)."""
    sessions = episodes.select("session_id").union(steps.select("session_id")).distinct()
    return store.commit(path, sessions, {"steps": steps, "episodes": episodes})


def write_dataset(table: DataFrame, manifest: DataFrame, path: str) -> int:
    """Split tables, one folder per split, and the manifest, as one snapshot."""
    return store.write_snapshot(path, {"steps": table, "manifest": manifest}, {"steps": "split"})
