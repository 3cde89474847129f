"""A versioned store: what a commit wrote becomes visible all at once, session by session.

Below a path, `<table>/version=<n>` holds the rows that commit n wrote, `sessions/version=<n>` the sessions it
speaks for, and `commits/<n>` says that it is complete; that file is put in place by one rename.
A session's rows in a table are those of the newest complete commit that names it and has the table, so
what a commit has changes together, an empty table stands for itself, and a table that a
commit lacks stays as it was. A session may be named as gone. Folders of a commit
that was broken off are never read, and the next commit writes over them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from strandflow.operators.canonical import KEYS

SESSIONS = "sessions"


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete commits, in order."""
    files, at = _hadoop(spark, f"{path}/commits")
    found = files.listStatus(at) if files.exists(at) else []
    names = [f.getPath().getName() for f in found]
    return sorted(int(n) for n in names if n.isdigit())


def _finish(spark: SparkSession, path: str, version: int) -> None:
    files, at = _hadoop(spark, f"{path}/commits/{version:012d}")
    if files.exists(at):
        raise RuntimeError(f"commit {version} is there already: another writer is at work")
    _, draft = _hadoop(spark, f"{path}/commits/.{uuid.uuid4().hex}")
    files.create(draft, False).close()
    if not files.rename(draft, at):
        raise RuntimeError(f"commit {version} could not be completed")


def commit(path: str, sessions: DataFrame, tables: dict[str, DataFrame]) -> int:
    """Write `tables` and make them visible as the state of `sessions` (session_id and what else is said of them; `live` false: gone). The commit's number.

    Rows of other sessions than these would never be read. Tables are laid out by session and episode where they have these columns.
    """
    spark = sessions.sparkSession
    version = max(commits(spark, path), default=0) + 1
    if "live" not in sessions.columns:
        sessions = sessions.withColumn("live", F.lit(True))
    sessions = sessions.withColumn("tables", F.array(*map(F.lit, tables)).cast("array<string>"))
    for name, df in (tables | {SESSIONS: sessions}).items():
        order = [k for k in (*KEYS, "step") if k in df.columns]
        floats = {c: F.col(c).cast("float") for c, t in df.dtypes if t == "double" and name == "steps"}
        df = df.withColumns(floats) if floats else df
        df = df.sortWithinPartitions(*order) if order else df
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}/version={version}")
    _finish(spark, path, version)
    return version


def _read(spark: SparkSession, path: str, table: str, versions: list[int]) -> DataFrame | None:
    paths = [p for p in (f"{path}/{table}/version={v}" for v in versions) for files, at in [_hadoop(spark, p)] if files.exists(at)]
    if not paths:
        return None
    read = spark.read.option("basePath", f"{path}/{table}").option("mergeSchema", table == SESSIONS)
    return read.parquet(*paths).withColumn("version", F.col("version").cast("int"))


def live(spark: SparkSession, path: str, as_of: int | None = None, table: str | None = None) -> DataFrame | None:
    """What the newest commit (up to `as_of`; of those that have `table`) says of each session that is there, with its version; None before the first commit."""
    known = [v for v in commits(spark, path) if as_of is None or v <= as_of]
    said = _read(spark, path, SESSIONS, known)
    if said is None:
        return None
    if table is not None:
        said = said.filter(~F.col("live") | F.array_contains("tables", table))
    newest = F.row_number().over(W.partitionBy("session_id").orderBy(F.desc("version")))
    return said.withColumn("_n", newest).filter("_n = 1 and live").drop("_n", "live", "tables")


def read(spark: SparkSession, path: str, table: str, as_of: int | None = None) -> DataFrame | None:
    """The rows of a table that belong to the present (or a former) state of the sessions; None if there is no such table.

    Only the folders of versions that a session is still at are read.
    """
    if table == SESSIONS:
        return live(spark, path, as_of)
    now = live(spark, path, as_of, table)
    if now is None:
        return None
    versions = sorted(r["version"] for r in now.select("version").distinct().collect())  # at most as many as commits
    rows = _read(spark, path, table, versions)
    if rows is None:
        return None
    return rows.join(now.select("session_id", "version"), ["session_id", "version"], "left_semi").drop("version")


def remove(path: str, sessions: DataFrame) -> int:
    """A commit by which these sessions (session_id) are gone from every table."""
    return commit(path, sessions.select("session_id", F.lit(False).alias("live")), {})


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders that no session needs any more: versions replaced as a whole, and those never completed. Former states of them cannot be read after that.

    What was said of sessions stays, so that a removed session stays removed.
    """
    done = []
    files, at = _hadoop(spark, path)
    for folder in files.listStatus(at) if files.exists(at) else []:
        name = folder.getPath().getName()
        if name in ("commits", SESSIONS):
            continue
        now = live(spark, path, table=name)
        needed = set() if now is None else {r["version"] for r in now.select("version").distinct().collect()}
        for own in files.listStatus(folder.getPath()):
            version = own.getPath().getName().removeprefix("version=")
            if version.isdigit() and int(version) not in needed:
                files.delete(own.getPath(), True)
                done.append(f"{name}/version={version}")
    return sorted(done)


def write_snapshot(path: str, tables: dict[str, DataFrame], partition_by: dict[str, str] | None = None) -> int:
    """Tables that become the newest state of `path` all at once; readers see either all of the former ones or all of these."""
    spark = next(iter(tables.values())).sparkSession
    version = max(commits(spark, path), default=0) + 1
    for name, df in tables.items():
        out = df.write.mode("overwrite").option("compression", "zstd")
        out = out.partitionBy(partition_by[name]) if partition_by and name in partition_by else out
        out.parquet(f"{path}/{name}/version={version}")
    _finish(spark, path, version)
    return version


def read_snapshot(spark: SparkSession, path: str, table: str, where: Column | None = None) -> DataFrame:
    """A table of the newest complete snapshot."""
    known = commits(spark, path)
    if not known:
        raise FileNotFoundError(f"no complete snapshot below {path}")
    df = spark.read.parquet(f"{path}/{table}/version={known[-1]}")
    return df if where is None else df.filter(where)
