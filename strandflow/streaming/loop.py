"""New sessions as a stream: discover, process each once, try again what failed; and gaps on a live stream.

What is known of a session is keyed state: new folders and the outcomes of former attempts are one stream,
grouped by folder, and the state says which of them are to be processed now. An outcome is a row of a
small table; the next run reads it as input, so a failure is tried again once in each run, until it is
done or, if a limit is set, given up. Nothing that is known of other sessions is read for that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strandflow.sources.session_files import Sessions
from strandflow.streaming.state import keyed_state

OUTCOME = "directory string, session_id string, error string"
EVENT = "directory string, kind string, error string"
STATE = "status string, attempts int, error string"
Process = Callable[[DataFrame, int], DataFrame]


class Attempts(StatefulProcessor):
    """Per folder: waiting, done or given up, how often it was tried, and the last error. Emits (directory, attempt) of what is to be processed."""

    def __init__(self, most: int | None):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("status", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        status, attempts, error = self.state.get() if self.state.exists() else ("new", 0, None)
        events = pd.concat(list(rows))
        kinds = set(events["kind"])
        failed = events[events["kind"] == "failed"]
        if len(failed):
            status, error = "waiting", str(failed["error"].iloc[-1])
        if "done" in kinds:
            status, error = "done", None
        tries = ("arrived" in kinds and status == "new") or "again" in kinds or status == "waiting"
        if tries and status == "waiting" and self.most is not None and attempts >= self.most and "again" not in kinds:
            status, tries = "given up", False
        if tries:
            status, attempts = "waiting", attempts + 1
            yield pd.DataFrame({"directory": [key[0]], "attempt": [attempts]})
        self.state.update((status, attempts, error))

    def close(self) -> None:
        pass


def discover(spark: SparkSession, root: str) -> DataFrame:
    """A stream of (directory): each folder once, as soon as its session.json is there, so recorders write that file last."""
    spark.dataSource.register(Sessions)
    return spark.readStream.format("sessions").option("root", root).load()


def retry_ledger(arrived: DataFrame, ledger: DataFrame, done: DataFrame) -> DataFrame:
    """Sessions to process next time: what arrived or waited, without what is done."""
    return arrived.select("session_id").union(ledger.select("session_id")).distinct().join(
        done.select("session_id"),
        "session_id",
        "left_anti",
    )


def _record(events: DataFrame, outcomes: str, name: str) -> None:
    events.select("directory", "kind", "error").coalesce(1).write.mode("overwrite").parquet(f"{outcomes}/{name}")


def again(spark: SparkSession, outcomes: str, directories: list[str]) -> None:
    """Have these folders processed in the next run, whatever became of them."""
    rows = [(d, "again", None) for d in directories]
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(f"{outcomes}/asked")


def run(spark: SparkSession, root: str, process: Process, checkpoint: str, outcomes: str, attempts: int | None = None) -> None:
    """Process everything that is new, and everything that failed in the run before.

    `process` gets (directory) of a batch and returns (directory, session_id, error) of each; without an error
    a session is done. A folder that it says nothing of has failed. `attempts` limits how often a session is tried.
    A batch that is replayed writes over its own outcomes.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{outcomes}/asked")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)

    def batch(work: DataFrame, batch_id: int) -> None:
        work = work.select("directory").distinct().persist()
        try:
            if work.isEmpty():
                return
            told = work.join(process(work, batch_id).select("directory", "session_id", "error", F.lit(True).alias("told")), "directory", "left")
            error = F.when(F.col("told").isNull(), "nothing was said of it").otherwise(F.col("error"))
            kind = F.when(error.isNull(), "done").otherwise("failed")
            _record(told.select("directory", kind.alias("kind"), error.alias("error")), outcomes, f"batch_{batch_id}")
        finally:
            work.unpersist()

    new = discover(spark, root).select("directory", F.lit("arrived").alias("kind"), F.lit(None).cast("string").alias("error"))
    former = spark.readStream.schema(EVENT).option("recursiveFileLookup", True).parquet(outcomes)
    known = new.unionByName(former).groupBy("directory").transformWithStateInPandas(
        Attempts(attempts), "directory string, attempt int", "update", "none"
    )
    with keyed_state(spark):
        query = known.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def known_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(directory, status, attempts, error) of every folder seen so far, read from the state itself."""
    state = spark.read.format("statestore").option("stateVarName", "status").load(checkpoint)
    return state.select(F.col("key.directory").alias("directory"), "value.*")


def gap_sessions(stream: DataFrame, time: str, keys: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """Stretches without a gap: a new session window begins where `gap` passed without a row."""
    return stream.withWatermark(time, late).groupBy(*keys, F.session_window(time, gap).alias("stretch")).agg(F.count("*").alias("n")).select(
        *keys,
        F.col("stretch.start").alias("start"),
        F.col("stretch.end").alias("end"),
        "n",
    )
