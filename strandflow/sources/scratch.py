"""Tables that a job writes for itself in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@lru_cache(maxsize=1)
def _own_folder() -> str:
    """A folder of this process, removed when it ends."""
    path = tempfile.mkdtemp(prefix="spark-")
    atexit.register(shutil.rmtree, path, True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`. Where that is unset: one in the warehouse, or, if driver and executors are one process, a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        alone = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        found = _own_folder() if alone else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return found.rstrip("/")


def cut(df: DataFrame, name: str, instead_of: DataFrame | None = None) -> DataFrame:
    """Write `df` once as a table in the shared folder and read it back: its plan ends there, and a lost executor costs no recomputation.

    The table that it is made `instead_of`, a result of `cut` that nothing else reads, is deleted.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # what was exchanged for the table goes once it is written
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    if instead_of is not None:
        old = spark._jvm.org.apache.hadoop.fs.Path(instead_of._scratch)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return out
