"""Tables that are joined and aggregated by episode without an exchange.

Steps and episode tables are written in buckets of (session, episode), equally many and sorted, as
tables of the catalog. Windows, aggregations and joins on these keys then take each bucket as it lies.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strandflow.operators.canonical import KEYS
from strandflow.sources import store
from strandflow.sources.scratch import shared_dir


def lay_out(df: DataFrame, name: str, path: str, buckets: int | None = None, order: tuple[str, ...] = ("step",)) -> DataFrame:
    """Write `df` below `path` as the catalog table `name`, in `buckets` (the session's number of shuffle partitions) by episode, and read it."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*KEYS, *(c for c in order if c in df.columns)]
    dealt = df.repartition(buckets, *KEYS)  # each task writes one bucket, in order
    out = dealt.write.mode("overwrite").option("path", path).option("compression", "zstd")
    # measured values hardly repeat: a dictionary of them costs time on both sides and is given up in the end
    out = out.options(**{f"parquet.enable.dictionary#{c}": "false" for c, kind in df.dtypes if kind == "double"})
    out.bucketBy(buckets, *KEYS).sortBy(*by).saveAsTable(name)
    return spark.table(name)


def scratch_layout(df: DataFrame, name: str) -> DataFrame:
    """`lay_out` as a table of the job's own, in the folder that all executors share."""
    name = f"{name}_{uuid.uuid4().hex}"
    return lay_out(df, name, f"{shared_dir(df.sparkSession)}/{name}")


def lay_out_store(spark: SparkSession, path: str, name: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(steps, episodes) of a store (`store.read`), laid out anew as the tables <name>_steps and <name>_episodes below `path`/layout."""
    found = []
    for table in ("steps", "episodes"):
        rows = store.read(spark, path, table)
        if rows is None:
            raise FileNotFoundError(f"no {table} in {path}")
        found.append(lay_out(rows, f"{name}_{table}", f"{path}/layout/{name}_{table}", buckets))
    return found[0], found[1]
