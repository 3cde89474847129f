"""Running streams whose operators keep keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state in RocksDB, as keyed state needs; the session's setting is as before afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def append_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append what a stream has now to a table below `path`, and the table. A later call goes on where this one ended."""
    with keyed_state(stream.sparkSession):
        out = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        query = out.trigger(availableNow=True).start(path)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
