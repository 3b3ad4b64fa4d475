"""Incremental append: batches of a stream add records of new keys, and their pairs, to tables.

The transcripts that this library reads come in batches; there are no event-time windows
to keep state for. A batch that arrives twice adds nothing, so a restarted stream is safe.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import joins
from ..sources.datasets import exists


def appender(path: str, key: str, derive: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: rows whose key the table at `path` lacks are appended to it,
    and what `derive` makes of them to tables of their own. Derived tables are written
    first, keyed by batch, so that a batch cut short is written again whole."""

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch
        if exists(spark, path):
            fresh = joins.orphans(batch, spark.read.parquet(path), key)
        fresh = fresh.persist()
        try:
            for name, make in (derive or {}).items():
                make(fresh).write.mode("overwrite").parquet(f"{name}/batch={number}")
            fresh.write.mode("append").parquet(path)
        finally:
            fresh.unpersist()

    return append


def run(stream: DataFrame, path: str, key: str, checkpoint: str, derive: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> StreamingQuery:
    """Starts a query that takes what is there and ends."""
    return stream.writeStream.foreachBatch(appender(path, key, derive)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
