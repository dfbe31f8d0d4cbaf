"""Streaming jobs: a source, a transformation and a sink under one checkpoint."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tradepulse.session import prepare

# Fixed value: checkpoint interval of the live jobs.
INTERVAL = "5 seconds"


@dataclass(frozen=True)
class Job:
    """What a concrete job supplies; everything else is the same for all of them.

    ``sink`` turns the transformed stream into a writer. The checkpoint directory holds
    offsets, state and commits, and belongs on storage all nodes share.
    """

    name: str
    source: Callable[[SparkSession], DataFrame]
    transform: Callable[[DataFrame], DataFrame]
    sink: Callable[[DataFrame], DataStreamWriter]
    checkpoint: str

    def start(self, spark: SparkSession, available_now: bool = False,
              interval: str = INTERVAL) -> StreamingQuery:
        prepare(spark)
        writer = (self.sink(self.transform(self.source(spark))).queryName(self.name)
                  .option("checkpointLocation", self.checkpoint))
        if available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=interval).start()

    def run(self, spark: SparkSession, timeout: int | None = None) -> None:
        """Work off what is there and stop."""
        query = self.start(spark, available_now=True)
        try:
            query.awaitTermination(timeout) if timeout else query.awaitTermination()
        finally:
            if query.isActive:
                query.stop()


def each_batch(rows: DataFrame, write: Callable[[DataFrame, int], None],
               mode: str = "append") -> DataStreamWriter:
    return rows.writeStream.outputMode(mode).foreachBatch(write)


def late_rows(query: StreamingQuery) -> int:
    """Rows the stateful steps dropped as late, over the progress Spark still remembers.

    Behind a grouping these are rows already merged by the map side.
    """
    return sum(step.numRowsDroppedByWatermark for p in query.recentProgress for step in p.stateOperators)
