"""New-visitor repair of a stream, micro-batch by micro-batch and without Python.

What is known of a device is its first day. A batch reduces its logs to one row a device with
map-side combine, adds the devices not known yet to a table, and joins its logs with it. No log
waits for another and no device's rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse.operators import visitors
from tradepulse.sinks.keyed import DeltaStore

SCHEMA = T.StructType([T.StructField("_mid", T.StringType()), T.StructField("_first", T.DateType())])


class FirstDays(DeltaStore):
    """First day by device. A batch's own devices are one directory, so a repeated batch overwrites its own."""

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 100):
        super().__init__(spark, path, SCHEMA)
        self.compact_every = compact_every

    def known(self, batch_id: int) -> DataFrame:
        return self.raw(before=batch_id)

    def add(self, rows: DataFrame, batch_id: int) -> DataFrame:
        self._put(rows, "delta", batch_id)
        return self._scan("delta", [batch_id])


def repair(store: FirstDays, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that hands logs with the true ``is_new`` to ``write``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % store.compact_every == 0:
            store.compact(before=batch_id)
        known = store.known(batch_id)
        fresh = visitors.first_days(batch).join(known, "_mid", "left_anti")
        write(visitors.with_true_flag(batch, known.unionByName(store.add(fresh, batch_id))), batch_id)

    return each
