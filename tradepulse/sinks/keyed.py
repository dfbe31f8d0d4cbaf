"""Keyed tables on plain parquet: append the changes, merge when reading.

A micro-batch writes its own changes only (``delta/batch=N``), so the cost of a write
follows the batch and not the table. Readers merge base and deltas with one grouping by
key. ``compact`` folds the deltas into a new base now and then. Batches and bases are
whole directories, valid once Spark's ``_SUCCESS`` file is there; repeating a batch
overwrites its directory, which makes retries harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse.operators import changelog
from tradepulse.schemas import STR_MAP
from tradepulse.session import PACKED, delete


class DeltaStore:
    """Batches as directories below ``path``: bases fold what came up to their number, deltas follow."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 partition_by: Sequence[str] = ()):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.partition_by = list(partition_by)

    def _committed(self, kind: str) -> list[int]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root)
                      if fs.exists(hadoop.Path(s.getPath(), "_SUCCESS")))

    def _put(self, rows: DataFrame, kind: str, number: int) -> None:
        writer = rows.select(*self.schema.names).write.mode("overwrite").option("compression", PACKED)
        # the directory is the unit of commit, whatever the session's overwrite mode
        writer = writer.option("partitionOverwriteMode", "static")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/{kind}/batch={number}")

    def raw(self, before: int | None = None, since: int | None = None) -> DataFrame:
        """Newest base and the deltas after it, unmerged; ``before`` leaves out later batches, ``since`` all up to it."""
        if since is not None:
            numbers = [n for n in self._committed("delta") if n >= since and (before is None or n < before)]
            return self._scan("delta", numbers) if numbers else self.spark.createDataFrame([], self.schema)
        kinds = self._live(before)
        parts = [self._scan(kind, numbers) for kind, numbers in kinds.items() if numbers]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _live(self, before: int | None = None) -> dict[str, list[int]]:
        """The directories that make the table: the newest base and the deltas after it."""
        older = [n for n in self._committed("base") if before is None or n < before]
        after = older[-1] if older else -1
        return {"base": older[-1:], "delta": [n for n in self._committed("delta") if n > after and (before is None or n < before)]}

    def _scan(self, kind: str, numbers: Sequence[int]) -> DataFrame:
        """One scan over all the directories: the plan does not grow with their number."""
        paths = [f"{self.path}/{kind}/batch={n}" for n in numbers]
        return (self.spark.read.schema(self.schema).option("basePath", f"{self.path}/{kind}")
                .parquet(*paths).select(*self.schema.names))

    def compact(self, before: int | None = None) -> None:
        """Fold the deltas into a new base. What lies before the last base is deleted: nobody has read it since."""
        deltas = [n for n in self._committed("delta") if before is None or n < before]
        bases = self._committed("base")
        if deltas and deltas[-1] > (bases or [-1])[-1]:
            self._put(self._base(self.raw(before)), "base", deltas[-1])
            for kind, numbers in (("base", bases[:-1]), ("delta", [n for n in deltas if bases and n <= bases[-1]])):
                for n in numbers:
                    self._delete(kind, n)

    def _delete(self, kind: str, number: int) -> None:
        delete(self.spark, f"{self.path}/{kind}/batch={number}")

    def _base(self, rows: DataFrame) -> DataFrame:
        """What a base keeps of all rows: by default all of them."""
        return rows


class UpsertTable(DeltaStore):
    """Last version by primary key. A version with ``deleted`` removes its key."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str],
                 order: Sequence[str], schema: T.StructType):
        super().__init__(spark, path, T.StructType(
            [*schema.fields, T.StructField("deleted", T.BooleanType())]))
        self.key, self.order = list(key), list(order)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        if "deleted" not in batch.columns:
            batch = batch.withColumn("deleted", F.lit(False))
        self._put(changelog.latest_by_key(batch, self.key, self.order), "delta", batch_id)

    def read(self, before: int | None = None) -> DataFrame:
        """The table, or what it was before a batch."""
        rows = self.raw(before)
        # one directory holds each key once
        if sum(map(len, self._live(before).values())) > 1:
            rows = changelog.latest_by_key(rows, self.key, self.order)
        return rows.where(~F.col("deleted")).drop("deleted")

    def _base(self, rows: DataFrame) -> DataFrame:
        return changelog.latest_by_key(rows, self.key, self.order)


DIM_CHANGE = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("data", STR_MAP),
    T.StructField("type", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("pos", T.LongType()),
    T.StructField("sink_table", T.StringType()),
])


class DimTables(DeltaStore):
    """All dimension tables, one partition each; cells are merged by partial update.

    Changes are ordered by ``version`` and, within one, by ``pos``, their place in the topic. Rows of
    the kind ``changelog.RESET`` tell that a table was dropped or created anew: what was written to it before is
    gone. A base drops what was overwritten and keeps the versions of the rest, of the last deletion and
    of the last reset, so late changes and resets read the same before and after a compaction.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, DIM_CHANGE, ["sink_table"])

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        if "pos" not in batch.columns:
            batch = batch.withColumn("pos", F.lit(0).cast("bigint"))
        self._put(batch, "delta", batch_id)

    def read(self, table: str | None = None, resets: DataFrame | None = None) -> DataFrame:
        """``sink_table, row_key, data``; of one table only its partition is read.

        ``resets`` (``sink_table, reset_at``) may tell of more resets than the table holds; what was
        written up to then is gone.
        """
        changes = self.raw()
        if table is not None:
            changes = changes.where(F.col("sink_table") == table)
        changes = changelog.after_resets(changes)
        if resets is not None:
            changes = (changes.join(resets, "sink_table", "left")
                       .where(F.col("reset_at").isNull() | (F.col("version") > F.col("reset_at"))))
        return changelog.fold_cell_maps(changes, ["sink_table", "row_key"], ["version", "pos"])

    def dim(self, table: str, columns: Sequence[str], resets: DataFrame | None = None) -> DataFrame:
        """One dimension as a wide table with its row key as ``id``."""
        rows = self.read(table, resets)
        return rows.select(F.col("row_key").alias("id"),
                           *[F.col("data")[c].alias(c) for c in columns if c != "id"])

    def _base(self, rows: DataFrame) -> DataFrame:
        last = rows.where(F.col("type") == changelog.RESET).groupBy("sink_table").agg(F.max("version").alias("version"))
        resets = last.select("sink_table", "version", F.lit(changelog.RESET).alias("type"), F.lit(0).cast("bigint").alias("pos"))
        pruned = changelog.prune_cell_maps(changelog.after_resets(rows), ["sink_table", "row_key"], ["version", "pos"])
        return pruned.unionByName(resets, allowMissingColumns=True)
