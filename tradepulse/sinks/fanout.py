"""One frame into several topics, all of a micro-batch or nothing of it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse.session import PACKED
from tradepulse.sinks.keyed import DeltaStore


class FanOut:
    """Topics below ``path`` with one commit for all of them: payloads as text, or with key and offset as parquet.

    A batch writes a directory in each topic and then its number to the manifest. Readers go by the
    manifest, so what a batch wrote before it failed is seen by nobody; the retry overwrites it. A batch that is in the
    manifest is not written again.
    """

    def __init__(self, spark: SparkSession, path: str, topics: Sequence[str], columns: str = "value string"):
        self.spark, self.path, self.topics, self.columns = spark, path.rstrip("/"), list(topics), columns
        self.format = "text" if columns == "value string" else "parquet"
        self.manifest = DeltaStore(spark, f"{self.path}/manifest", T.StructType([T.StructField("number", T.LongType())]))

    def committed(self) -> list[int]:
        return self.manifest._committed("delta")

    def _folder(self, name: str, number: int) -> str:
        return f"{self.path}/{name}/batch_id={number}"

    def write_batch(self, splits: Mapping[str, DataFrame], batch_id: int) -> None:
        """``splits`` are the payloads by topic."""
        if batch_id in self.committed():
            return
        for name in self.topics:
            writer = splits[name].write.mode("overwrite").format(self.format)
            (writer.option("compression", PACKED) if self.format == "parquet" else writer).save(self._folder(name, batch_id))
        self.manifest._put(self.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("number")), "delta", batch_id)

    def writer(self, split: Callable[[DataFrame], Mapping[str, DataFrame]]) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` function. The batch is held for the writes, so its source is read and parsed once."""
        def write(batch: DataFrame, batch_id: int) -> None:
            held = batch.persist()
            try:
                self.write_batch(split(held), batch_id)
            finally:
                held.unpersist()

        return write

    def read(self, name: str, numbers: Sequence[int] | None = None) -> DataFrame:
        """The payloads of a topic: all that is committed, or the named batches of it."""
        known = self.committed()
        chosen = known if numbers is None else [n for n in known if n in set(numbers)]
        if not chosen:
            return self.spark.createDataFrame([], self.columns)
        return self.spark.read.schema(self.columns).format(self.format).load([self._folder(name, n) for n in chosen])

    def commits(self) -> DataFrame:
        """The manifest as a stream: a row (``number``) for each committed batch."""
        return (self.spark.readStream.schema(self.manifest.schema).option("recursiveFileLookup", "true")
                .parquet(f"{self.path}/manifest/delta"))

    def following(self, name: str, work: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` function over :meth:`commits`: hands the payloads of newly committed batches to ``work``."""
        def each(batch: DataFrame, batch_id: int) -> None:
            work(self.read(name, [r.number for r in batch.collect()]), batch_id)

        return each
