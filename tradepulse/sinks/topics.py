"""Append sinks for batch frames and streams.

File sinks are exactly-once by the stream's own commit log. Spark's Kafka sink repeats
rows after a failure; give it a ``key`` so that consumers can settle repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tradepulse.session import PACKED


def json_payload(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return rows.select(F.to_json(F.struct(*(columns or rows.columns))).alias("value"))


def keyed_payload(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key and value texts of an upsert topic."""
    return rows.select(F.to_json(F.struct(*key)).alias("key"),
                       F.to_json(F.struct(*rows.columns)).alias("value"))


def write_text(rows: DataFrame, path: str, batch_id: int = 0) -> None:
    """A batch of payloads as one directory; a repeated batch overwrites its own."""
    rows.select("value").write.mode("overwrite").text(f"{path}/batch_id={batch_id}")


def write_routed(rows: DataFrame, path: str, batch_id: int = 0) -> None:
    """Rows of ``sink_table`` and ``value``; the destination becomes the directory, below that of the batch."""
    (rows.select("sink_table", "value").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("sink_table").text(f"{path}/batch_id={batch_id}"))


def append_stream(rows: DataFrame, path: str, checkpoint: str, file_format: str = "text",
                  partition_by: Sequence[str] = ()) -> DataStreamWriter:
    writer = (rows.writeStream.outputMode("append").format(file_format)
              .option("path", path).option("checkpointLocation", checkpoint))
    return writer.partitionBy(*partition_by) if partition_by else writer


def kafka_stream(rows: DataFrame, brokers: str, checkpoint: str,
                 topic: str | None = None) -> DataStreamWriter:
    """To one topic, or per row to the topic named in ``sink_table``."""
    if topic is None:
        rows = rows.withColumnRenamed("sink_table", "topic")
    writer = (rows.writeStream.outputMode("append").format("kafka")
              .option("kafka.bootstrap.servers", brokers).option("checkpointLocation", checkpoint))
    return writer.option("topic", topic) if topic else writer


def console_stream(rows: DataFrame, checkpoint: str) -> DataStreamWriter:
    return (rows.writeStream.outputMode("append").format("console")
            .option("checkpointLocation", checkpoint))


def land_changes(changes: DataFrame, path: str, batch_id: int = 0) -> None:
    """Write a batch of parsed row changes as parquet, one directory per table and change type."""
    cols = [c for c in changes.columns if c not in ("row_time", "proc_time")]
    (changes.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", PACKED)
     .partitionBy("table", "type").parquet(f"{path}/batch_id={batch_id}"))


def window_table_batch(path: str):
    """``foreachBatch`` writer of a window table.

    Each micro-batch owns one directory and overwrites it when it is repeated, so a
    restart leaves no duplicates. Readers see ``cur_date`` as a partition column.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("cur_date").parquet(f"{path}/batch_id={batch_id}"))

    return write


def plain_batch(path: str):
    """``foreachBatch`` writer of parquet rows; a repeated batch overwrites its own directory."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", PACKED).parquet(f"{path}/batch_id={batch_id}")

    return write
