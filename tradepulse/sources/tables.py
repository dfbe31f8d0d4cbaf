"""Config tables and dimension tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import schemas as S
from tradepulse.operators.changelog import after_snapshot
from tradepulse.operators.parse import parse_json
from tradepulse.operators.shape import to_camel


def config_changes(raw: DataFrame, config: T.StructType) -> DataFrame:
    """Captured changes of a config table: its snapshot (op r), then c, u and d."""
    return parse_json(raw, S.config_change(config))


def snapshot_then_changes(snapshot: DataFrame, events: DataFrame, position: int, order: str = "ts_ms") -> DataFrame:
    """A config table's snapshot as captured changes (op r) at ``position``, then what changed after it.

    ``position`` is the high-water mark: the place of the capture when the snapshot was read. Captured
    changes up to it are in the snapshot and are left out, so there is neither a gap nor a repeat.
    """
    config = events.schema["after"].dataType
    row = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in config.fields])
    read = snapshot.select(F.lit("r").alias("op"), F.lit(None).cast(config).alias("before"), row.alias("after"), F.lit(position).cast("bigint").alias(order))
    return read.unionByName(after_snapshot(events, position, order).select("op", "before", "after", order))


def jdbc_snapshot(spark: SparkSession, table: str, *, url: str | None = None,
                  partition_column: str | None = None, bounds: tuple[int, int] | None = None,
                  partitions: int = 1, camel: bool = False) -> DataFrame:
    """A database table as it is now. Address and login come from the environment.

    With ``partition_column`` and ``bounds`` the table is read by ``partitions`` tasks.
    """
    reader = (spark.read.format("jdbc").option("dbtable", table)
              .option("url", url or os.environ["TRADEPULSE_JDBC_URL"]))
    for option, variable in (("user", "TRADEPULSE_JDBC_USER"),
                             ("password", "TRADEPULSE_JDBC_PASSWORD")):
        if variable in os.environ:
            reader = reader.option(option, os.environ[variable])
    if partition_column and bounds:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", bounds[0]).option("upperBound", bounds[1])
                  .option("numPartitions", partitions))
    rows = reader.load()
    return to_camel(rows) if camel else rows


def snapshot(spark: SparkSession, path: str, camel: bool = False) -> DataFrame:
    """The same from a parquet export."""
    rows = spark.read.parquet(path)
    return to_camel(rows) if camel else rows


def nested_dictionary(dim: DataFrame, key: str = "dic_code", name: str = "dic_name") -> DataFrame:
    """The code dictionary as ``rowkey`` with its cells nested under ``info``."""
    return dim.select(F.col(key).cast("string").alias("rowkey"),
                      F.struct(F.col(name).alias("dic_name")).alias("info"))
