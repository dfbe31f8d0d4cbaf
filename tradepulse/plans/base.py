"""Base layer: log split, fact routing and dimension sync."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.operators import changelog, logsplit, parse, routing, visitors
from tradepulse.sinks.keyed import DimTables
from tradepulse.sources import topics


def log_split(raw: DataFrame, path: str) -> dict[str, DataFrame]:
    """Raw behaviour log -> repaired logs -> err, start, display, action and page.

    The logs are landed under ``path`` as parsed and as repaired, and the five topics are read from there:
    each text is parsed once, repair and shuffle happen once, not once per topic.
    """
    logs = visitors.repair_new_flag(topics.landed_logs(raw, f"{path}/parsed"))
    logs.write.mode("overwrite").parquet(f"{path}/repaired")
    return logsplit.split(raw.sparkSession.read.schema(S.LOG).parquet(f"{path}/repaired"))


def _history(config_events: DataFrame, key: list[str], order: str, snapshot: DataFrame | None, position: int | None) -> DataFrame:
    """Steps of the config: its snapshot, which held before, and the changes that come after ``position``."""
    if position is not None:
        config_events = changelog.after_snapshot(config_events, position, order)
    steps = changelog.config_steps(config_events, key, order)
    if snapshot is None:
        return steps
    return steps.unionByName(changelog.snapshot_steps(snapshot, order), allowMissingColumns=True)


def fact_router(changes: DataFrame, config_events: DataFrame, order: str = "ts_ms", snapshot: DataFrame | None = None,
                position: int | None = None) -> DataFrame:
    """Changes configured by table and type at their time -> destination and projected payload.

    ``snapshot`` is the config table as read at the start: it holds before the first captured change.
    ``position`` is the place in the capture at which it was read; changes up to it are in it already.
    """
    key = ["source_table", "source_type"]
    steps = _history(config_events, key, order, snapshot, position)
    routed = routing.in_force(changes, steps, key, ["table", "type"], order, F.col("ts") * 1000)
    return routing.tag_destination(routing.project_fields(routed))


def fact_router_batch(config_events: Callable[[], DataFrame], path: str, snapshot: Callable[[], DataFrame] | None = None,
                      position: int | None = None):
    """``foreachBatch`` form: the config is read anew per batch, a repeated batch overwritten."""
    def write(batch: DataFrame, batch_id: int) -> None:
        routed = fact_router(batch, config_events(), snapshot=snapshot and snapshot(), position=position)
        (routed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("sink_table")
         .text(f"{path}/batch_id={batch_id}"))

    return write


def dim_sync_batch(store: DimTables, config_events: Callable[[], DataFrame], database: str,
                   snapshot: Callable[[], DataFrame] | None = None, position: int | None = None):
    """``foreachBatch`` form of the dimension sync; reads of ``store`` see each batch at once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(dim_changes(batch, config_events(), database, snapshot=snapshot and snapshot(), position=position), batch_id)

    return write


def dim_changes(changes: DataFrame, config_events: DataFrame, database: str, order: str = "ts_ms", snapshot: DataFrame | None = None,
                position: int | None = None) -> DataFrame:
    """Changes of dimensions configured at their time, and resets of their tables, as ``DimTables`` takes them.

    A config deleted drops its table, one updated creates it anew: what was written before is gone.
    """
    key = ["source_table"]
    steps = _history(config_events, key, order, snapshot, position)
    routed = routing.in_force(parse.row_changes(changes, database), steps, key, ["table"], order, F.col("ts") * 1000)
    keyed = routed.withColumn("row_key", F.col("data")[F.col("cfg_sink_row_key")])
    put = (routing.project_fields(keyed.where(F.col("row_key").isNotNull()))
           .select("row_key", "data", "type", F.col("ts").alias("version"), "pos", F.col("cfg_sink_table").alias("sink_table")))
    return put.unionByName(routing.reset_rows(steps, order))


def dim_sync(changes: DataFrame, config_events: DataFrame, database: str, snapshot: DataFrame | None = None,
             position: int | None = None) -> DataFrame:
    """All dimension rows after all changes: ``sink_table, row_key, data``."""
    all_changes = dim_changes(changes, config_events, database, snapshot=snapshot, position=position)
    return changelog.fold_cell_maps(changelog.after_resets(all_changes), ["sink_table", "row_key"], ["version", "pos"])
