"""Configuration-driven routing of row changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepulse import functions as fx
from tradepulse.operators import changelog


def _config_columns(config: DataFrame, drop: Sequence[str]) -> DataFrame:
    return config.select(*[F.col(c).alias(f"cfg_{c}") for c in config.columns if c not in drop])


def _match(key: Sequence[str], change_columns: Sequence[str]):
    cond = F.lit(True)
    for k, c in zip(key, change_columns):
        cond = cond & (F.col(c) == F.col(f"cfg_{k}"))
    return cond


def by_table(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Changes of configured tables, with their config as ``cfg_*`` columns.

    ``config`` holds one row per table (see ``current_config``). It is left to the planner
    to broadcast it: its size is checked against the session's threshold, statically from
    the file sizes and again at run time by AQE.
    """
    cfg = _config_columns(config, ["op"])
    return changes.join(cfg, _match(["source_table"], ["table"]), "inner")


def by_table_and_type(changes: DataFrame, config: DataFrame) -> DataFrame:
    """As :func:`by_table` on the pair of table and change type."""
    cfg = _config_columns(config, ["op"])
    return changes.join(cfg, _match(["source_table", "source_type"], ["table", "type"]), "inner")


#: Length of a slice of event time, in the units of the config's positions (milliseconds), and the
#: greatest config history (bytes of its steps as text) that goes to the changes as an index.
SLICE, INDEX_BYTES = 600_000, 8 << 20


def in_force(changes: DataFrame, steps: DataFrame, key: Sequence[str], change_columns: Sequence[str],
             order: str, at: str | Column, slice_by: int = SLICE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Match each change with the config in force at its own time.

    ``steps`` is the config history; each step holds from its ``order`` value up to that of the
    key's next step. A step at the very time of a change already applies to it. ``at`` is the
    change's time in the units of ``order``: config positions are milliseconds, so for change times
    in seconds it is ``F.col("ts") * 1000``. Changes before a key's first step match nothing; add
    :func:`~tradepulse.operators.changelog.snapshot_steps` for what held then. Null keys match nothing.

    A history of up to ``index_bytes``, which is measured first, is broadcast as one array of steps a
    key, and a change finds its own by binary search: changes stay where they are. A larger
    one is matched in slices of time, with the same rows.
    """
    at = F.col(at) if isinstance(at, str) else at
    columns = [c for c in steps.columns if c != "op"]
    live = F.col("op") != "d"
    # of steps at one time the live one counts, of several the greatest
    names = [f"_k{i}" for i in range(len(key))]
    told = (steps.where(F.col(order).isNotNull())
            .select(*[F.col(k).alias(n) for k, n in zip(key, names)], F.col(order).cast("bigint").alias("_at"),
                    F.struct(live.alias("live"), F.struct(*columns).alias("c")).alias("_cfg"))
            .dropna(subset=names).groupBy(*names, "_at").agg(F.max("_cfg").alias("_cfg")))
    of_key = told.groupBy(*names).agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_json("_cfg"))).alias("bytes"))
    longest, size = of_key.agg(F.max("n"), F.sum("bytes")).first()
    asked = _asked(changes, change_columns, names, at.cast("bigint"))
    found = _by_index(asked, told, names, longest or 0) if (size or 0) <= index_bytes else _by_slices(asked, told, names, slice_by)
    return found.select("_row.*", *[F.col("_c").getField(c).alias(f"cfg_{c}") for c in columns])


def _asked(changes: DataFrame, change_columns: Sequence[str], names: Sequence[str], at: Column) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in changes.columns])
    keyed = changes.select(*[F.col(c).alias(n) for c, n in zip(change_columns, names)], at.alias("_at"), row.alias("_row"))
    return keyed.dropna(subset=[*names, "_at"])


def _by_index(asked: DataFrame, told: DataFrame, names: Sequence[str], longest: int) -> DataFrame:
    """Changes with ``_row`` and ``_c``, their step by binary search in the steps of their key."""
    index = told.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("_at", "_cfg"))).alias("_steps"))
    index = index.select(*names, F.col("_steps._at").alias("_times"), "_steps")
    rounds = F.sequence(F.lit(1), F.lit(max(1, longest.bit_length())))

    def halve(ends: Column, _round: Column) -> Column:
        low, high = ends["low"], ends["high"]
        mid = F.shiftright(low + high, 1)
        before = (low < high) & (F.get("_times", mid) <= F.col("_asked"))
        return F.struct(F.when(before, mid + 1).otherwise(low).alias("low"),
                        F.when(before | (low >= high), high).otherwise(mid).alias("high"))

    upto = F.aggregate(rounds, F.struct(F.lit(0).alias("low"), F.size("_times").alias("high")), halve)["low"]
    met = asked.withColumnRenamed("_at", "_asked").join(F.broadcast(index), list(names))
    # the generator keeps the optimizer from searching anew in each column taken from the step
    step = met.select("_row", F.explode(F.array(F.get("_steps", upto - 1)["_cfg"])).alias("_found"))
    return step.where("_found.live").select("_row", F.col("_found.c").alias("_c"))


def _by_slices(asked: DataFrame, told: DataFrame, names: Sequence[str], slice_by: int) -> DataFrame:
    """The same for histories of any size.

    Steps and changes lie in one order per key and slice of time, and the last step before a slice
    is carried into it. So a change meets one config, however long the history, and a hot table
    is spread over its slices.
    """
    cut = F.floor(F.col("_at") / slice_by)
    told, asked = told.withColumn("_slice", cut), asked.withColumn("_slice", cut)
    both = told.unionByName(asked, allowMissingColumns=True)
    within = (Window.partitionBy(*names, "_slice").orderBy("_at", F.col("_row").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = both.withColumn("_own", F.last("_cfg", ignorenulls=True).over(within)).where("_row is not null")
    tails = told.groupBy(*names, "_slice").agg(F.max(F.struct("_at", "_cfg")).alias("_tail"))
    before = Window.partitionBy(*names).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (asked.select(*names, "_slice").distinct().join(tails, [*names, "_slice"], "full")
               .withColumn("_carry", F.last("_tail", ignorenulls=True).over(before)).select(*names, "_slice", F.col("_carry._cfg").alias("_carry")))
    found = own.join(carried, [*names, "_slice"]).withColumn("_found", F.coalesce("_own", "_carry"))
    return found.where("_found.live").select("_row", F.col("_found.c").alias("_c"))


def project_fields(routed: DataFrame, columns: str = "cfg_sink_columns") -> DataFrame:
    """Keep only the configured data fields."""
    return routed.withColumn("data", fx.keep_keys("data", columns))


def tag_destination(routed: DataFrame, table: str = "cfg_sink_table") -> DataFrame:
    """Destination and payload text; the destination is no part of the payload."""
    return routed.select(F.col(table).alias("sink_table"), F.to_json("data").alias("value"))


def table_lifecycle(steps: DataFrame, order: str) -> DataFrame:
    """What the last config step makes of each dimension table.

    ``active``: exists as created; ``reset``: dropped and created anew by an update;
    ``dropped``: gone.
    """
    last = changelog.latest_by_key(
        steps.select("sink_table", F.struct(order, (F.col("op") != "d").alias("live")).alias("_r"),
                     "op", "sink_family"), ["sink_table"], ["_r"])
    state = (F.when(F.col("op") == "d", "dropped").when(F.col("op") == "u", "reset")
             .otherwise("active"))
    return last.select("sink_table", "sink_family", state.alias("state"))


def table_resets(steps: DataFrame, order: str) -> DataFrame:
    """Position of the last drop of each table that dropped it (delete or update)."""
    return (steps.where(F.col("op").isin("d", "u")).groupBy("sink_table")
            .agg(F.max(order).alias("reset_at")))


def reset_rows(steps: DataFrame, order: str) -> DataFrame:
    """:func:`table_resets` as rows beside the changes of dimensions (positions in milliseconds, versions in seconds)."""
    return table_resets(steps, order).where("sink_table is not null").select(
        F.lit(None).cast("string").alias("row_key"), F.lit(None).cast("map<string,string>").alias("data"), F.lit(changelog.RESET).alias("type"),
        F.ceil(F.col("reset_at") / 1000).cast("bigint").alias("version"), F.lit(0).cast("bigint").alias("pos"), "sink_table")
