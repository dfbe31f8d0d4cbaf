"""Row-change streams: extraction filters, version folds and version deltas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepulse import functions as fx


def _of(changes: DataFrame, table: str, kind: str | None) -> DataFrame:
    rows = changes.where(F.col("table") == table)
    return rows if kind is None else rows.where(F.col("type") == kind)


def _fields(fields: Sequence[str] | Mapping[str, str]) -> list[Column]:
    named = fields if isinstance(fields, Mapping) else {f: f for f in fields}
    return [F.col("data")[key].alias(out) for out, key in named.items()]


def extract(changes: DataFrame, table: str, fields: Sequence[str] | Mapping[str, str],
            kind: str | None = "insert", keep: Sequence[str] = ()) -> DataFrame:
    """Named data fields of one table and one change kind as columns.

    ``fields`` maps output names to data keys where they differ; ``keep`` names envelope
    columns (``ts``, ``row_time``) to carry along.
    """
    return _of(changes, table, kind).select(*_fields(fields), *keep)


def transition(changes: DataFrame, table: str, field: str, value: str,
               fields: Sequence[str] | Mapping[str, str], keep: Sequence[str] = (),
               require_change: bool = True) -> DataFrame:
    """Updates that leave ``field`` at ``value``; by default only those that changed it."""
    rows = _of(changes, table, "update").where(F.col("data")[field] == value)
    if require_change:
        rows = rows.where(F.col("old")[field].isNotNull())
    return rows.select(*_fields(fields), *keep)


def increments(changes: DataFrame, table: str, field: str, fields: Sequence[str],
               keep: Sequence[str] = ()) -> DataFrame:
    """Inserts with their full ``field``, updates that raise it with the difference."""
    new, old = fx.to_long(F.col("data")[field]), fx.to_long(F.col("old")[field])
    inserted = F.col("type") == "insert"
    raised = (F.col("type") == "update") & (new > old)
    amount = F.when(inserted, F.col("data")[field]).otherwise((new - old).cast("string"))
    cols = [amount.alias(f) if f == field else F.col("data")[f].alias(f) for f in fields]
    return _of(changes, table, None).where(inserted | raised).select(*cols, *keep)


# -- configuration changes -----------------------------------------------------------

def decode_config(events: DataFrame) -> DataFrame:
    """Flatten captured config changes: a delete speaks of ``before``, the rest of ``after``."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    others = [c for c in events.columns if c not in ("op", "before", "after")]
    return (events.where(F.col("op").isNotNull() & row.isNotNull())
            .select("op", *others, row.alias("_row")).select("op", *others, "_row.*"))


def config_steps(events: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Config changes per key, in which an update that moves its key also ends the old key."""
    steps = decode_config(events)
    moved = F.lit(False)
    for k in key:
        moved = moved | ~F.col("before")[k].eqNullSafe(F.col("after")[k])
    retired = (events.where((F.col("op") == "u") & F.col("before").isNotNull() & moved)
               .select(F.lit("d").alias("op"), order, "before.*"))
    return steps.select("op", order, *[c for c in steps.columns if c not in ("op", order)]
                        ).unionByName(retired)


def snapshot_steps(snapshot: DataFrame, order: str) -> DataFrame:
    """A table snapshot as steps that lie before every captured change.

    Add them to :func:`config_steps` to know the config before its first change arrives.
    """
    return snapshot.select(F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias(order),
                           *snapshot.columns)


def after_snapshot(events: DataFrame, position: int | Column, order: str) -> DataFrame:
    """Captured changes that a snapshot taken at ``position`` does not hold yet.

    Capture may start before the snapshot is read; what both know counts once.
    """
    return events.where(F.col(order) > position)


def current_config(steps: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The configuration in force: the last step per key, keys that ended left out."""
    # an update is written after the retirement of another key at the same position
    ranked = steps.withColumn("_rank", F.struct(order, (F.col("op") != "d").alias("live")))
    return latest_by_key(ranked, key, ["_rank"]).where(F.col("op") != "d").drop("_rank")


# -- versions of one key -------------------------------------------------------------

def latest_by_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last version per key; equal order values are settled by the other columns.

    One grouping with map-side combine: a key with a third of all rows leaves each map
    task as one row.
    """
    rest = [c for c in rows.columns if c not in {*key, *order}]
    return (rows.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("_v"))
            .select(*key, "_v.*").select(*rows.columns))


def _version(version: str | Sequence[str]) -> Column:
    return F.struct(*([version] if isinstance(version, str) else version))


def fold_cells(changes: DataFrame, key: Sequence[str], cells: Sequence[str],
               version: str | Sequence[str], kind: str = "type") -> DataFrame:
    """Partial-update fold: the last non-null value per cell since the last delete.

    ``version`` names the order of changes: a time alone, or a time and the place in the topic
    that settles one moment. A cell survives if it was written after the last delete of its key,
    so one grouping with the delete position beside the cell positions is enough. A key without
    cells is no row.
    """
    put, at = F.col(kind) != "delete", _version(version)
    aggs = [F.max(F.when(~put, at)).alias("_del")]
    for c in cells:
        written = put & F.col(c).isNotNull()
        aggs.append(F.max(F.when(written, F.struct(at.alias("v"), F.col(c).alias("c")))).alias(f"_{c}"))
    alive = [F.when(F.col("_del").isNull() | (F.col(f"_{c}.v") > F.col("_del")), F.col(f"_{c}.c")).alias(c)
             for c in cells]
    return changes.groupBy(*key).agg(*aggs).select(*key, *alive).dropna("all", subset=list(cells))


def _last_cells(changes: DataFrame, key: Sequence[str], version: str | Sequence[str], kind: str, data: str) -> DataFrame:
    """The last version of each cell of each key; the nameless cell is the last deletion."""
    put = F.col(kind) != "delete"
    gone = F.create_map(F.lit(""), F.lit(None).cast("string"))
    cells = changes.select(*key, _version(version).alias("_v"), F.explode(
        F.when(put, F.map_filter(data, lambda _k, v: v.isNotNull())).otherwise(gone)).alias("_cell", "_value"))
    return (cells.groupBy(*key, "_cell")
            .agg(F.max(F.struct(F.col("_v").alias("v"), F.col("_value").alias("c"))).alias("_w")))


def fold_cell_maps(changes: DataFrame, key: Sequence[str], version: str | Sequence[str],
                   kind: str = "type", data: str = "data") -> DataFrame:
    """:func:`fold_cells` where the cells are a map and differ from row to row."""
    last = _last_cells(changes, key, version, kind, data)
    # one row per cell name by now: the map is as wide as the table, however many changes
    deleted = F.max(F.when(F.col("_cell") == "", F.col("_w.v")))
    merged = last.groupBy(*key).agg(
        deleted.alias("_del"),
        F.collect_list(F.when(F.col("_cell") != "",
                              F.struct("_cell", F.col("_w.c").alias("c"), F.col("_w.v").alias("v")))
                       ).alias("_cells"))
    kept = F.filter("_cells", lambda x: F.col("_del").isNull() | (x["v"] > F.col("_del")))
    pairs = F.transform(kept, lambda x: F.struct(x["_cell"], x["c"]))
    return (merged.select(*key, F.map_from_entries(F.array_sort(pairs)).alias(data))
            .where(F.size(data) > 0))


#: A row of this kind says that its table was dropped, or created anew, at its version.
RESET = "reset"


def after_resets(changes: DataFrame, table: str = "sink_table", version: str = "version", kind: str = "type") -> DataFrame:
    """The changes of each table since it was last created, without the resets themselves.

    A change at the version of a reset belongs to the new table, as config applies to the changes of its own moment.
    """
    resets = changes.where(F.col(kind) == RESET).groupBy(table).agg(F.max(version).alias("_reset"))
    kept = changes.where(F.col(kind) != RESET).join(resets, table, "left")
    return kept.where(F.col("_reset").isNull() | (F.col(version) >= F.col("_reset"))).select(changes.columns)


def prune_cell_maps(changes: DataFrame, key: Sequence[str], version: Sequence[str],
                    kind: str = "type", data: str = "data") -> DataFrame:
    """The changes that still matter, with their versions: the last of each cell and the last deletion.

    Folding them, with or without later or late changes, gives what folding all would give.
    """
    last = _last_cells(changes, key, version, kind, data)
    gone = F.col("_cell") == ""
    cells = F.collect_list(F.when(~gone, F.struct("_cell", F.col("_w.c").alias("c"))))
    return (last.groupBy(*key, F.col("_w.v").alias("_v"), gone.alias("_gone")).agg(F.map_from_entries(F.array_sort(cells)).alias(data))
            .select(*key, data, F.when(F.col("_gone"), "delete").otherwise("insert").alias(kind), "_v.*"))


def with_previous(rows: DataFrame, key: Sequence[str], order: Sequence[str],
                  values: Sequence[str], slice_by: Column) -> DataFrame:
    """Add ``prev_<value>``: the value of the key's previous row, null on its first.

    ``slice_by`` must not decrease along ``order``. Rows are compared inside one slice of
    a key; only the last row of each slice travels on to the next one. A hot key is so
    spread over as many tasks as it has slices, and the rows are shuffled once.
    """
    # All columns take part in the order. That settles ties, and it makes the two readers
    # of ``seen`` below need the very same shuffle, which Spark then runs once.
    rest = [c for c in rows.columns if c not in {*key, *order}]
    cut = rows.withColumn("_slice", slice_by)
    inner = Window.partitionBy(*key, "_slice").orderBy(*order, *rest)
    # each value by itself: a struct of them would be shuffled beside them
    seen = cut.withColumns({**{f"_prev_{v}": F.lag(v).over(inner) for v in values},
                            "_first": F.lag(F.lit(True)).over(inner).isNull(), "_last": F.lead(F.lit(True)).over(inner).isNull()})
    tails = seen.where("_last").select(*key, "_slice", F.struct(*values).alias("_state"))
    carry = tails.select(*key, "_slice", F.lag("_state").over(
        Window.partitionBy(*key).orderBy("_slice")).alias("_carry"))
    # only keys that live through several slices carry anything
    carry = carry.where(F.col("_carry").isNotNull())
    joined = seen.join(carry, [*key, "_slice"], "left")
    previous = lambda v: F.when(F.col("_first"), F.col(f"_carry.{v}")).otherwise(F.col(f"_prev_{v}"))
    return joined.select(*rows.columns, *[previous(v).alias(f"prev_{v}") for v in values])


def version_deltas(rows: DataFrame, key: Sequence[str], order: Sequence[str],
                   amounts: Sequence[str], slice_by: Column, keep: str | None = None) -> DataFrame:
    """Replace each amount by its difference to the key's previous version.

    Summing deltas over any span gives the net change, so corrections of an order line do
    not count twice. A missing amount counts as zero. With ``keep`` a version is forgotten after that
    much event time (``order[0]``): one that comes later counts in full again.
    """
    filled = rows.withColumns({a: fx.money_or_zero(a) for a in amounts})
    time = [order[0]] if keep else []
    seen = with_previous(filled, key, order, [*amounts, *time], slice_by)
    fresh = F.col(order[0]) <= F.col(f"prev_{order[0]}") + F.expr(f"INTERVAL {keep}") if keep else F.lit(True)
    previous = lambda c: F.coalesce(F.when(fresh, F.col(f"prev_{c}")), F.lit(0))
    return seen.select(*[
        (F.col(c) - previous(c)).cast("decimal(16,2)").alias(c)
        if c in amounts else F.col(c) for c in rows.columns])
