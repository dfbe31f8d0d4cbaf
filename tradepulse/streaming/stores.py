"""Tables beside a stream: what earlier micro-batches leave for later ones.

A micro-batch is worked off like a batch, by grouping and joining inside the JVM. What it needs of
the past are rows of a :class:`~tradepulse.sinks.keyed.DeltaStore`: days a key was seen on, the last
version of a key, sums of windows that are still open. Each batch adds a directory and repeating it
overwrites that, so a retry finds what the first attempt found. Rows are combined before they are
shuffled: a key with a third of all rows is a few rows a map task.

Across micro-batches the order of arrival counts, inside one the event time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import functions as fx
from tradepulse.operators import changelog
from tradepulse.operators.windows import WINDOW
from tradepulse.session import free_shuffles
from tradepulse.sinks.keyed import DeltaStore

Write = Callable[[DataFrame, int], None]


def interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


class SeenDays(DeltaStore):
    """The days on which each key was seen, with the time of the day's first row.

    A base keeps the days of the newest ``keep_days``, and with ``keep_last`` the last day of each key.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[T.StructField], keep_days: int = 2, keep_last: bool = False):
        super().__init__(spark, path, T.StructType([*keys, T.StructField("_day", T.DateType()), T.StructField("row_time", T.TimestampType())]))
        self.keys, self.keep_days, self.keep_last = [k.name for k in keys], keep_days, keep_last

    def add(self, firsts: DataFrame, batch_id: int) -> DataFrame:
        """The rows of ``firsts`` (one a key and day) whose day is new, which are known from now on."""
        known = self.raw(before=batch_id).select(*self.keys, "_day")
        fresh = firsts.join(known, [*self.keys, "_day"], "left_anti")
        rest = [f for f in firsts.schema.fields if f.name not in self.schema.names]
        # what hangs on the fresh rows is read back with them: the anti-join runs once
        wide = DeltaStore(self.spark, self.path, T.StructType([*self.schema.fields, *rest]))
        wide._put(fresh, "delta", batch_id)
        return wide._scan("delta", [batch_id])

    def last_day(self, before: int) -> DataFrame:
        return self.raw(before).groupBy(*self.keys).agg(F.max("_day").alias("_last"))

    def _base(self, rows: DataFrame) -> DataFrame:
        recent = F.col("_day") > F.date_sub(F.lit(rows.agg(F.max("_day")).first()[0]).cast("date"), self.keep_days)
        if self.keep_last:
            rows = rows.join(rows.groupBy(*self.keys).agg(F.max("_day").alias("_last")), self.keys)
            recent = recent | (F.col("_day") == F.col("_last"))
        return rows.where(recent)


class Versions(DeltaStore):
    """The last version of each key in order of arrival.

    ``keep`` is how long (of event time) a version is remembered; without it for good.
    """

    def __init__(self, spark: SparkSession, path: str, key: T.StructField, order: Sequence[T.StructField],
                 amounts: Sequence[T.StructField], keep: str | None = None):
        super().__init__(spark, path, T.StructType([key, *order, *amounts, T.StructField("_batch", T.LongType())]))
        self.key, self.order, self.amounts, self.keep = key.name, [f.name for f in order], [f.name for f in amounts], keep

    def deltas(self, rows: DataFrame, batch_id: int, slice_by: Column, settle: Sequence[str] = ()) -> DataFrame:
        """``rows`` with each amount less that of the key's version before; a missing amount is zero.

        Inside the batch versions are compared in slices (see ``changelog.with_previous``), its first one
        of a key with what the store remembers. ``settle`` names more columns that order equal versions.
        """
        time = self.order[0]
        filled = rows.withColumns({a: fx.money_or_zero(a) for a in self.amounts})
        last = changelog.latest_by_key(filled.select(self.key, *self.order, *self.amounts), [self.key], [*self.order, *self.amounts])
        self._put(last.withColumn("_batch", F.lit(batch_id).cast("bigint")), "delta", batch_id)
        free_shuffles(self.spark)
        known = self.known(batch_id).select(self.key, F.struct(time, *self.amounts).alias("_known"))
        seen = changelog.with_previous(filled, [self.key], [*self.order, *self.amounts, *settle], [time, *self.amounts], slice_by)
        own = F.struct(*[F.col(f"prev_{c}").alias(c) for c in (time, *self.amounts)])
        before = seen.join(known, self.key, "left").withColumn("_before", F.when(F.col(f"prev_{time}").isNotNull(), own).otherwise(F.col("_known")))
        held = F.col("_before").isNotNull() if self.keep is None else F.col(time) <= F.col(f"_before.{time}") + interval(self.keep)
        previous = lambda a: F.when(held, F.col(f"_before.{a}")).otherwise(F.lit(0))
        return before.select(*[(F.col(c) - previous(c)).cast("decimal(16,2)").alias(c) if c in self.amounts else F.col(c) for c in rows.columns])

    def known(self, before: int) -> DataFrame:
        return changelog.latest_by_key(self.raw(before), [self.key], ["_batch", *self.order])

    def _base(self, rows: DataFrame) -> DataFrame:
        last = changelog.latest_by_key(rows, [self.key], ["_batch", *self.order])
        if self.keep is None:
            return last
        newest = rows.agg(F.max(F.unix_micros(self.order[0]))).first()[0]
        return last.where(F.col(self.order[0]) >= F.timestamp_micros(F.lit(newest)) - interval(self.keep))


class Marks(DeltaStore):
    """The newest event time of each batch, in microseconds."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, T.StructType([T.StructField("newest", T.LongType())]))

    def newest(self, before: int) -> int | None:
        return self.raw(before).agg(F.max("newest")).first()[0]

    def add(self, newest: int | None, batch_id: int) -> None:
        self._put(self.spark.range(1).select(F.lit(newest).cast("bigint").alias("newest")), "delta", batch_id)

    def _base(self, rows: DataFrame) -> DataFrame:
        return rows.agg(F.max("newest").alias("newest"))


class OpenWindows(DeltaStore):
    """Sums by window and keys, batch by batch, until the watermark passes a window's end.

    The watermark is the newest event time less ``lateness``. Rows whose window is closed when their
    batch starts are late and dropped; a batch closes the windows that its own newest row passes.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[T.StructField], sums: Sequence[T.StructField],
                 size: str = WINDOW, lateness: str = "0 seconds"):
        super().__init__(spark, path, T.StructType([T.StructField("_start", T.TimestampType()), *keys, *sums]))
        self.keys, self.sums, self.size, self.lateness = [k.name for k in keys], list(sums), size, lateness
        self.marks = Marks(spark, f"{self.path}/marks")

    def start(self, time: str) -> Column:
        return F.window(time, self.size).start

    def end(self) -> Column:
        return F.col("_start") + interval(self.size)

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("_start", *self.keys).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in self.sums])

    def watermark(self, newest: int | None) -> Column:
        """Before any row nothing is late and nothing closes."""
        if newest is None:
            return F.lit("0001-01-01 00:00:00").cast("timestamp")
        return F.timestamp_micros(F.lit(newest)) - interval(self.lateness)

    def add(self, partials: DataFrame, batch_id: int) -> None:
        """``partials`` have the start of their window as ``_start``, keys and addends."""
        self._put(self._merged(partials), "delta", batch_id)

    def closing(self, batch_id: int, low: Column, high: Column) -> DataFrame:
        """Whole sums of the windows that end after ``low`` and not after ``high``, with the window as ``_w``."""
        due = self.raw(before=batch_id + 1).where((self.end() > low) & (self.end() <= high))
        # one directory holds each window and key once
        merged = self._merged(due) if sum(map(len, self._live(batch_id + 1).values())) > 1 else due
        return merged.select(F.struct(F.col("_start").alias("start"), self.end().alias("end")).alias("_w"), *self.keys, *[f.name for f in self.sums])

    def fold(self, before: int) -> None:
        """Fold the batches before ``before``: windows closed by them go."""
        self._closed = self.watermark(self.marks.newest(before))
        self.compact(before)
        self.marks.compact(before)

    def _base(self, rows: DataFrame) -> DataFrame:
        return self._merged(rows.where(self.end() > self._closed))


class JoinedSides(DeltaStore):
    """Rows of the sides of an interval join, batch by batch, in the place of a stream-stream join's state.

    A batch brings the rows of the join that one of its own takes part in, each of them once. A base keeps the rows of
    the newest ``keep`` seconds; until then late rows meet the others as well. ``_side`` numbers the sides.
    """

    def __init__(self, spark: SparkSession, path: str, sides: Sequence[T.StructType], keep: int):
        fields = {f.name: f for side in sides for f in side.fields}
        super().__init__(spark, path, T.StructType([*fields.values(), T.StructField("_side", T.IntegerType())]), ["_side"])
        self.sides, self.keep = [side.names for side in sides], keep

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """``rows`` of all sides, with ``_side``: parsed once, whatever the number of sides."""
        self._put(rows, "delta", batch_id)

    def joined(self, batch_id: int, join: Callable[..., DataFrame]) -> DataFrame:
        """``join`` of the sides, as far as a row of the batch takes part: the first such side new, those before it old."""
        old, new, upto = self.raw(batch_id), self.raw(batch_id + 1, batch_id), self.raw(batch_id + 1)
        first = range(len(self.sides) if any(self._live(batch_id).values()) else 1)
        of = lambda rows, n: rows.where(F.col("_side") == n).select(*self.sides[n])
        parts = [join(*[of(old if n < i else new if n == i else upto, n) for n in range(len(self.sides))]) for i in first]
        return reduce(DataFrame.unionByName, parts)

    def _base(self, rows: DataFrame) -> DataFrame:
        newest = rows.agg(F.max(F.unix_micros("row_time"))).first()[0]
        return rows.where(F.col("row_time") >= F.timestamp_micros(F.lit(newest).cast("bigint")) - interval(f"{self.keep} seconds"))


def numbered(sides: Sequence[DataFrame]) -> DataFrame:
    """The sides of a join as one frame with ``_side``."""
    rows = [side.withColumn("_side", F.lit(n)) for n, side in enumerate(sides)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def windowed(windows: OpenWindows, partials: Callable[[DataFrame, int], DataFrame], finish: Callable[[DataFrame], DataFrame],
             write: Write, stores: Sequence[DeltaStore] = (), rows: Callable[[DataFrame], DataFrame] = lambda r: r,
             time: str = "row_time", compact_every: int = 100) -> Write:
    """``foreachBatch`` function of a window table.

    ``rows`` flattens a batch, ``partials`` turns what is not late into addends, ``finish`` turns
    closed windows into rows for ``write``. ``stores`` are folded together with the windows.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            windows.fold(batch_id)
            for store in stores:
                store.compact(before=batch_id)
        # parsed once into files: kept by Spark the rows would go to disk unpacked
        parsed = DeltaStore(windows.spark, f"{windows.path}/rows", (flat := rows(batch)).schema)
        parsed._put(flat, "delta", batch_id)
        held = parsed._scan("delta", [batch_id])
        before = windows.marks.newest(batch_id)
        newest = held.agg(F.max(F.unix_micros(time))).first()[0]
        newest = max((n for n in (before, newest) if n is not None), default=None)
        low, high = windows.watermark(before), windows.watermark(newest)
        on_time = held.where(windows.start(time) + interval(windows.size) > low)
        windows.add(partials(on_time, batch_id), batch_id)
        windows.marks.add(newest, batch_id)
        parsed._delete("delta", batch_id)
        free_shuffles(windows.spark)
        write(finish(windows.closing(batch_id, low, high)), batch_id)

    return each
