"""Joined facts kept up to date, micro-batch by micro-batch.

A stream-stream join emits a row once, when nothing can change it any more. Here the sides are
tables; a batch of changes tells which rows of the result it touches, those are joined anew from the tables
and put in the place of what was there. A row appears as soon as its inner sides are known, is
corrected when an outer side comes, however late, and goes when an inner side does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import schemas as S
from tradepulse.operators import joins
from tradepulse.operators.changelog import RESET
from tradepulse.operators.joins import SKU_CHAIN, Hop
from tradepulse.plans import trade
from tradepulse.session import delete, free_shuffles
from tradepulse.sinks.keyed import DimTables, UpsertTable
from tradepulse.sinks.topics import land_changes
from tradepulse.sources.topics import landed_changes


def _side(*names: str) -> T.StructType:
    return T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField("ts", T.LongType()), T.StructField("pos", T.LongType())])


class OrderDetails:
    """Order lines with order, activity and coupon as an upsert table by line."""

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 100):
        line = [c for c in S.ORDER_DETAIL if c not in ("user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "ts")]
        shapes = {"lines": _side(*line), "orders": _side("id", "user_id", "province_id"),
                  "activities": _side("id", "activity_id", "activity_rule_id"), "coupons": _side("id", "coupon_id")}
        self.sides = {n: UpsertTable(spark, f"{path}/{n}", ["id"], trade.VERSION, shape) for n, shape in shapes.items()}
        result = T.StructType([*S.fact_schema(S.ORDER_DETAIL).fields, T.StructField("batch", T.LongType())])
        self.result = UpsertTable(spark, f"{path}/result", ["id"], ["batch"], result)
        self.spark, self.fresh, self.compact_every = spark, f"{path}/fresh", compact_every

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Take a batch of row changes; repeating it changes nothing."""
        tables = [*self.sides.values(), self.result]
        if batch_id and batch_id % self.compact_every == 0:
            for table in tables:
                table.compact(before=batch_id)
        fresh = dict(zip(self.sides, trade.order_sides(self._landed(changes, batch_id))))
        for name, table in self.sides.items():
            # a side without changes gets no directory: as long as it has one only, it is read without merging
            if not fresh[name].isEmpty():
                table.write_batch(fresh[name], batch_id)
                free_shuffles(self.spark)
        delete(self.spark, f"{self.fresh}/batch_id={batch_id}")
        upto = {n: table.read(before=batch_id + 1) for n, table in self.sides.items()}
        fresh = {n: table.raw(before=batch_id + 1, since=batch_id) for n, table in self.sides.items()}
        touched = None
        try:
            # in a first batch every line is touched and none was there
            now, gone = {**upto, "lines": upto["lines"].where("id is not null")}, None
            if any(table._live(before=batch_id)["base"] or table._live(before=batch_id)["delta"] for table in tables):
                own = [fresh[n].select("id") for n in ("lines", "activities", "coupons")]
                of_orders = upto["lines"].join(fresh["orders"].select(F.col("id").alias("order_id")), "order_id", "left_semi").select("id")
                touched = own[0].union(own[1]).union(own[2]).union(of_orders).distinct().persist()
                now = {n: upto[n].join(touched, "id", "left_semi") for n in ("lines", "activities", "coupons")}
                now["orders"] = upto["orders"].join(now["lines"].select(F.col("order_id").alias("id")), "id", "left_semi")
                gone = self.result.read(before=batch_id).select("id").join(touched, "id", "left_semi")
            lines = joins.joined_lines(*[now[n] for n in self.sides]).select(*S.ORDER_DETAIL)
            put = lines.withColumn("deleted", F.lit(False))
            if gone is not None:
                gone = gone.join(lines.select("id"), "id", "left_anti").withColumn("deleted", F.lit(True))
                put = put.unionByName(gone, allowMissingColumns=True)
            # a row a line by now: nothing is left to merge
            self.result._put(put.withColumn("batch", F.lit(batch_id).cast("bigint")), "delta", batch_id)
        finally:
            if touched is not None:
                touched.unpersist()
        free_shuffles(self.spark)

    def _landed(self, changes: DataFrame, batch_id: int) -> DataFrame:
        """The changes that count, parsed once into files: kept by Spark they would go to disk unpacked."""
        own = F.col("table").isin(*trade.ORDER_TABLES) & (F.col("type") == "insert")
        land_changes(changes.where(own), self.fresh, batch_id)
        return landed_changes(self.spark, f"{self.fresh}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        return self.result.read().drop("batch")

    def changelog(self, batch_id: int) -> DataFrame:
        """What a batch put (``deleted`` false) or took back."""
        return self.result._scan("delta", [batch_id]).drop("batch")


class WideDimension:
    """A chain of dimensions as one wide table, kept up to date from changes of any of them.

    A change of a dimension touches the members that reach its row; they are found hop by hop
    backwards, worked out anew and put in the place of what was there.
    """

    def __init__(self, dims: DimTables, path: str, hops: Sequence[Hop] = SKU_CHAIN):
        self.dims, self.hops, self.key = dims, hops, hops[0].key
        columns = [T.StructField(c, T.StringType()) for c in [self.key, *joins.chain_columns(hops)]]
        self.table = UpsertTable(dims.spark, path, [self.key], ["batch"], T.StructType([*columns, T.StructField("batch", T.LongType())]))

    def _members(self, folded: DataFrame) -> dict[str, DataFrame]:
        """The dimensions as wide tables, out of one fold of all of them."""
        def table(hop: Hop) -> DataFrame:
            cells = [F.col("data")[c].alias(c) for c in dict.fromkeys(hop.take.values()) if c != hop.dim_key]
            return folded.where(F.col("sink_table") == hop.dim).select(F.col("row_key").alias(hop.dim_key), *cells)

        return {hop.dim: table(hop) for hop in self.hops}

    def _touched(self, members: dict[str, DataFrame], batch_id: int) -> DataFrame:
        """Keys of the members that a batch of the dimension tables concerns."""
        changes = self.dims.raw(before=batch_id + 1, since=batch_id).select("sink_table", "row_key").distinct()
        reach = joins.wide_dimension(members, self.hops)
        parts = [self._own(changes, self.hops[0]).withColumnRenamed("row_key", self.key)]
        if self._renewed(batch_id):
            parts += [reach.select(self.key), self.table.read(before=batch_id).select(self.key)]
        met = F.lit(False)
        for hop in self.hops[1:]:
            own = self._own(changes, hop).select(F.col("row_key").alias(f"_{hop.key}"))
            reach = reach.join(own, F.col(hop.key) == F.col(f"_{hop.key}"), "left")
            met = met | F.col(f"_{hop.key}").isNotNull()
        parts.append(reach.where(met).select(self.key))
        return reduce(DataFrame.union, parts).distinct()

    def _renewed(self, batch_id: int) -> bool:
        """Whether a batch tells that one of the tables was dropped or created anew."""
        def last(before: int) -> set[tuple]:
            resets = self.dims.raw(before).where((F.col("type") == RESET) & F.col("sink_table").isin([hop.dim for hop in self.hops]))
            return {tuple(r) for r in resets.groupBy("sink_table").agg(F.max("version")).collect()}

        return last(batch_id + 1) != last(batch_id)

    @staticmethod
    def _own(changes: DataFrame, hop: Hop) -> DataFrame:
        return changes.where(F.col("sink_table") == hop.dim).select("row_key").where("row_key is not null")

    def update(self, batch_id: int) -> None:
        """Take in what batch ``batch_id`` wrote to the dimension tables; repeating it changes nothing."""
        folded = self.dims.read().where(F.col("sink_table").isin([hop.dim for hop in self.hops])).persist()
        touched = None
        try:
            now = self._members(folded)
            touched = self._touched(now, batch_id).persist()
            first = self.hops[0]
            now[first.dim] = now[first.dim].join(touched.withColumnRenamed(self.key, first.dim_key), first.dim_key, "left_semi")
            fresh = joins.wide_dimension(now, self.hops)
            gone = touched.join(fresh.select(self.key), self.key, "left_anti").withColumn("deleted", F.lit(True))
            put = fresh.withColumn("deleted", F.lit(False)).unionByName(gone, allowMissingColumns=True)
            self.table.write_batch(put.withColumn("batch", F.lit(batch_id).cast("bigint")), batch_id)
        finally:
            for frame in (folded, touched):
                if frame is not None:
                    frame.unpersist()

    def read(self) -> DataFrame:
        return self.table.read().drop("batch")
