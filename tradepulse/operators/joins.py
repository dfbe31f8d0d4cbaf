"""Joins of facts with facts and of facts with dimensions.

No side is ever forced to be broadcast. The planner does so by itself for sides below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both; a hot key is then
split by AQE's skew join.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse.operators.changelog import latest_by_key


def last_version(side: DataFrame) -> DataFrame:
    """The last version by ``id``: by time, then by the place of arrival where the side has it."""
    return latest_by_key(side, ["id"], ["ts", *[c for c in ("pos",) if c in side.columns]])


def order_lines(details: DataFrame, orders: DataFrame, activities: DataFrame,
                coupons: DataFrame) -> DataFrame:
    """Order lines with their order and, where there are any, activity and coupon.

    The target is an upsert table keyed by line, so only the last version of each side can
    show in it. Taking those versions first keeps every join one to one (lines of an order
    excepted): copies of a line never multiply with copies of its activity. The joins by
    line come first, since the lines already lie hashed by their id; only the last one, by
    order, moves them again. Versions of one second are told apart by ``pos``, their place in the topic.
    """
    return joined_lines(*[last_version(side) for side in (details, orders, activities, coupons)])


def joined_lines(details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame) -> DataFrame:
    """:func:`order_lines` of sides that hold one version of each id already."""
    details = details.drop("pos")
    orders, activities, coupons = [side.drop("ts", "pos") for side in (orders, activities, coupons)]
    return (details
            .join(activities, "id", "left")
            .join(coupons, "id", "left")
            .join(orders.withColumnRenamed("id", "order_id"), "order_id", "inner"))


def interval_join(points: DataFrame, anchors: DataFrame, on: Sequence[str], point_time: str,
                  anchor_time: str, before: int, after: int, how: str = "inner") -> DataFrame:
    """Pairs with equal ``on`` and ``point_time`` in [anchor - before, anchor + after] seconds.

    Both sides are cut into time slots as wide as the interval; an anchor is copied to the
    two slots (at most) its interval touches, a point stays in one. The slot is part of
    the join key: a hot key is spread over its slots and only rows near in time meet.
    Make the smaller side ``anchors``. On streams both times need a watermark, which then
    bounds the state kept of either side. ``how`` may be ``left``: a point has one slot only,
    so it is kept once where nothing matches.
    """
    width = max(before + after, 1)
    slot = lambda c: F.floor(F.unix_seconds(c) / F.lit(width))
    lo = F.col(anchor_time) - F.expr(f"INTERVAL {before} SECONDS")
    hi = F.col(anchor_time) + F.expr(f"INTERVAL {after} SECONDS")
    p = points.withColumn("_slot", slot(F.col(point_time)))
    a = anchors.select("*", F.explode(F.sequence(slot(lo), slot(hi))).alias("_slot"))
    for name in (*on, "_slot"):
        a = a.withColumnRenamed(name, f"_a_{name}")
    cond = F.col(point_time).between(lo, hi)
    for name in (*on, "_slot"):
        cond = cond & (F.col(name) == F.col(f"_a_{name}"))
    return p.join(a, cond, how).drop("_slot", *[f"_a_{n}" for n in (*on, "_slot")])


def lookup(facts: DataFrame, dim: DataFrame, key: str, dim_key: str,
           take: Mapping[str, str], how: str = "left") -> DataFrame:
    """Add ``{output: dim column}`` for the dim row whose ``dim_key`` equals ``key``.

    The generic dimension join: ``left`` passes misses through with nulls, ``inner`` drops
    them. On a stream ``dim`` is the snapshot read for the micro-batch.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"),
                      *[F.col(src).alias(out) for out, src in take.items()])
    return facts.join(side, F.col(key) == F.col("_dim_key"), how).drop("_dim_key")


def within(left: DataFrame, right: DataFrame, on: Sequence[str], seconds: int | None,
           how: str = "inner", time: str = "row_time") -> DataFrame:
    """Equi-join of two feeds that both carry ``time``; the left one's is kept.

    With ``seconds`` only rows at most that far apart meet. A stream needs that bound to let
    go of its state; without it, as in batch, all rows with equal keys meet.
    """
    side = right.withColumnRenamed(time, "_side_time")
    if seconds is None:
        return left.join(side.drop("_side_time"), list(on), how)
    return interval_join(left, side, on, time, "_side_time", seconds, seconds, how).drop("_side_time")


@dataclass(frozen=True)
class Hop:
    """One step of a dimension chain."""

    dim: str
    key: str
    take: Mapping[str, str]
    dim_key: str = "id"


#: sku -> spu, sku -> category 3 -> 2 -> 1, sku -> trademark
SKU_CHAIN = (
    Hop("dim_sku_info", "sku_id", {"category3_id": "category3_id", "trademark_id": "tm_id",
                                   "spu_id": "spu_id", "sku_name": "sku_name"}),
    Hop("dim_spu_info", "spu_id", {"spu_name": "spu_name"}),
    Hop("dim_base_category3", "category3_id", {"category3_name": "name",
                                               "category2_id": "category2_id"}),
    Hop("dim_base_category2", "category2_id", {"category2_name": "name",
                                               "category1_id": "category1_id"}),
    Hop("dim_base_category1", "category1_id", {"category1_name": "name"}),
    Hop("dim_base_trademark", "trademark_id", {"trademark_name": "tm_name"}),
)


def dim_chain(facts: DataFrame, dims: Mapping[str, DataFrame],
              hops: Sequence[Hop] = SKU_CHAIN) -> DataFrame:
    """Left lookups along a chain; a miss leaves nulls from its hop on."""
    for hop in hops:
        facts = lookup(facts, dims[hop.dim], hop.key, hop.dim_key, hop.take)
    return facts


def chain_columns(hops: Sequence[Hop] = SKU_CHAIN) -> list[str]:
    return [out for hop in hops for out in hop.take]


def wide_dimension(dims: Mapping[str, DataFrame], hops: Sequence[Hop] = SKU_CHAIN) -> DataFrame:
    """The chain worked out on its first dimension: ``key`` and all looked-up columns, a row per member.

    Facts of any size then need one join; the hops are joins of the dimension's size.
    """
    first = hops[0]
    members = dims[first.dim].select(F.col(first.dim_key).alias(first.key)).where(F.col(first.key).isNotNull())
    return dim_chain(members, dims, hops)


def dim_wide(facts: DataFrame, wide: DataFrame, key: str = "sku_id") -> DataFrame:
    """Left lookup of all columns of a wide dimension."""
    return facts.join(wide, key, "left")


class CachedDims:
    """Dimension snapshots held in executor storage and read again after ``ttl`` seconds."""

    def __init__(self, spark: SparkSession, loader, ttl: float = 24 * 3600):
        self._spark, self._loader, self._ttl = spark, loader, ttl
        self._held: dict[str, tuple[float, DataFrame]] = {}

    def get(self, name: str) -> DataFrame:
        held = self._held.get(name)
        if held and time.monotonic() - held[0] < self._ttl:
            return held[1]
        self.invalidate(name)
        fresh = self._loader(self._spark, name).persist()
        self._held[name] = (time.monotonic(), fresh)
        return fresh

    def invalidate(self, name: str) -> None:
        held = self._held.pop(name, None)
        if held:
            held[1].unpersist()
