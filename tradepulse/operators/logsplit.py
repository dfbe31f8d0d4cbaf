"""Split of the behaviour log into its five topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOPICS = ("err", "start", "display", "action", "page")


def errors(logs: DataFrame) -> DataFrame:
    """The error part of any log, whatever else the log carries."""
    return logs.where(F.col("err").isNotNull()).select("err")


def starts(logs: DataFrame) -> DataFrame:
    """Whole start logs; a log with both a start and a page counts as a start."""
    return logs.where(F.col("start").isNotNull())


def _pages(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("start").isNull() & F.col("page").isNotNull())


def _items(logs: DataFrame, array: str, name: str) -> DataFrame:
    return _pages(logs).select(F.explode(array).alias(name), "common", "page", "ts")


def displays(logs: DataFrame) -> DataFrame:
    """One row per displayed item with the page it was on."""
    return _items(logs, "displays", "display")


def actions(logs: DataFrame) -> DataFrame:
    return _items(logs, "actions", "action")


def pages(logs: DataFrame) -> DataFrame:
    """Page logs without their item arrays; an error stays with its page."""
    return _pages(logs).drop("displays", "actions")


def split(logs: DataFrame) -> dict[str, DataFrame]:
    return {"err": errors(logs), "start": starts(logs), "display": displays(logs),
            "action": actions(logs), "page": pages(logs)}


def as_json(topic: str, rows: DataFrame) -> DataFrame:
    """The topic's text: an item's own fields lie beside ``common``, ``page`` and ``ts``."""
    if topic == "err":
        return rows.select(F.to_json("err").alias("value"))
    if topic in ("display", "action"):
        # two JSON objects become one by joining their bodies; the context's names win
        item = F.to_json(F.map_filter(topic, lambda k, _v: ~k.isin("common", "page", "ts")))
        context = F.to_json(F.struct("common", "page", "ts"))
        body = F.concat(F.expr("substring(_i, 1, length(_i) - 1)"),
                        F.when(F.col("_i") == "{}", "").otherwise(","), F.expr("substring(_c, 2)"))
        return rows.select(item.alias("_i"), context.alias("_c")).select(body.alias("value"))
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
