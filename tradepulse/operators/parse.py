"""Parsing of raw text feeds and the row filters in front of every job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import functions as fx

CORRUPT = "_corrupt"


def parse_json(raw: DataFrame, schema: T.StructType, keep: Sequence[str] = (),
               corrupt: str | None = None) -> DataFrame:
    """Expand the JSON text column ``value`` into the columns of ``schema``.

    The parse sits inside a generator on purpose. As a plain projection the optimizer
    copies ``from_json`` into every filter above it and the text is parsed once per
    predicate; through ``inline`` each text is parsed exactly once.
    """
    options = {"mode": "PERMISSIVE"}
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    return raw.select(*keep, F.inline(F.array(F.from_json("value", schema, options))))


def parse_with_quarantine(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Every text, parsed, with ``bad`` telling the texts that are no such JSON object.

    Tombstones (empty texts) are bad too. Route ``where(bad)`` to a quarantine table and
    go on with ``where(~bad)``.
    """
    parsed = parse_json(raw, schema, keep=["value"], corrupt=CORRUPT)
    # An empty text and a bare JSON null leave no corrupt record, only null fields.
    blank = F.trim("value").isin("", "null") | F.col("value").isNull()
    return parsed.withColumn("bad", blank | F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("bad")).drop("bad", "value")


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where("bad").select("value")


# -- row filters -------------------------------------------------------------------

def _all_present(*cols: Column) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & c.isNotNull()
    return out


def row_changes(changes: DataFrame, database: str) -> DataFrame:
    """Changes of one database that carry data; the bootstrap markers carry none."""
    return changes.where(
        (F.col("database") == database)
        & ~F.coalesce(F.col("type"), F.lit("")).isin("bootstrap-start", "bootstrap-complete")
        & (F.size(F.map_keys("data")) > 0)
    )


def behaviour_logs(logs: DataFrame) -> DataFrame:
    """Logs with a page or a start part that can be keyed by device and time."""
    mid, ts = F.col("common")["mid"], F.col("ts")
    return logs.where((F.col("page").isNotNull() | F.col("start").isNotNull())
                      & _all_present(mid, ts))


def page_views(pages: DataFrame) -> DataFrame:
    return pages.where(_all_present(F.col("common")["mid"], F.col("ts")))


def home_and_detail(pages: DataFrame, home: str = "home", detail: str = "good_detail") -> DataFrame:
    return pages.where(F.col("page")["page_id"].isin(home, detail)
                       & _all_present(F.col("common")["mid"], F.col("ts")))


def login_visits(pages: DataFrame) -> DataFrame:
    """Visits of a known user that open the app logged in or come from the login page."""
    last = F.col("page")["last_page_id"]
    return pages.where(_all_present(F.col("common")["uid"], F.col("ts"), F.col("page"))
                       & (last.isNull() | (last == "login")))


def registrations(rows: DataFrame) -> DataFrame:
    """Register facts with their time; unreadable times belong to the quarantine."""
    return (rows.where(_all_present(F.col("create_time"), F.col("id")))
            .withColumn("row_time", fx.parse_datetime("create_time"))
            .where(F.col("row_time").isNotNull())
            .withColumn("register_ct", F.lit(1).cast("bigint")))


def timed_facts(rows: DataFrame, *required: str) -> DataFrame:
    """Facts with all ``required`` fields, ``ts`` in seconds read as ``row_time``."""
    return (rows.where(_all_present(F.col("ts"), *[F.col(c) for c in required]))
            .withColumn("row_time", fx.from_seconds("ts")))


def cart_facts(rows: DataFrame) -> DataFrame:
    return timed_facts(rows, "user_id")


def sku_order_facts(rows: DataFrame) -> DataFrame:
    return timed_facts(rows, "id", "sku_id")


def province_order_facts(rows: DataFrame) -> DataFrame:
    return timed_facts(rows, "id", "order_id", "province_id")


def is_search() -> Column:
    """Views that come from the search page by keyword."""
    page = F.col("page")
    return (page["last_page_id"] == "search") & (page["item_type"] == "keyword") & page["item"].isNotNull()


def search_keywords(pages: DataFrame) -> DataFrame:
    """Search texts: views that come from the search page by keyword."""
    return pages.where(is_search()).select(F.col("page")["item"].alias("keywords"), "row_time")
