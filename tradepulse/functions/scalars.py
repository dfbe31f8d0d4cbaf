"""Time, map and decimal helpers. Every one returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradepulse.schemas import MONEY

# The three output formats.
DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"
PARTITION_DATE = "yyyyMMdd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_millis(c: Column | str) -> Column:
    return F.timestamp_millis(_col(c))


def from_seconds(c: Column | str) -> Column:
    return F.timestamp_seconds(_col(c))


def date_text(c: Column | str) -> Column:
    return F.date_format(_col(c), DATE)


def datetime_text(c: Column | str) -> Column:
    return F.date_format(_col(c), DATETIME)


def partition_text(c: Column | str) -> Column:
    return F.date_format(_col(c), PARTITION_DATE)


def parse_datetime(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a timestamp, null where it does not parse."""
    return F.try_to_timestamp(_col(c), F.lit(DATETIME))


def datetime_to_millis(c: Column | str) -> Column:
    return F.unix_millis(parse_datetime(c))


def date_to_millis(c: Column | str) -> Column:
    return datetime_to_millis(F.concat(_col(c), F.lit(" 00:00:00")))


def to_long(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def money(c: Column | str) -> Column:
    return _col(c).try_cast(MONEY)


def money_or_zero(c: Column | str) -> Column:
    return F.coalesce(money(c), F.lit(0).cast(MONEY))


def keep_keys(data: Column | str, csv: Column | str) -> Column:
    """Only the map entries whose key is named in the comma-separated list."""
    names = F.split(_col(csv), ",")
    return F.map_filter(_col(data), lambda k, _v: F.array_contains(names, k))


def snake_name(name: str) -> str:
    out = []
    for ch in name:
        out.append("_" + ch.lower() if ch.isupper() else ch)
    return "".join(out)


def camel_name(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)
