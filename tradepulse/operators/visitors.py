"""New-visitor repair, daily unique and returning users.

The stateful job keeps one small value per device or user and reads rows in order. Over
complete data each of these steps has a closed form that needs no ordered walk through a
key's rows, only minima per key and day. That is what is written here: aggregations with
map-side combine, so a device that sends a third of all rows costs no task more than its
share. Streams work off their micro-batches with the same steps, see :mod:`tradepulse.streaming.stores`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_columns(pages: DataFrame) -> DataFrame:
    """The flat columns the visitor metrics read from a page log."""
    common, page = F.col("common"), F.col("page")
    return pages.select(
        common["mid"].alias("mid"), common["uid"].alias("uid"), common["vc"].alias("vc"),
        common["ch"].alias("ch"), common["ar"].alias("ar"), common["is_new"].alias("is_new"),
        page["page_id"].alias("page_id"), page["last_page_id"].alias("last_page_id"),
        F.coalesce(page["during_time"].try_cast("bigint"), F.lit(0)).alias("during_time"),
        "ts", F.timestamp_millis("ts").alias("row_time"))


#: Device and flag as columns of their own: of landed logs the repair's first step reads no more than these.
SHREDDED = {"_own_mid": "mid", "_own_flag": "is_new"}


def shredded(logs: DataFrame) -> DataFrame:
    return logs.withColumns({c: F.col("common")[name] for c, name in SHREDDED.items()})


def _own(logs: DataFrame, name: str) -> Column:
    column = next(c for c, n in SHREDDED.items() if n == name)
    return F.col(column) if column in logs.columns else F.col("common")[name]


def first_days(logs: DataFrame, key: Column | None = None) -> DataFrame:
    """``_mid, _first``: the day on which each device was new, from its first row flagged 0 or 1.

    That is the row's own date if flagged 1, the day before if flagged 0; on a tie the row
    flagged 1 decides. Devices without such a row are left out.
    """
    flag = _own(logs, "is_new")
    firsts = (logs.where(flag.isin("0", "1")).groupBy((_own(logs, "mid") if key is None else key).alias("_mid"))
              .agg(F.min(F.when(flag == "1", F.col("ts"))).alias("_new"),
                   F.min(F.when(flag == "0", F.col("ts"))).alias("_known")))
    day_of = lambda c: F.to_date(F.timestamp_millis(c))
    first_day = (F.when(F.col("_known").isNull() | (F.col("_new") <= F.col("_known")), day_of(F.col("_new")))
                 .otherwise(F.date_sub(day_of(F.col("_known")), 1)))
    return firsts.select("_mid", first_day.alias("_first"))


def with_true_flag(logs: DataFrame, firsts: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows flagged 1 on another date than the device's first day are reset to 0; other flags pass."""
    keyed = logs.withColumn("_mid", _own(logs, "mid") if key is None else key)
    stale = (F.col("common")["is_new"] == "1") & (F.to_date(F.timestamp_millis("ts")) != F.col("_first"))
    fixed = F.transform_values("common", lambda k, v: F.when((k == "is_new") & stale, F.lit("0")).otherwise(v))
    joined = keyed.join(firsts, "_mid", "left")
    return joined.select(*[fixed.alias(c) if c == "common" else F.col(c) for c in logs.columns if c not in SHREDDED])


def repair_new_flag(logs: DataFrame, key: Column | None = None) -> DataFrame:
    """Put the true ``is_new`` into ``common``: a device is new on its first day only."""
    return with_true_flag(logs, first_days(logs, key), key)


def flag_daily_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
                     out: str, time: str = "row_time") -> DataFrame:
    """Add ``out`` = 1 on the first row of each key and day, 0 on the rest.

    ``order`` must be unique within a key. The join is on key and day against one row per
    key and day; where one of them is hot, AQE splits the row side.
    """
    firsts = rows.groupBy(*keys, F.to_date(time).alias("_day")).agg(F.min(F.struct(*order)).alias("_f"))
    firsts = firsts.select(*keys, "_day", "_f.*")
    return with_first(rows, firsts, keys, order, out, time)


def with_first(rows: DataFrame, firsts: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, time: str = "row_time") -> DataFrame:
    """Add ``out`` = 1 on the rows that are, by ``order``, the row of ``firsts`` of their key and day."""
    first = firsts.select(*keys, "_day", F.struct(*order).alias("_first"))
    hit = F.struct(*order) == F.col("_first")
    return (rows.withColumn("_day", F.to_date(time)).join(first, [*keys, "_day"], "left")
            .select(*rows.columns, F.when(hit, 1).otherwise(0).cast("bigint").alias(out)))


def visit_metrics(pages: DataFrame) -> DataFrame:
    """Per page view: a session starts where no page came before; one view; its duration."""
    return pages.select(
        *pages.columns,
        F.when(F.col("last_page_id").isNull(), 1).otherwise(0).cast("bigint").alias("sv_ct"),
        F.lit(1).cast("bigint").alias("pv_ct"), F.col("during_time").alias("dur_sum"))


def unique_per_window(rows: DataFrame, key: str, out: str, dims: Sequence[str] = (),
                      measures: Sequence[str] = (), time: str = "row_time",
                      size: str = "10 seconds") -> DataFrame:
    """Merge rows per key, window and dims; mark the merged row holding the day's first.

    The rows are combined before anything is compared. What is left of a hot key for the
    per-day window is bounded by the number of windows in a day times its dims.
    """
    merged = (rows.groupBy(key, F.window(time, size).start.alias("_at"),
                           F.to_date(time).alias("_day"), *dims)
              .agg(F.min(time).alias("_first"), *[F.sum(m).alias(m) for m in measures]))
    first = F.row_number().over(
        Window.partitionBy(key, "_day").orderBy("_first", "_at", *dims)) == 1
    return merged.select(F.col("_at").alias(time), *dims, *measures,
                         F.when(first, 1).otherwise(0).cast("bigint").alias(out))


def daily_uniques(rows: DataFrame, keys: Sequence[str], time: str = "row_time") -> DataFrame:
    """One row per key and day, at the time of the day's first row."""
    return (rows.groupBy(*keys, F.to_date(time).alias("day")).agg(F.min(time).alias(time)))


def day_firsts(rows: DataFrame, keys: Sequence[str], rest: Sequence[str] = (), time: str = "row_time") -> DataFrame:
    """The first row of each key and day: ``keys, _day``, its time and ``rest``, which also settles equal times."""
    first = F.min(F.struct(time, *rest)).alias("_f") if rest else F.struct(F.min(time).alias(time)).alias("_f")
    return rows.groupBy(*keys, F.to_date(time).alias("_day")).agg(first).select(*keys, "_day", "_f.*")


def home_detail_uniques(pages: DataFrame, home: str = "home") -> DataFrame:
    """Daily unique devices of the home and the detail page, each counted by itself."""
    kinds = pages.withColumn("is_home", F.col("page_id") == home)
    hit = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    return (daily_uniques(kinds, ["mid", "is_home"])
            .select("mid", "row_time", hit(F.col("is_home")).alias("home_uv_ct"),
                    hit(~F.col("is_home")).alias("good_detail_uv_ct")))


def returning_users(visits: DataFrame, key: str = "uid", away_days: int = 7) -> DataFrame:
    """Daily unique users; ``back_ct`` = 1 after more than ``away_days`` of absence.

    Absence is measured from midnight of the last visited day. The lag runs over one row
    per user and day, so a user's group is no longer than the calendar.
    """
    days = daily_uniques(visits, [key]).withColumnRenamed("day", "_day")
    return returned(days, key, away_days)


def returned(days: DataFrame, key: str, away_days: int, known: str | None = None) -> DataFrame:
    """``back_ct`` and ``uu_ct`` of users' days (``_day``, ``row_time``); ``known`` names the last day known of before."""
    last = F.lag("_day").over(Window.partitionBy(key).orderBy("_day"))
    last = last if known is None else F.greatest(last, F.col(known))
    away = F.col("row_time") > last.cast("timestamp") + F.expr(f"INTERVAL {away_days} DAYS")
    return days.select(key, "row_time", F.when(away, 1).otherwise(0).cast("bigint").alias("back_ct"),
                       F.lit(1).cast("bigint").alias("uu_ct"))
