"""The eighteen jobs of the warehouse as :class:`~tradepulse.streaming.jobs.Job`.

``Shop`` says where feeds come from and where tables go. Each function builds one job; ``JOBS`` lists them
in the order in which they feed each other. The five log topics have one commit; facts are appended
topics or upsert tables by key, window tables one directory a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import schemas as S
from tradepulse.operators import joins, logsplit, parse
from tradepulse.plans import base, trade
from tradepulse.plans import windows as tables
from tradepulse.session import delete, free_shuffles
from tradepulse.sinks import topics as out
from tradepulse.sinks.fanout import FanOut
from tradepulse.sinks.keyed import DimTables, UpsertTable
from tradepulse.sources import topics
from tradepulse.sources.topics import Topic
from tradepulse.streaming import firstdays, stores
from tradepulse.streaming.jobs import Job, each_batch
from tradepulse.streaming.views import OrderDetails, WideDimension

Read = Callable[[], DataFrame]
#: An upsert topic as files: a payload, or none for a deletion, with its key and place.
KEYED = "key string, value string, offset bigint"


@dataclass(frozen=True)
class Shop:
    """Feeds, lookups and the folder of everything the jobs write."""

    root: str
    log: Topic
    db: Topic
    database: str
    dim_config: Read
    fact_config: Read
    dictionary: Read
    provinces: Read
    #: the wide article dimension, see ``ArticleDimension`` and ``joins.wide_dimension``
    articles: Read
    #: fact topics that other jobs read, by name
    facts: Mapping[str, Topic] = field(default_factory=dict)
    #: seconds within which the parts of a joined fact come, and from a line to its payment (before, after)
    together: int = 905
    paid: tuple[int, int] = (5, 900)
    #: how long a version of an order line is remembered
    keep_versions: str | None = "30 seconds"
    #: whether the dimension job keeps the wide article dimension (:func:`article_dimension`) as well
    keep_articles: bool = False
    size: str = "10 seconds"

    def path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    def topics(self, spark: SparkSession) -> FanOut:
        return FanOut(spark, self.path("log"), logsplit.TOPICS)

    def fact(self, name: str) -> Topic:
        own = Topic(name, self.path("facts", name))
        if name == "order_detail":
            own = Topic(name, self.path("facts", name, "*"), file_format="parquet", columns=KEYED)
        return self.facts.get(name) or own


def _job(shop: Shop, name: str, source: Callable[[SparkSession], DataFrame], sink) -> Job:
    return Job(name, source, lambda rows: rows, sink, shop.path("checkpoints", name))


def _changes(shop: Shop) -> Callable[[SparkSession], DataFrame]:
    return lambda spark: topics.change_envelope(topics.raw_text(spark, shop.db))


def _appended(shop: Shop, name: str, fact: Callable[[DataFrame], DataFrame]) -> Job:
    """A job from row changes to an appended fact topic."""
    sink = lambda rows: out.append_stream(out.json_payload(fact(rows)), shop.path("facts", name), shop.path("checkpoints", name))
    return _job(shop, name, _changes(shop), sink)


# -- base layer --------------------------------------------------------------------------

def log_split(spark: SparkSession, shop: Shop) -> Job:
    split = lambda logs: {name: logsplit.as_json(name, rows) for name, rows in logsplit.split(logs).items()}
    write = firstdays.repair(firstdays.FirstDays(spark, shop.path("state", "first-days")), shop.topics(spark).writer(split))
    logs = lambda s: parse.behaviour_logs(parse.parse_json(topics.raw_text(s, shop.log), S.LOG))
    return _job(shop, "log_split", logs, lambda rows: each_batch(rows, write))


def article_dimension(spark: SparkSession, shop: Shop) -> WideDimension:
    return WideDimension(DimTables(spark, shop.path("dims")), shop.path("articles"))


def dim_sync(spark: SparkSession, shop: Shop) -> Job:
    wide = article_dimension(spark, shop)
    sync = base.dim_sync_batch(wide.dims, shop.dim_config, shop.database)

    def write(changes: DataFrame, batch_id: int) -> None:
        sync(changes, batch_id)
        if shop.keep_articles:
            wide.update(batch_id)

    return _job(shop, "dim_sync", _changes(shop), lambda rows: each_batch(rows, write))


def fact_router(spark: SparkSession, shop: Shop) -> Job:
    write = base.fact_router_batch(shop.fact_config, shop.path("routed"))
    return _job(shop, "fact_router", _changes(shop), lambda rows: each_batch(rows, write))


# -- facts -------------------------------------------------------------------------------

def cart_add(_spark: SparkSession, shop: Shop) -> Job:
    return _appended(shop, "cart_add", trade.cart_add)


def comment_info(_spark: SparkSession, shop: Shop) -> Job:
    return _appended(shop, "comment_info", lambda changes: trade.comment_info(changes, shop.dictionary()))


def order_detail(spark: SparkSession, shop: Shop) -> Job:
    """A table of lines and the topic of its changes: a late activity corrects its line in both."""
    view = OrderDetails(spark, shop.path("order_detail"))
    topic = FanOut(spark, shop.path("facts"), ["order_detail"], KEYED)

    def each(changes: DataFrame, batch_id: int) -> None:
        view.write_batch(changes, batch_id)
        rows = view.changelog(batch_id)
        payload = F.when(~F.col("deleted"), F.to_json(F.struct(*S.ORDER_DETAIL)))
        topic.write_batch({"order_detail": rows.select(F.col("id").alias("key"), payload.alias("value"), F.lit(batch_id).cast("bigint").alias("offset"))}, batch_id)

    return _job(shop, "order_detail", _changes(shop), lambda rows: each_batch(rows, each))


def _details(spark: SparkSession, shop: Shop) -> DataFrame:
    return topics.fact_reread(topics.raw_text(spark, shop.fact("order_detail")), S.ORDER_DETAIL, timed=True)


#: A fold of an interval join's sides comes each so many batches; rows may be so many seconds late.
FOLD, LATE = 100, 15


def _joined(spark: SparkSession, shop: Shop, name: str, sides: Sequence[T.StructType], rows, join) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function from ``rows`` of the sides in a batch to an appended fact topic."""
    store = stores.JoinedSides(spark, shop.path("state", name), sides, shop.together * (len(sides) - 1) + LATE)

    def each(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % FOLD == 0:
            store.compact(before=batch_id)
        store.add(rows(batch, batch_id), batch_id)
        out.write_text(out.json_payload(store.joined(batch_id, join)), shop.path("facts", name), batch_id)
        free_shuffles(spark)

    return each


def _timed(*names: str) -> T.StructType:
    return T.StructType([*S.fact_schema(list(names)).fields, T.StructField("row_time", T.TimestampType())])


def order_cancel(spark: SparkSession, shop: Shop) -> Job:
    """Lines and cancellations wait for each other in a table beside the stream."""
    lines = _timed(*[c for c in S.ORDER_DETAIL if c not in ("user_id", "province_id")])
    join = lambda *sides: joins.within(*sides, ["order_id"], shop.together).select(*S.ORDER_DETAIL)
    each = _joined(spark, shop, "order_cancel", [lines, _timed("order_id", "user_id", "province_id")], lambda rows, _n: rows, join)
    source = lambda s: stores.numbered([_details(s, shop).select(*lines.names), trade.cancelled_orders(_changes(shop)(s), ["row_time"])])
    return _job(shop, "order_cancel", source, lambda rows: each_batch(rows, each))


def paid_table(spark: SparkSession, shop: Shop) -> UpsertTable:
    places = [T.StructField(c, T.LongType()) for c in trade.PAID_VERSION[1:]]
    schema = T.StructType([*S.fact_schema(S.PAYMENT_SUCCESS).fields, *places])
    return UpsertTable(spark, shop.path("pay_success"), ["id"], trade.PAID_VERSION, schema)


def pay_success(spark: SparkSession, shop: Shop) -> Job:
    before, after = shop.paid
    source = lambda s: trade.pay_success(_details(s, shop), _changes(shop)(s), shop.dictionary(), before, after, trade.PAID_VERSION[1:])
    return _job(shop, "pay_success", source, lambda rows: each_batch(rows, paid_table(spark, shop).write_batch))


def order_refund(_spark: SparkSession, shop: Shop) -> Job:
    return _appended(shop, "order_refund", lambda changes: trade.order_refund(changes, shop.dictionary(), shop.together))


def refund_pay(spark: SparkSession, shop: Shop) -> Job:
    """Payments, refunds and orders wait for each other in a table beside the stream; a batch is parsed once into files."""
    fresh = shop.path("state", "refund_pay_changes")

    def rows(changes: DataFrame, batch_id: int) -> DataFrame:
        out.land_changes(changes.where(F.col("table").isin(*trade.REFUND_TABLES) & (F.col("type") == "update")), fresh, batch_id)
        return stores.numbered(trade.refund_sides(topics.landed_changes(spark, f"{fresh}/batch_id={batch_id}"), ["row_time"]))

    sides = [_timed("id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount", "ts"),
             _timed("order_id", "sku_id", "refund_num"), _timed("order_id", "user_id", "province_id")]
    join = lambda *parts: trade.named_refunds(trade.refund_parts(*parts, shop.together), shop.dictionary())
    work = _joined(spark, shop, "refund_pay", sides, rows, join)

    def each(changes: DataFrame, batch_id: int) -> None:
        work(changes, batch_id)
        delete(spark, f"{fresh}/batch_id={batch_id}")

    return _job(shop, "refund_pay", _changes(shop), lambda rows: each_batch(rows, each))


# -- window tables -------------------------------------------------------------------------

def _pages(payloads: DataFrame) -> DataFrame:
    return topics.json_table(payloads, S.PAGE).withColumn("row_time", F.timestamp_millis("ts"))


def _of_pages(form, name: str, spark: SparkSession, shop: Shop) -> Job:
    """A window table over the page topic, whose batches it follows by their commits."""
    work = form(spark, shop.path("state", name), out.window_table_batch(shop.path("windows", name)), shop.size)
    each = shop.topics(spark).following("page", lambda payloads, n: work(_pages(payloads), n))
    return _job(shop, name, lambda s: FanOut(s, shop.path("log"), logsplit.TOPICS).commits(), lambda rows: each_batch(rows, each))


def _of_facts(form, name: str, fact: str, columns, spark: SparkSession, shop: Shop) -> Job:
    work = form(spark, shop.path("state", name), out.window_table_batch(shop.path("windows", name)))
    source = lambda s: columns(topics.raw_text(s, shop.fact(fact)))
    return _job(shop, name, source, lambda rows: each_batch(rows, work))


def _carts(raw: DataFrame) -> DataFrame:
    return topics.json_table(raw, S.fact_schema(S.CART_ADD))


def _registers(raw: DataFrame) -> DataFrame:
    return topics.json_table(raw, S.strings("create_time", "id"))


def _lines(raw: DataFrame) -> DataFrame:
    return topics.fact_reread(raw, S.ORDER_DETAIL)


def register(spark: SparkSession, shop: Shop) -> Job:
    source = lambda s: tables.registers_stream(_registers(topics.raw_text(s, shop.fact("register"))), shop.size)
    return _job(shop, "register", source, lambda rows: each_batch(rows, out.window_table_batch(shop.path("windows", "register"))))


def cart_users(spark: SparkSession, shop: Shop) -> Job:
    return _of_facts(partial(tables.cart_users_batches, size=shop.size), "cart_users", "cart_add", _carts, spark, shop)


def sku_orders(spark: SparkSession, shop: Shop) -> Job:
    form = partial(tables.sku_orders_batches, articles=shop.articles, size=shop.size, keep=shop.keep_versions)
    return _of_facts(form, "sku_orders", "order_detail", _lines, spark, shop)


def province_orders(spark: SparkSession, shop: Shop) -> Job:
    form = partial(tables.province_orders_batches, provinces=shop.provinces, size=shop.size, keep=shop.keep_versions)
    return _of_facts(form, "province_orders", "order_detail", _lines, spark, shop)


JOBS: dict[str, Callable[[SparkSession, Shop], Job]] = {
    "log_split": log_split, "dim_sync": dim_sync, "fact_router": fact_router,
    "cart_add": cart_add, "comment_info": comment_info, "order_detail": order_detail, "order_cancel": order_cancel,
    "pay_success": pay_success, "order_refund": order_refund, "refund_pay": refund_pay,
    "traffic": partial(_of_pages, tables.traffic_batches, "traffic"),
    "home_detail": partial(_of_pages, tables.home_detail_batches, "home_detail"),
    "keywords": partial(_of_pages, tables.keywords_batches, "keywords"),
    "logins": partial(_of_pages, tables.logins_batches, "logins"),
    "register": register, "cart_users": cart_users, "sku_orders": sku_orders, "province_orders": province_orders,
}
