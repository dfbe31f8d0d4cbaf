"""The shop's feeds, made from the given tables.

Each feed is text, as the jobs would get it; the jobs' own parsing reads it again. Broken
texts and tombstones are part of the feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.operators import changelog, joins, parse
from tradepulse.session import landed as landed_rows
from tradepulse.session import scratch_dir
from tradepulse.sinks.topics import land_changes
from tradepulse.sources import tables, topics

DATABASE = "shop"
#: 2024-01-01, in seconds
START = 1_704_067_200


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a file stream; the pattern makes the single file a directory listing."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def cents(c: str) -> Column:
    return F.col(c).cast(S.MONEY).cast("string")


def moment(c: str) -> Column:
    return F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


def seconds(c: str) -> Column:
    return F.unix_seconds(F.col(c).cast("timestamp"))


def joined(prefix: str, *cols: str | Column) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("-", *[text(c) for c in cols]))


# -- behaviour log -----------------------------------------------------------------------

def log_columns(events: DataFrame) -> DataFrame:
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("bigint")
    uid = F.col("user_id")
    page_id = (F.when(kind == "click", "home").when(kind == "view", "good_detail")
               .when(kind == "purchase", "payment").otherwise(kind))
    last = (F.when(kind == "view", "search").when(kind == "purchase", "login")
            .when(kind == "signup", F.lit(None)).otherwise("home"))
    is_new = (F.when(k == 99, "2").when(kind.isin("signup", "view"), "1").otherwise("0"))
    item = lambda at: F.struct(joined("sku", k + at).alias("item"), F.lit(at).alias("pos"))
    return events.select(
        F.col("event_id").alias("offset"), k.alias("k"),
        F.struct(text(uid).alias("mid"), text(uid).alias("uid"), joined("v", uid % 3).alias("vc"),
                 joined("c", uid % 2).alias("ch"), joined("a", uid % 5).alias("ar"),
                 is_new.alias("is_new")).alias("common"),
        F.when(~((kind == "error") & (k < 20)), F.struct(
            page_id.alias("page_id"), last.alias("last_page_id"), k.alias("during_time"),
            F.when(kind == "view", "keyword").alias("item_type"),
            F.when((kind == "view") & (k > 10), F.concat(F.lit("Red shoe "), text(k))).alias("item"),
        )).alias("page"),
        F.when((kind == "signup") & (F.col("value") < 10), F.struct(
            F.lit("icon").alias("entry"), k.alias("loading_time"))).alias("start"),
        F.when(kind == "error", F.struct(k.alias("error_code"), F.lit("failed").alias("msg"))
               ).alias("err"),
        F.when(kind == "view", F.array(item(1), item(2)))
        .when(kind == "purchase", F.expr("filter(array(named_struct('item','','pos',0)), x -> false)")
              ).alias("displays"),
        F.when(kind == "click", F.array(F.struct(F.lit("cart_add").alias("action_id"),
                                                 joined("sku", k).alias("item")))).alias("actions"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"))


LOG_FIELDS = ["common", "page", "start", "err", "displays", "actions", "ts"]


def log_texts(events: DataFrame) -> DataFrame:
    """Raw log with truncated texts, arrays instead of objects, and tombstones among it."""
    whole = F.to_json(F.struct(*LOG_FIELDS))
    value = (F.when(F.col("k") == 13, F.substring(whole, 1, 25)).when(F.col("k") == 55, "[1, 2]")
             .when(F.col("k") == 77, F.lit(None).cast("string")).otherwise(whole))
    return topics.non_null_text(log_columns(events).select(value.alias("value"), "offset"))


def page_texts(events: DataFrame) -> DataFrame:
    """What the split leaves on the page topic, before the repair of ``is_new``."""
    rows = log_columns(events).where("page is not null and start is null and k not in (13, 55, 77)")
    return rows.select(F.to_json(F.struct("common", "page", "ts")).alias("value"), "offset")


def logs(events: DataFrame) -> DataFrame:
    return parse.behaviour_logs(parse.parse_json(log_texts(events), S.LOG, keep=["offset"]))


def landed_logs(spark: SparkSession, sf: str) -> DataFrame:
    """The same for the whole table, parsed once."""
    return topics.landed_logs(log_texts(table(spark, sf, "events")), scratch_dir(spark, "logs"), ["offset"])


def pages(events: DataFrame) -> DataFrame:
    return parse.parse_json(page_texts(events), S.PAGE, keep=["offset"])


def document_page_texts(documents: DataFrame) -> DataFrame:
    """Searches for whole documents; the text of one source is no keyword search."""
    page = F.struct(F.lit("good_list").alias("page_id"), F.lit("search").alias("last_page_id"),
                    F.when(F.col("source") == "src3", "promotion").otherwise("keyword").alias("item_type"),
                    F.col("text").alias("item"))
    common = F.struct(text("doc_id").alias("mid"))
    ts = F.lit(1704067200000) + F.col("doc_id") * 1000
    return documents.select(F.to_json(F.struct(
        common.alias("common"), page.alias("page"), ts.alias("ts"))).alias("value"))


def register_texts(events: DataFrame) -> DataFrame:
    """Register facts; some times cannot be read."""
    k = F.get_json_object("props", "$.k")
    at = F.when(k == "13", "not a time").otherwise(moment("ts"))
    return (events.where("event_type = 'signup'")
            .select(F.to_json(F.struct(at.alias("create_time"), text("user_id").alias("id"))
                              ).alias("value")))


# -- row changes -------------------------------------------------------------------------

def envelope(rows: DataFrame, name: str | Column, kind: str | Column, ts: Column, data: Column,
             old: Column | None = None, database: Column | None = None, offset: Column | None = None) -> DataFrame:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    fields = [(F.lit(DATABASE) if database is None else database).alias("database"),
              lit(name).alias("table"), lit(kind).alias("type"), ts.alias("ts"),
              data.alias("data")]
    if old is not None:
        fields.append(old.alias("old"))
    place = [] if offset is None else [offset.alias("offset")]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"), *place)


def line_id() -> Column:
    return joined("", "l_orderkey", "l_linenumber")


def line_fields() -> list[Column]:
    return [line_id().alias("id"), text("l_orderkey").alias("order_id"),
            text("l_partkey").alias("sku_id"), joined("sku-", "l_partkey").alias("sku_name"),
            cents("l_extendedprice").alias("order_price"),
            text(F.col("l_quantity").cast("bigint")).alias("sku_num"),
            moment("l_shipdate").alias("create_time"),
            cents("l_extendedprice").alias("split_total_amount"),
            cents("l_discount").alias("split_activity_amount"),
            cents("l_tax").alias("split_coupon_amount")]


def years(c: str) -> Column:
    """The start of the year: many versions of a line share it, and their places tell which came last."""
    return F.unix_seconds(F.date_trunc("year", F.col(c).cast("timestamp")))


def lines(spark, sf, when=seconds) -> DataFrame:
    return envelope(table(spark, sf, "lineitem"), "order_detail", "insert", when("l_shipdate"),
                    F.struct(*line_fields()), offset=line_place())


def orders(spark, sf) -> DataFrame:
    data = F.struct(text("o_orderkey").alias("id"), text("o_custkey").alias("user_id"),
                    text(F.col("o_custkey") % 25).alias("province_id"),
                    F.lit("1001").alias("order_status"))
    return envelope(table(spark, sf, "orders"), "order_info", "insert", seconds("o_orderdate"), data, offset=F.col("o_orderkey"))


def order_updates(spark, sf) -> DataFrame:
    status = (F.when(F.col("o_orderstatus") == "F", "1003")
              .when(F.col("o_orderstatus") == "P", "1005").otherwise("1006"))
    data = F.struct(text("o_orderkey").alias("id"), text("o_custkey").alias("user_id"),
                    text(F.col("o_custkey") % 25).alias("province_id"), status.alias("order_status"))
    low = F.col("o_orderpriority") == "5-LOW"
    old = F.struct(F.when(~low, "1001").alias("order_status"),
                   F.when(low, "somebody").alias("user_id"))
    return envelope(table(spark, sf, "orders"), "order_info", "update",
                    seconds("o_orderdate") + 60, data, old, offset=F.col("o_orderkey") + 10 ** 9)


def activities(spark, sf, when=seconds) -> DataFrame:
    rows = table(spark, sf, "lineitem").where("l_discount >= 0.05")
    data = F.struct(line_id().alias("order_detail_id"), joined("a", "l_linenumber").alias("activity_id"),
                    joined("r", "l_suppkey").alias("activity_rule_id"))
    return envelope(rows, "order_detail_activity", "insert", when("l_shipdate"), data, offset=line_place())


def coupons(spark, sf, when=seconds) -> DataFrame:
    rows = table(spark, sf, "lineitem").where("l_tax >= 0.06")
    data = F.struct(line_id().alias("order_detail_id"), joined("c", "l_suppkey").alias("coupon_id"))
    return envelope(rows, "order_detail_coupon", "insert", when("l_shipdate"), data, offset=line_place())


def payments(spark, sf) -> DataFrame:
    data = F.struct(joined("p", "o_orderkey").alias("id"), text("o_orderkey").alias("order_id"),
                    text("o_custkey").alias("user_id"),
                    F.concat(F.lit("110"), F.substring("o_orderpriority", 1, 1)).alias("payment_type"),
                    cents("o_totalprice").alias("total_amount"),
                    moment("o_orderdate").alias("callback_time"),
                    F.when(F.col("o_orderstatus") == "O", "1601").otherwise("1602").alias("payment_status"))
    medium = F.col("o_orderpriority") == "3-MEDIUM"
    old = F.struct(F.when(~medium, "1601").alias("payment_status"),
                   F.when(medium, "none").alias("callback_time"))
    return envelope(table(spark, sf, "orders"), "payment_info", "update", seconds("o_orderdate"),
                    data, old, offset=F.col("o_orderkey"))


def refunds(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    data = [joined("r", "l_orderkey", "l_linenumber", "l_partkey").alias("id"),
            joined("u", "l_suppkey").alias("user_id"), text("l_orderkey").alias("order_id"),
            text("l_partkey").alias("sku_id"),
            F.concat(F.lit("110"), text(F.col("l_linenumber") % 7)).alias("refund_type"),
            text(F.col("l_quantity").cast("bigint")).alias("refund_num"),
            cents("l_extendedprice").alias("refund_amount"),
            joined("13", "l_linenumber").alias("refund_reason_type"),
            F.lit("late").alias("refund_reason_txt"), moment("l_shipdate").alias("create_time")]
    asked = envelope(rows, "order_refund_info", "insert", seconds("l_shipdate"), F.struct(*data))
    done = envelope(rows.where("l_linestatus = 'F'"), "order_refund_info", "update",
                    seconds("l_shipdate") + 60,
                    F.struct(*data, F.lit("0705").alias("refund_status")),
                    F.struct(F.lit("0702").alias("refund_status")))
    return asked.union(done)


def refund_payments(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    data = F.struct(joined("rp", "l_orderkey", "l_linenumber", "l_partkey").alias("id"),
                    text("l_orderkey").alias("order_id"), text("l_partkey").alias("sku_id"),
                    F.concat(F.lit("110"), text(F.col("l_linenumber") % 7)).alias("payment_type"),
                    moment("l_shipdate").alias("callback_time"),
                    cents("l_extendedprice").alias("total_amount"),
                    F.when(F.col("l_tax") < 0.08, "1602").otherwise("1601").alias("refund_status"))
    return envelope(rows, "refund_payment", "update", seconds("l_shipdate") + 120, data,
                    F.struct(F.lit("1601").alias("refund_status")))


def carts(spark, sf) -> DataFrame:
    number = F.when(F.col("l_tax") == 0.08, "x").otherwise(text(F.col("l_quantity").cast("bigint")))
    data = F.struct(line_id().alias("id"), text("l_suppkey").alias("user_id"),
                    text("l_partkey").alias("sku_id"), cents("l_extendedprice").alias("cart_price"),
                    number.alias("sku_num"), joined("sku-", "l_partkey").alias("sku_name"),
                    F.lit("1").alias("is_checked"), moment("l_shipdate").alias("create_time"))
    other = F.col("l_returnflag") == "N"
    old = F.struct(F.when(~other, text(F.col("l_linenumber") * 7)).alias("sku_num"),
                   F.when(other, "0").alias("is_checked"))
    kind = F.when(F.col("l_linestatus") == "O", "insert").otherwise("update")
    return envelope(table(spark, sf, "lineitem"), "cart_info", kind, seconds("l_shipdate"), data, old)


def comments(spark, sf) -> DataFrame:
    lang = F.col("lang")
    code = F.when(lang == "en", "1101").when(lang == "fr", "1102").when(lang == "de", "1103").otherwise("1109")
    data = F.struct(text("doc_id").alias("id"), F.col("source").alias("user_id"),
                    lang.alias("nick_name"), text("doc_id").alias("sku_id"),
                    joined("s", "lang").alias("spu_id"), joined("o", "doc_id").alias("order_id"),
                    code.alias("appraise"), F.col("text").alias("comment_txt"),
                    F.lit("2024-01-01 00:00:00").alias("create_time"))
    return envelope(table(spark, sf, "documents"), "comment_info", "insert", F.col("doc_id"), data)


def user_changes(spark, sf) -> DataFrame:
    """Snapshot markers, snapshot rows, changes, and a foreign database."""
    segment = F.col("c_mktsegment")
    kind = (F.when(segment == "AUTOMOBILE", "bootstrap-start")
            .when(segment == "BUILDING", "bootstrap-insert").when(segment == "FURNITURE", "insert")
            .when(segment == "HOUSEHOLD", "update").otherwise("delete"))
    empty = (segment == "AUTOMOBILE") | (F.col("c_acctbal") < 0)
    data = F.struct(F.when(~empty, text("c_custkey")).alias("id"),
                    F.when(~empty, F.col("c_name")).alias("name"))
    base = F.when(F.col("c_nationkey") == 7, "warehouse").otherwise(DATABASE)
    return envelope(table(spark, sf, "customer"), "user_info", kind, F.col("c_custkey"), data,
                    database=base)


def routed_changes(spark, sf) -> DataFrame:
    """Changes of thirty tables, five of them unknown to the configuration.

    Up to eight changes share a second; they arrive in falling order of their order keys.
    """
    status = F.col("o_orderstatus")
    kind = F.when(status == "F", "insert").when(status == "O", "update").otherwise("delete")
    data = F.struct(text("o_orderkey").alias("id"), text("o_custkey").alias("user_id"),
                    F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("status"),
                    cents("o_totalprice").alias("total"))
    return envelope(table(spark, sf, "orders"), joined("table_", F.col("o_custkey") % 30), kind,
                    F.lit(START) + F.floor(F.col("o_orderkey") / 8), data, offset=F.lit(10 ** 12) - F.col("o_orderkey"))


def changes(*feeds: DataFrame) -> DataFrame:
    """Several tables' changes as one parsed feed."""
    raw = feeds[0]
    for feed in feeds[1:]:
        raw = raw.unionByName(feed, allowMissingColumns=True)
    return topics.change_envelope(topics.non_null_text(raw))


def landed(spark: SparkSession, *feeds: DataFrame) -> DataFrame:
    """The same, landed first: parsed once, then each view reads only its own partitions."""
    path = scratch_dir(spark, "changes")
    land_changes(changes(*feeds), path)
    return topics.landed_changes(spark, path)


# -- configuration, dictionary, dimensions -------------------------------------------------

def config_texts(spark, sf, fact: bool = False) -> DataFrame:
    """Captured config changes: customers in key order change the config of their nation."""
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    op = (F.when(segment == "MACHINERY", "c").when(segment == "BUILDING", "r")
          .when(segment == "HOUSEHOLD", "u").when(segment == "FURNITURE", "c").otherwise("d"))
    columns = (F.when(segment == "MACHINERY", "id,status").when(segment == "BUILDING", "id,user_id")
               .when(segment == "HOUSEHOLD", "status,total,nothing").otherwise("id,user_id,total"))

    def config(key: Column) -> Column:
        fields = [joined("table_", key).alias("source_table"), joined("sink_", nation).alias("sink_table"),
                  columns.alias("sink_columns")]
        if fact:
            kind = F.when(F.col("c_acctbal") < 5000, "insert").otherwise("update")
            fields.insert(1, kind.alias("source_type"))
        else:
            fields += [F.lit("info").alias("sink_family"), F.lit("user_id").alias("sink_row_key")]
        return F.struct(*fields)

    moved = F.when((segment == "HOUSEHOLD") & (F.col("c_acctbal") < 2000), (nation + 1) % 25).otherwise(nation)
    before = F.when(op.isin("u", "d"), config(moved))
    after = F.when(op != "d", config(nation))
    return table(spark, sf, "customer").select(F.to_json(F.struct(
        op.alias("op"), before.alias("before"), after.alias("after"),
        ((F.lit(START) + F.col("c_custkey")) * 1000 + 500).alias("ts_ms"))).alias("value"))


def config_changes(spark, sf, fact: bool = False) -> DataFrame:
    return tables.config_changes(config_texts(spark, sf, fact), S.FACT_CONFIG if fact else S.DIM_CONFIG)


def config_steps(spark, sf, fact: bool = False) -> DataFrame:
    key = ["source_table", "source_type"] if fact else ["source_table"]
    return changelog.config_steps(config_changes(spark, sf, fact), key, "ts_ms")


def dictionary(spark, sf) -> DataFrame:
    rows = table(spark, sf, "region")
    return tables.nested_dictionary(rows.select(
        F.concat(F.lit("110"), text("r_regionkey")).alias("dic_code"), F.col("r_name").alias("dic_name")))


def sku_dims(spark, sf) -> dict[str, DataFrame]:
    """Article, spu, three category levels and trademark; each level has some gaps."""
    part, nation, region = (table(spark, sf, n) for n in ("part", "nation", "region"))
    return {
        "dim_sku_info": part.where("p_size <> 50").select(
            text("p_partkey").alias("id"), text(F.col("p_size") % 30).alias("category3_id"),
            F.col("p_brand").alias("tm_id"), F.col("p_type").alias("spu_id"),
            F.col("p_name").alias("sku_name")),
        "dim_spu_info": part.where("p_type <> 'PROMO'").select("p_type").distinct().select(
            F.col("p_type").alias("id"), joined("spu ", "p_type").alias("spu_name")),
        "dim_base_category3": nation.select(
            text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            text("n_regionkey").alias("category2_id")),
        "dim_base_category2": region.where("r_regionkey <> 3").select(
            text("r_regionkey").alias("id"), F.col("r_name").alias("name"),
            text(F.col("r_regionkey") + 1).alias("category1_id")),
        "dim_base_category1": region.select(text("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "dim_base_trademark": part.select("p_brand").distinct().select(
            F.col("p_brand").alias("id"), joined("tm ", "p_brand").alias("tm_name")),
    }


def articles(spark, sf) -> DataFrame:
    """The wide article dimension, written once as its job keeps it."""
    return landed_rows(joins.wide_dimension(sku_dims(spark, sf)), "articles")


def provinces(spark, sf) -> DataFrame:
    return table(spark, sf, "nation").where("n_nationkey <> 4").select(
        text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


# -- fact topics -------------------------------------------------------------------------

def detail_texts(lineitem: DataFrame) -> DataFrame:
    """The order line fact topic; a few versions are deletions."""
    whole = F.to_json(F.struct(
        *line_fields(), joined("u", "l_suppkey").alias("user_id"),
        text(F.col("l_suppkey") % 25).alias("province_id"),
        F.when(F.col("l_discount") >= 0.05, joined("a", "l_linenumber")).alias("activity_id"),
        F.when(F.col("l_tax") >= 0.06, joined("c", "l_suppkey")).alias("coupon_id"),
        seconds("l_shipdate").alias("ts")))
    gone = (F.col("l_tax") == 0.08) & (F.col("l_returnflag") == "N")
    return topics.non_null_text(lineitem.select(
        F.when(~gone, whole).alias("value"), line_id().alias("key"), line_place().alias("offset")))


def line_place() -> Column:
    """Versions of a line arrive in falling order of part, supplier and cents, whatever their times."""
    amount = (F.col("l_extendedprice").cast(S.MONEY) * 100).cast("bigint")
    return F.lit(10 ** 17) - ((F.col("l_partkey").cast("bigint") * 10_000 + F.col("l_suppkey")) * 10_000 + amount % 10_000)


def details(spark, sf, timed: bool = False) -> DataFrame:
    return topics.fact_reread(detail_texts(table(spark, sf, "lineitem")), S.ORDER_DETAIL, timed)


def cart_fact_texts(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.to_json(F.struct(
        line_id().alias("id"),
        F.when(F.col("l_tax") != 0.08, text("l_suppkey")).alias("user_id"),
        text("l_partkey").alias("sku_id"), seconds("l_shipdate").alias("ts"))).alias("value"))


def cart_facts(spark, sf) -> DataFrame:
    return parse.parse_json(cart_fact_texts(table(spark, sf, "lineitem")), S.fact_schema(S.CART_ADD))
