"""Explicit schemas of every feed and table. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STR_MAP = T.MapType(T.StringType(), T.StringType())
MONEY = T.DecimalType(16, 2)


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: behaviour log, ``ts`` in milliseconds
LOG = T.StructType([
    T.StructField("common", STR_MAP),
    T.StructField("page", STR_MAP),
    T.StructField("start", STR_MAP),
    T.StructField("err", STR_MAP),
    T.StructField("displays", T.ArrayType(STR_MAP)),
    T.StructField("actions", T.ArrayType(STR_MAP)),
    T.StructField("ts", T.LongType()),
])

#: page topic after the split; the arrays are gone
PAGE = T.StructType([f for f in LOG.fields if f.name in ("common", "page", "ts")])

#: row-change envelope, ``ts`` in seconds
CHANGE = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("data", STR_MAP),
    T.StructField("old", STR_MAP),
])

DIM_CONFIG = strings("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
FACT_CONFIG = strings("source_table", "source_type", "sink_table", "sink_columns")


def config_change(config: T.StructType) -> T.StructType:
    """Captured change of a config table: ``op`` is c, r, u or d."""
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("before", config),
        T.StructField("after", config),
        T.StructField("ts_ms", T.LongType()),
    ])


# Column lists of the fact tables, in table order.
CART_ADD = ["id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked",
            "create_time", "operate_time", "is_ordered", "order_time", "ts"]
COMMENT_INFO = ["id", "user_id", "nick_name", "sku_id", "spu_id", "order_id", "appraise_code",
                "appraise_name", "comment_txt", "create_time", "operate_time"]
ORDER_DETAIL = ["id", "order_id", "sku_id", "user_id", "activity_id", "activity_rule_id",
                "coupon_id", "province_id", "sku_name", "order_price", "sku_num", "create_time",
                "split_total_amount", "split_activity_amount", "split_coupon_amount", "ts"]
PAYMENT_SUCCESS = ["id", "order_id", "user_id", "payment_type_code", "payment_type_name",
                   "payment_time", "sku_id", "province_id", "activity_id", "activity_rule_id",
                   "coupon_id", "sku_name", "order_price", "sku_num", "split_total_amount",
                   "split_activity_amount", "split_coupon_amount", "ts"]
ORDER_REFUND = ["id", "province_id", "user_id", "order_id", "sku_id", "refund_type", "refund_num",
                "refund_amount", "refund_reason_type", "refund_reason_txt", "create_time",
                "rowkey", "dic_name", "ts"]
REFUND_PAY = ["id", "user_id", "order_id", "sku_id", "province_id", "payment_type",
              "payment_type_name", "callback_time", "total_amount", "refund_num", "ts"]


def fact_schema(columns: list[str]) -> T.StructType:
    """Facts are all strings but the second-resolution ``ts``."""
    return T.StructType([
        T.StructField(c, T.LongType() if c == "ts" else T.StringType()) for c in columns
    ])
