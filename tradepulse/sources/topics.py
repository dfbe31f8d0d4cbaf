"""Topics: raw texts, change envelopes, page logs and fact topics.

A topic is a Kafka topic or a directory of files. Both give the text column ``value``;
everything behind :func:`raw_text` is the same for both and for batch and stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepulse import functions as fx
from tradepulse import schemas as S
from tradepulse.operators import visitors
from tradepulse.operators.parse import behaviour_logs, parse_json
from tradepulse.operators.windows import LATENESS


@dataclass(frozen=True)
class Topic:
    """Where a topic lies: ``brokers`` and ``name`` for Kafka, else ``path`` of its files."""

    name: str
    path: str | None = None
    brokers: str | None = None
    file_format: str = "text"
    #: columns of files that are no text; beside the payload there may be ``key`` and ``offset``
    columns: str = "value string"
    #: rows (Kafka) or files per micro-batch; bounds the work and the state of one batch
    per_trigger: int | None = None


def raw_text(spark: SparkSession, topic: Topic, streaming: bool = True) -> DataFrame:
    """The whole topic from its earliest record; a null payload becomes an empty text."""
    reader = spark.readStream if streaming else spark.read
    if topic.brokers:
        reader = (reader.format("kafka").option("kafka.bootstrap.servers", topic.brokers)
                  .option("subscribe", topic.name).option("startingOffsets", "earliest"))
        if streaming and topic.per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", topic.per_trigger)
        value = F.col("value").cast("string")
    else:
        reader = reader.format(topic.file_format)
        if topic.file_format != "text":
            reader = reader.schema(topic.columns)
        if streaming and topic.per_trigger:
            reader = reader.option("maxFilesPerTrigger", topic.per_trigger)
        value = F.col("value")
    rows = reader.load(topic.path) if topic.path else reader.load()
    return non_null_text(rows, value)


def non_null_text(rows: DataFrame, value=None) -> DataFrame:
    value = F.col("value") if value is None else value
    rest = [F.col(c).cast("string") if c == "key" else F.col(c) for c in rows.columns if c != "value"]
    return rows.select(F.coalesce(value, F.lit("")).alias("value"), *rest)


def landed_logs(raw: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Behaviour logs parsed once into parquet below ``path``, with device and flag as columns of their own.

    The repair of ``is_new`` reads its input twice; from here the first time is a scan of three columns.
    """
    logs = visitors.shredded(behaviour_logs(parse_json(raw, S.LOG, keep=keep)))
    logs.write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.schema(logs.schema).parquet(path)


def json_table(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """A topic as a table with declared columns; texts that do not parse give nulls."""
    return parse_json(raw, schema)


def change_envelope(raw: DataFrame) -> DataFrame:
    """Row changes with event time (15 s late at most), processing time and place in the topic.

    Change times are whole seconds; ``pos``, the topic's offset, settles the changes of one
    second. A key's changes lie in one partition of the topic, so offsets compare. A source
    without offsets has 0 everywhere.
    """
    at, pos = _places(raw)
    return (parse_json(raw, S.CHANGE, keep=at).withColumn("pos", pos).drop(*at)
            .withColumn("row_time", fx.from_seconds("ts"))
            .withColumn("proc_time", F.current_timestamp())
            .withWatermark("row_time", LATENESS["sql"]))


def page_log(raw: DataFrame) -> DataFrame:
    """Page topic with event time, 5 s late at most."""
    return (parse_json(raw, S.PAGE).withColumn("row_time", fx.from_millis("ts"))
            .withWatermark("row_time", LATENESS["window"]))


def _places(raw: DataFrame) -> tuple[list[str], Column]:
    at = ["offset"] if "offset" in raw.columns else []
    return at, F.coalesce(F.col("offset").cast("bigint"), F.lit(0)) if at else F.lit(0).cast("bigint")


def fact_reread(raw: DataFrame, columns: Sequence[str], timed: bool = False) -> DataFrame:
    """An upsert fact topic read as a stream of versions, with their place ``pos`` in it.

    Deletions are empty texts: they parse to nulls and leave with them.
    """
    at, pos = _places(raw)
    facts = parse_json(raw, S.fact_schema(list(columns)), keep=at).where(F.col("id").isNotNull())
    facts = facts.withColumn("pos", pos).drop(*at)
    if timed:
        facts = (facts.withColumn("row_time", fx.from_seconds("ts"))
                 .withWatermark("row_time", LATENESS["sql"]))
    return facts


def fact_versions(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """An upsert fact topic with its deletions, as ``UpsertTable`` takes it in the order of ``pos``.

    A deletion has no payload; its id is the record's key.
    """
    at, pos = _places(raw)
    rest = [c for c in columns if c != "id"]
    rows = parse_json(raw, S.fact_schema(list(columns)), keep=["key", "value", *at])
    return (rows.select(F.coalesce("id", "key").alias("id"), *rest, pos.alias("pos"), (F.trim("value") == "").alias("deleted"), F.col("id").alias("_own"))
            .where(F.col("id").isNotNull() & (F.col("deleted") | F.col("_own").isNotNull())).drop("_own"))


# -- landed change log -----------------------------------------------------------------

def landed_changes(spark: SparkSession, path: str, tables: Sequence[str] = (),
                   types: Sequence[str] = (), streaming: bool = False) -> DataFrame:
    """The change log as parquet, partitioned by table and type (see ``sinks.land_changes``).

    A job that names its tables reads those partitions only, instead of parsing the whole
    shop's change text.
    """
    reader = spark.readStream if streaming else spark.read
    schema = T.StructType([f for f in S.CHANGE.fields if f.name not in ("table", "type")]
                          + [T.StructField("pos", T.LongType()), T.StructField("table", T.StringType()),
                             T.StructField("type", T.StringType())])
    rows = reader.schema(schema).parquet(path).select(*schema.names)
    if tables:
        rows = rows.where(F.col("table").isin(*tables))
    if types:
        rows = rows.where(F.col("type").isin(*types))
    return (rows.withColumn("row_time", fx.from_seconds("ts"))
            .withColumn("proc_time", F.current_timestamp()))
