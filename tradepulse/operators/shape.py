"""Row shaping in front of the sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse import functions as fx


def to_snake(rows: DataFrame) -> DataFrame:
    return rows.toDF(*[fx.snake_name(c) for c in rows.columns])


def to_camel(rows: DataFrame) -> DataFrame:
    return rows.toDF(*[fx.camel_name(c) for c in rows.columns])


def json_lines(rows: DataFrame, hidden: Sequence[str] = ()) -> DataFrame:
    """One JSON text per row in snake_case, without the hidden fields."""
    shown = to_snake(rows.drop(*hidden))
    return shown.select(F.to_json(F.struct(*shown.columns)).alias("value"))
