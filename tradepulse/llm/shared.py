"""Small helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors are one process, may do without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="llm-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def landed(rows: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back: work is done once, lineage ends."""
    path = shared_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def map_rows(rows: DataFrame, step: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply ``step`` to the columns of every Arrow batch as Python lists, 1,000 rows at a time."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield to_batch(step(part.to_pydict()), out)

    out = arrow_schema(rows.sparkSession, schema)
    return rows.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def to_batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
